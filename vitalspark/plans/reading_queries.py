"""Registered reading-side queries: projections, filters, last-N (P*, W1–W3)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import normalize_reading_time
from ..operators import recent, transforms
from ..operators.lookup import lookup_last_n, write_lookup_table
from ..operators.retention import drop_expired
from ..sources.fixtures import (BROKEN_EVERY, BROKEN_OFFSET, iso_time_readings, load_readings, load_table, metric_dim,
                                patients_flat, reading_messages)
from ..session import work_path
from ..sinks.files import write_readings_table
from ..sources.readers import read_readings_table
from .registry import register
from .sql_fixtures import with_patients, with_readings
from .stored import stored

PATIENT = "P000007"
METRIC = "click"
RECENT_AS_OF = "2024-01-31 00:00:00"
RETENTION_AS_OF = "2024-04-15 00:00:00"
_ALL = ", ".join(S.READING_COLUMNS)
_ISO = "strftime(reading_timestamp, '%Y-%m-%dT%H:%M:%S.%f')"


@register("abnormal_readings", with_readings("""
SELECT patient_id, reading_timestamp, metric_type, value, unit, threshold_min, threshold_max
FROM readings WHERE is_abnormal"""))
def q_abnormal_readings(spark, sf_dir):
    return transforms.abnormal_readings(load_readings(spark, sf_dir))


@register("reading_status_label", with_readings(f"""
SELECT {_ALL}, CASE WHEN is_abnormal THEN 'ABNORMAL' ELSE 'Normal' END AS status FROM readings"""))
def q_reading_status_label(spark, sf_dir):
    return transforms.reading_status_label(load_readings(spark, sf_dir))


@register("recent_abnormal", with_readings(f"""
SELECT patient_id, metric_type, value, reading_timestamp FROM readings
WHERE is_abnormal AND reading_timestamp > TIMESTAMP '{RECENT_AS_OF}' - INTERVAL 24 HOUR"""))
def q_recent_abnormal(spark, sf_dir):
    return transforms.recent_abnormal(load_readings(spark, sf_dir), RECENT_AS_OF, 24)


@register("readings_within_retention", with_readings(f"""
SELECT {_ALL} FROM readings WHERE reading_timestamp > TIMESTAMP '{RETENTION_AS_OF}' - INTERVAL 90 DAY"""))
def q_readings_within_retention(spark, sf_dir):
    return transforms.readings_within_retention(load_readings(spark, sf_dir), RETENTION_AS_OF, 90)


@register("retention_drop", with_readings(f"""
SELECT {_ALL}, (SELECT count(DISTINCT CAST(reading_timestamp AS DATE)) FROM readings
                WHERE CAST(reading_timestamp AS DATE) + INTERVAL 1 DAY <= TIMESTAMP '{RETENTION_AS_OF}' - INTERVAL 90 DAY) AS dropped
FROM readings WHERE reading_timestamp > TIMESTAMP '{RETENTION_AS_OF}' - INTERVAL 90 DAY"""))
def q_retention_drop(spark, sf_dir):
    """P13 on the stored table: expired date folders are dropped, what is left of the date in between is filtered."""
    path = work_path(spark, "expiring-readings")
    write_readings_table(load_readings(spark, sf_dir), path)
    gone = drop_expired(spark, path, RETENTION_AS_OF, 90)
    return (transforms.readings_within_retention(read_readings_table(spark, path), RETENTION_AS_OF, 90)
            .drop("reading_date").withColumn("dropped", F.lit(len(gone)).cast("long")))


@register("classify_readings", with_readings(f"""
SELECT patient_id, reading_timestamp, metric_type, value, unit, device_id,
       (value < threshold_min OR value > threshold_max) AS is_abnormal, threshold_min, threshold_max,
       CASE WHEN value < threshold_min THEN 'threshold_min' WHEN value > threshold_max THEN 'threshold_max' END
         AS threshold_violated
FROM readings"""))
def q_classify_readings(spark, sf_dir):
    unflagged = load_readings(spark, sf_dir).drop("is_abnormal")
    return transforms.classify_readings(unflagged, metric_dim(spark))


def _messages(spark, sf_dir):
    """The messages of all readings as the topic keeps them: written, and dealt out over several files."""
    def write(path):
        messages = reading_messages(load_readings(spark, sf_dir, keep_event_id=True))
        messages.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "partition").write.parquet(path)
    return spark.read.parquet(stored(spark, sf_dir, "message-table", write))


def _stored(spark, sf_dir):
    """The reading table with the store's patient key, written and read back."""
    path = stored(spark, sf_dir, "readings-table",
                  lambda p: write_readings_table(transforms.with_patient_key(load_readings(spark, sf_dir)), p))
    return read_readings_table(spark, path)


def _lookup_table(spark, sf_dir):
    return stored(spark, sf_dir, "lookup-table", lambda p: write_lookup_table(load_readings(spark, sf_dir), p, 16))


@register("last_n_readings", with_readings(f"""
SELECT patient_id, reading_timestamp, metric_type, value, unit, is_abnormal FROM readings
WHERE patient_id = '{PATIENT}' ORDER BY reading_timestamp DESC, metric_type LIMIT 20"""))
def q_last_n_readings(spark, sf_dir):
    return recent.last_n_readings(_stored(spark, sf_dir), PATIENT, 20)


@register("last_n_readings_metric", with_readings(f"""
SELECT patient_id, reading_timestamp, metric_type, value, unit, is_abnormal FROM readings
WHERE patient_id = '{PATIENT}' AND metric_type = '{METRIC}'
ORDER BY reading_timestamp DESC LIMIT 20"""))
def q_last_n_readings_metric(spark, sf_dir):
    return recent.last_n_readings(_stored(spark, sf_dir), PATIENT, 20, METRIC)


@register("lookup_last_n", with_readings(f"""
SELECT patient_id, reading_timestamp, metric_type, value, unit, is_abnormal FROM readings
WHERE patient_id = '{PATIENT}' ORDER BY reading_timestamp DESC, metric_type LIMIT 20"""))
def q_lookup_last_n(spark, sf_dir):
    """W1 from one bucket of the lookup table, newest dates first."""
    return lookup_last_n(spark, _lookup_table(spark, sf_dir), PATIENT, 20)


@register("lookup_last_n_metric", with_readings(f"""
SELECT patient_id, reading_timestamp, metric_type, value, unit, is_abnormal FROM readings
WHERE patient_id = '{PATIENT}' AND metric_type = '{METRIC}' ORDER BY reading_timestamp DESC LIMIT 20"""))
def q_lookup_last_n_metric(spark, sf_dir):
    """W2 from one bucket of the lookup table."""
    return lookup_last_n(spark, _lookup_table(spark, sf_dir), PATIENT, 20, METRIC)


@register("last_n_all_patients", with_readings("""
SELECT * FROM (
  SELECT patient_id, reading_timestamp, metric_type, value, unit, is_abnormal,
         CAST(row_number() OVER (PARTITION BY patient_id ORDER BY reading_timestamp DESC, metric_type) AS INTEGER)
           AS reading_rank
  FROM readings) WHERE reading_rank <= 20"""))
def q_last_n_all_patients(spark, sf_dir):
    return recent.last_n_all_patients(load_readings(spark, sf_dir), 20)


# --- messages and reading times -------------------------------------------------------

_MSG = f"""msgs AS (
  SELECT event_id AS "offset", reading_timestamp AS message_timestamp, 1 AS ok, * EXCLUDE (event_id) FROM readings_id
  UNION ALL
  SELECT event_id + {BROKEN_OFFSET}, reading_timestamp, NULL, * EXCLUDE (event_id) FROM readings_id
  WHERE event_id % {BROKEN_EVERY} = 0)"""


@register("parse_json_readings", with_readings(f"""
SELECT CASE WHEN ok = 1 THEN patient_id END AS patient_id,
       CASE WHEN ok = 1 THEN {_ISO} END AS reading_timestamp,
       CASE WHEN ok = 1 THEN metric_type END AS metric_type, CASE WHEN ok = 1 THEN value END AS value,
       CASE WHEN ok = 1 THEN unit END AS unit, CASE WHEN ok = 1 THEN device_id END AS device_id,
       CASE WHEN ok = 1 THEN is_abnormal END AS is_abnormal,
       CASE WHEN ok = 1 THEN threshold_min END AS threshold_min,
       CASE WHEN ok = 1 THEN threshold_max END AS threshold_max, message_timestamp
FROM msgs""", _MSG))
def q_parse_json_readings(spark, sf_dir):
    return transforms.parse_json_readings(_messages(spark, sf_dir))


@register("malformed_split", with_readings("""
SELECT "offset", CASE WHEN ok = 1 THEN 'good' ELSE 'dead_letter' END AS status,
       CASE WHEN ok = 1 THEN patient_id END AS patient_id,
       CASE WHEN ok = 1 THEN NULL ELSE '{bad' END AS raw
FROM msgs""", _MSG))
def q_malformed_split(spark, sf_dir):
    bad = F.col("malformed")
    return transforms.tag_malformed(_messages(spark, sf_dir)).select(
        "offset", F.when(bad, "dead_letter").otherwise("good").alias("status"),
        F.when(~bad, F.col("data.patient_id")).alias("patient_id"), F.when(bad, F.col("raw")).alias("raw"))


@register("add_processed_at", with_readings(f"""
SELECT {_ALL}, true AS stamped, true AS within_query, CAST(1 AS BIGINT) AS stamps FROM readings"""))
def q_add_processed_at(spark, sf_dir):
    """P3, with what holds for any clock: a stamp on each row, one for the whole query, taken while it runs."""
    built = dt.datetime.now(dt.timezone.utc)
    r = transforms.add_processed_at(load_readings(spark, sf_dir))
    stamps = r.agg(F.count_distinct("processed_at")).scalar()
    lived = (F.col("processed_at") >= F.lit(built)) & (F.col("processed_at") <= F.current_timestamp())
    return r.select(*S.READING_COLUMNS, F.col("processed_at").isNotNull().alias("stamped"), lived.alias("within_query"),
                    stamps.alias("stamps"))


@register("parse_reading_time", with_readings("""
SELECT patient_id, metric_type, reading_timestamp FROM readings"""))
def q_parse_reading_time(spark, sf_dir):
    iso = iso_time_readings(load_readings(spark, sf_dir, keep_event_id=True))
    return transforms.parse_reading_time_col(iso).select("patient_id", "metric_type", "reading_timestamp")


@register("normalize_reading_time", with_readings("""
SELECT "event_id", strftime(reading_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS normalized FROM readings_id"""))
def q_normalize_reading_time(spark, sf_dir):
    iso = iso_time_readings(load_readings(spark, sf_dir, keep_event_id=True))
    return iso.select("event_id", normalize_reading_time("reading_timestamp").alias("normalized"))


_DASHED = """ids AS (
  SELECT patient_id AS id FROM patients_flat
  UNION ALL SELECT substr(patient_id, 1, 1) || '-' || substr(patient_id, 2) FROM patients_flat),
hashed AS (SELECT id, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8') || encode(id)) AS h FROM ids)"""


@register("patient_key", with_patients("""
SELECT id AS patient_id,
       CASE WHEN contains(id, '-') THEN id ELSE
         substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' ||
         substr('89ab', ((position(substr(h, 17, 1) IN '0123456789abcdef') - 1) & 3) + 1, 1) ||
         substr(h, 18, 3) || '-' || substr(h, 21, 12) END AS patient_key
FROM hashed""", _DASHED))
def q_patient_key(spark, sf_dir):
    ids = patients_flat(load_table(spark, sf_dir, "customer")).select("patient_id")
    dashed = ids.select(F.concat(F.substring("patient_id", 1, 1), F.lit("-"),
                                 F.expr("substring(patient_id, 2)")).alias("patient_id"))
    return transforms.with_patient_key(ids.unionByName(dashed))

