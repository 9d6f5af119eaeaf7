"""Registered source/sink round trips (S2–S6, K3–K5, K7) and the report.

Writers put their output below the session's shared checkpoint folder (a new
path per call); the query then reads it back with the matching source, so the
oracle checks the write and the read together.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import schemas as S
from ..operators import documents as D
from ..operators.report import daily_report
from ..operators.transforms import parse_json_readings
from ..operators.upsert import reading_date, upsert
from ..session import work_path
from ..sinks import files as K
from ..sources import fixtures as X
from ..sources import readers as R
from .document_queries import _FLAT, _FLAT_COLS
from .registry import register
from .sql_fixtures import with_patients, with_readings
from .stored import stored

_ALL = ", ".join(S.READING_COLUMNS)
REPORT_DATE = "2024-01-31"
GENERATED_AT = "2024-01-31 06:00:00"


@register("sink_readings_csv", with_readings(f"SELECT {_ALL} FROM readings"))
def q_sink_readings_csv(spark, sf_dir):
    path = work_path(spark, "csv")
    K.write_readings_csv(X.load_readings(spark, sf_dir), path)
    return R.read_readings_csv(spark, path)


@register("src_readings_csv", with_readings(f"SELECT {_ALL} FROM readings"))
def q_src_readings_csv(spark, sf_dir):
    """A CSV whose columns come in reverse order still reads by name."""
    path = work_path(spark, "csv")
    K.write_readings_csv(X.load_readings(spark, sf_dir), path, columns=list(reversed(S.READING_COLUMNS)))
    return R.read_readings_csv(spark, path)


@register("src_readings_pipe_text", with_readings(
    "SELECT patient_id, reading_timestamp, metric_type, value, unit, coalesce(is_abnormal, false) AS is_abnormal "
    "FROM readings"))
def q_src_readings_pipe_text(spark, sf_dir):
    path = work_path(spark, "pipe")
    K.write_pipe_text(X.load_readings(spark, sf_dir), path)
    return R.read_pipe_text(spark, path)


@register("src_readings_table", with_readings(
    "SELECT patient_id, reading_timestamp, value, is_abnormal, CAST(reading_timestamp AS DATE) AS reading_date "
    "FROM readings WHERE metric_type = 'click' AND reading_timestamp >= TIMESTAMP '2024-01-10'"))
def q_src_readings_table(spark, sf_dir):
    path = work_path(spark, "table")
    K.write_readings_table(X.load_readings(spark, sf_dir), path)
    where = (F.col("metric_type") == "click") & (F.col("reading_date") >= F.lit("2024-01-10").cast("date"))
    return R.read_readings_table(spark, path, ["patient_id", "reading_timestamp", "value", "is_abnormal",
                                              "reading_date"], where)


@register("src_patients_documents", with_patients(f"SELECT {_FLAT_COLS} FROM flat", _FLAT))
def q_src_patients_documents(spark, sf_dir):
    path = work_path(spark, "patients")
    K.append_patients(X.load_patients(spark, sf_dir), path)
    return D.flatten_patients(R.read_patient_documents(spark, path))


@register("sink_patients_append", with_patients(f"SELECT {_FLAT_COLS} FROM flat", _FLAT))
def q_sink_patients_append(spark, sf_dir):
    """Two appends (even keys, then odd keys) read back as one collection."""
    path = work_path(spark, "patients")
    docs = X.nest_patients(X.patients_flat(X.load_table(spark, sf_dir, "customer")), keep_custkey=True)
    K.append_patients(docs.filter(F.col("c_custkey") % 2 == 0).drop("c_custkey"), path, fmt="parquet")
    K.append_patients(docs.filter(F.col("c_custkey") % 2 == 1).drop("c_custkey"), path, fmt="parquet")
    return D.flatten_patients(R.read_patient_documents(spark, path, fmt="parquet"))


_MSG_ORDER = """SELECT patient_id, strftime(reading_timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS reading_timestamp,
       metric_type, value, unit, device_id, is_abnormal, threshold_min, threshold_max, event_id AS "offset"
FROM readings_id ORDER BY event_id LIMIT 100"""


@register("bounded_ingest", with_readings(_MSG_ORDER))
def q_bounded_ingest(spark, sf_dir):
    msgs = X.reading_messages(X.load_readings(spark, sf_dir, keep_event_id=True), broken_every=None)
    first = R.bounded_ingest(msgs, 100, "offset")
    return parse_json_readings(first, keep=("offset",)).drop("message_timestamp")


_UPSERTED = f"""SELECT patient_id, reading_timestamp, metric_type,
       value + CASE WHEN event_id % 20 = 0 THEN 2 WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS value,
       unit, device_id, is_abnormal, threshold_min, threshold_max FROM readings_id"""


@register("upsert_readings", with_readings(_UPSERTED))
def q_upsert_readings(spark, sf_dir):
    base, incoming = X.reading_upserts(spark, sf_dir)
    path = stored(spark, sf_dir, "upsert-base", lambda p: K.write_readings_table(base, p))
    return upsert(R.read_readings_table(spark, path), incoming.withColumn("reading_date", reading_date()), S.READING_KEY, "seq").drop("reading_date")


# --- A8 report ---------------------------------------------------------------------------

_PS = """ps AS (
  SELECT patient_id, count(*) AS total_readings, CAST(count_if(is_abnormal) AS BIGINT) AS abnormal_readings,
         round(count_if(is_abnormal) / count(*) * 100, 2) AS abnormal_percentage,
         count_if(is_abnormal) / count(*) * 100 AS raw_percentage
  FROM readings GROUP BY patient_id)"""


def _report(spark, sf_dir):
    return daily_report(X.load_readings(spark, sf_dir), REPORT_DATE, GENERATED_AT)


@register("daily_report", with_readings(f"""
SELECT DATE '{REPORT_DATE}' AS report_date, TIMESTAMP '{GENERATED_AT}' AS generated_at,
       CAST(sum(total_readings) AS BIGINT) AS total_readings, count(*) AS total_patients,
       CAST(count_if(raw_percentage > 20.0) AS BIGINT) AS high_risk_patients,
       (SELECT count(DISTINCT device_id) FROM readings) AS total_devices,
       CAST(sum(abnormal_readings) AS BIGINT) AS total_abnormal,
       round(sum(abnormal_readings) / sum(total_readings) * 100, 2) AS overall_abnormal_rate,
       (SELECT CAST(count(DISTINCT metric_type) AS INTEGER) FROM readings) AS n_metric_statistics,
       (SELECT CAST(count(DISTINCT metric_type) AS INTEGER) FROM readings) AS n_abnormality_rates,
       CAST(least(count_if(raw_percentage > 20.0), 20) AS INTEGER) AS n_high_risk_patients
FROM ps""", _PS))
def q_daily_report(spark, sf_dir):
    r = _report(spark, sf_dir)
    return r.select("report_date", "generated_at", "summary.*",
                    F.size("metric_statistics").alias("n_metric_statistics"),
                    F.size("abnormality_rates").alias("n_abnormality_rates"),
                    F.size("high_risk_patients").alias("n_high_risk_patients"))


@register("daily_report_metrics", with_readings("""
SELECT CAST(row_number() OVER (ORDER BY metric_type) - 1 AS INTEGER) AS pos, metric_type,
       count(*) AS total_readings, round(avg(value), 2) AS avg_value,
       CAST(count_if(is_abnormal) AS BIGINT) AS abnormal_count,
       round(count_if(is_abnormal) / count(*) * 100, 2) AS abnormal_rate
FROM readings GROUP BY metric_type"""))
def q_daily_report_metrics(spark, sf_dir):
    return _report(spark, sf_dir).select(F.posexplode("metric_statistics").alias("pos", "m")).select("pos", "m.*")


@register("daily_report_rates", with_readings("""
SELECT CAST(row_number() OVER (ORDER BY count_if(is_abnormal) DESC, metric_type) - 1 AS INTEGER) AS pos,
       metric_type AS metric, CAST(count_if(is_abnormal) AS BIGINT) AS count,
       round(count_if(is_abnormal) / count(*) * 100, 2) AS rate
FROM readings GROUP BY metric_type"""))
def q_daily_report_rates(spark, sf_dir):
    return _report(spark, sf_dir).select(F.posexplode("abnormality_rates").alias("pos", "m")).select("pos", "m.*")


@register("daily_report_high_risk", with_readings("""
SELECT CAST(row_number() OVER (ORDER BY abnormal_percentage DESC, patient_id) - 1 AS INTEGER) AS pos,
       patient_id, total_readings, abnormal_readings, abnormal_percentage
FROM ps WHERE raw_percentage > 20.0 ORDER BY abnormal_percentage DESC, patient_id LIMIT 20""", _PS))
def q_daily_report_high_risk(spark, sf_dir):
    return _report(spark, sf_dir).select(F.posexplode("high_risk_patients").alias("pos", "m")).select("pos", "m.*")


@register("sink_report_append", with_readings(f"""
SELECT DATE '{REPORT_DATE}' AS report_date, CAST(count(*) AS BIGINT) AS total_readings,
       CAST(count_if(is_abnormal) AS BIGINT) AS total_abnormal FROM readings"""))
def q_sink_report_append(spark, sf_dir):
    path = work_path(spark, "reports")
    for _ in range(2):      # a repeated run leaves one document a date
        K.append_report(_report(spark, sf_dir), path)
    back = spark.read.parquet(path)
    return back.select(F.col("report_date").cast("date").alias("report_date"), "summary.total_readings",
                       "summary.total_abnormal")
