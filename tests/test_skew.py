"""Hot keys: one patient and one device hold a third of all readings.

The skewed input is derived from the given events (every third event is
re-keyed to patient 1 and device 0; nothing is dropped).  Every registered
query below runs unchanged over it and must still equal its registered oracle
over the same input."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from pyspark.sql import functions as F

from conftest import SF_ORACLE, SF_SMALL
from harness import compare, duck
from vitalspark.session import work_path
from vitalspark.sources.tables import TABLES

KEYS = ["metric_summary", "patient_summary", "patient_summary_top10", "high_risk_patients", "device_activity",
        "device_activity_all", "overall_summary", "hourly_distribution", "last_n_all_patients", "upsert_readings",
        "daily_report", "daily_report_high_risk", "tumbling_metric_alerts", "window_statistics",
        "patient_alerts_by_window"]


@pytest.fixture(scope="module")
def skewed_dir(spark):
    d = work_path(spark, "skewed-sf")
    os.makedirs(d)
    for t in TABLES:
        src = os.path.join(SF_ORACLE, f"{t}.parquet")
        if t != "events" and os.path.exists(src):
            os.symlink(src, os.path.join(d, f"{t}.parquet"))
    duckdb.connect().execute(f"""
        COPY (SELECT event_id, ts, CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id, event_type, value,
                     CASE WHEN event_id % 3 = 0 THEN '{{"k": 0}}' ELSE props END AS props
              FROM read_parquet('{SF_ORACLE}/events.parquet') ORDER BY event_id)
        TO '{d}/events.parquet' (FORMAT PARQUET)""")
    return d


@pytest.fixture(scope="module")
def duck_skewed(skewed_dir):
    return duck(skewed_dir)


def test_the_input_is_skewed(duck_skewed):
    total, hot_patient, hot_device = duck_skewed.execute(
        "SELECT count(*), count_if(user_id = 1), count_if(props = '{\"k\": 0}') FROM events").fetchone()
    assert hot_patient * 3 >= total and hot_device * 3 >= total


@pytest.mark.parametrize("key", KEYS)
def test_hot_keys_equal_the_oracle(spark, skewed_dir, duck_skewed, key):
    problems, _, _ = compare(E.queries()[key](spark, skewed_dir), duck_skewed, E.oracle_sql()[key])
    assert not problems


def test_hot_patient_day_is_split_over_files(spark):
    """One patient on one day holds a third of all readings: the reading-table
    writer still spreads that (date, patient) over several tasks and files."""
    from pyspark.sql import functions as F
    from vitalspark.sinks.files import write_readings_table
    from vitalspark.sources.fixtures import load_readings
    d = work_path(spark, "hot-day-sf")
    os.makedirs(d)
    duckdb.connect().execute(f"""
        COPY (SELECT event_id,
                     CASE WHEN event_id % 3 = 0 THEN TIMESTAMP '2024-01-05' + (ts - date_trunc('day', ts)) ELSE ts END AS ts,
                     CASE WHEN event_id % 3 = 0 THEN 1 ELSE user_id END AS user_id, event_type, value, props
              FROM read_parquet('{SF_ORACLE}/events.parquet') ORDER BY event_id)
        TO '{d}/events.parquet' (FORMAT PARQUET)""")
    r = load_readings(spark, d)
    hot = r.filter((F.col("patient_id") == "P000001")
                   & (F.to_date("reading_timestamp") == F.lit("2024-01-05").cast("date"))).count()
    assert hot * 3 >= r.count()
    path = work_path(spark, "hot-table")
    write_readings_table(r, path, partitions=8)
    per_file = (spark.read.parquet(path).filter(F.col("patient_id") == "P000001")
                .filter(F.col("reading_date") == F.lit("2024-01-05").cast("date"))
                .groupBy(F.col("_metadata.file_path")).count().collect())
    assert len(per_file) >= 2 and max(x["count"] for x in per_file) < hot
    assert spark.read.parquet(path).count() == r.count()


def test_a_third_of_all_updates_on_one_patient(spark):
    """Child rows give the documents of the array form, and no stage holds a patient's entries in one row."""
    from vitalspark.operators import documents as D
    from vitalspark.operators import patient_tables as PT
    from vitalspark.sources import fixtures as X
    docs = X.load_patients(spark, SF_SMALL)
    at = F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(secs=F.col("id"))
    hot = F.when(F.col("id") % 3 == 0, F.lit("P000007")).otherwise(F.format_string("P%06d", F.col("id") % 160))
    base = spark.range(3000).select(hot.alias("patient_id"), F.col("id").alias("seq"), at.alias("at"), "id")
    notes = base.select("patient_id", "seq", "at", F.lit("Dr").alias("doctor"), F.concat(F.lit("n"), "id").alias("note"))
    scores = base.select("patient_id", "seq", "at", (F.col("id") % 100).cast("int").alias("new_score"),
                         F.when(F.col("id") % 2 == 0, F.array(F.lit("f"))).otherwise(F.array().cast("array<string>")).alias("factors"))
    t = PT.update_scores(PT.add_notes(PT.split(docs), notes), scores, batch=2)
    old = D.update_risk_scores(D.add_medical_notes(docs, notes), scores)
    same = lambda a, b: sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))
    assert same(PT.flatten(t), D.flatten_patients(old))
    assert same(PT.history_counts(t), D.history_counts(old))
    assert "collect_list" not in PT.flatten(t)._jdf.queryExecution().toString()
    one = spark.createDataFrame([("P000007",)], "patient_id string")
    assert same(PT.assemble(t, one), old.where("patient_id = 'P000007'"))
