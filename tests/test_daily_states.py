"""Figures a day: merged they equal the whole, a new day reads one day, other days keep their files."""

import os

import pytest
from pyspark.sql import functions as F

from vitalspark.operators import daily_states as DS
from vitalspark.operators import stats
from vitalspark.operators.report import daily_report
from vitalspark.session import work_path
from vitalspark.sinks.files import write_readings_table
from vitalspark.sources.fixtures import load_readings
from scans import scan_metrics

SF = "/root/testdata/sf0.01"
ODD = [("p1", "2024-01-01 00:00:00", "m", 1e9 + 0.1, "d1", True), ("p1", "2024-01-02 00:00:00", "m", 1e9 + 0.3, "d1", None),
       ("p2", "2024-01-03 23:59:59", "m", None, None, False), (None, None, "m", 1e9, "d2", True), ("p2", "2024-01-03 01:00:00", None, 5.0, "d2", True),
       ("p3", "2024-01-03 01:00:00", "lone", 2.0, "d2", False)]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, "patient_id string, t string, metric_type string, value double, device_id string, is_abnormal boolean")
    return df.withColumn("reading_timestamp", F.col("t").cast("timestamp_ntz")).drop("t")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize("which", ["events", "odd"])
def test_merged_equals_the_whole(spark, odd, which):
    readings = odd if which == "odd" else load_readings(spark, SF)
    path = work_path(spark, "states-test")
    DS.write_days(readings, path)
    merged = DS.merged_groups(spark, path)
    whole = stats.written_groups(readings, stats.STATISTICS_SETS)
    a, b = stats.statistics_sections(groups=merged, high_risk_limit=None), stats.statistics_sections(groups=whole, high_risk_limit=None)
    for key in a:
        assert rows(a[key]) == rows(b[key]), key
    at = "2024-02-01", "2024-02-01 00:00:00"
    assert rows(daily_report(None, *at, groups=merged)) == rows(daily_report(None, *at, groups=whole))


def test_a_new_day_reads_one_day_and_replaces_only_its_own(spark):
    table, path = work_path(spark, "table"), work_path(spark, "states-test")
    write_readings_table(load_readings(spark, SF), table)
    readings = spark.read.parquet(table)
    days = sorted(r[0] for r in readings.select("reading_date").distinct().collect())
    DS.write_days(readings, path, days[:5])

    def files():
        return {f for folder, _, names in os.walk(os.path.join(path, "groups").removeprefix("file:")) for f in names if f.endswith(".parquet")}
    before = files()
    DS.write_days(readings, path, days[5:6])
    assert before < files()
    before = files()
    DS.write_days(readings, path, days[5:6])
    assert len(before - files()) == len(files() - before) > 0
    one = scan_metrics(readings.where(DS._on(days[5:6])).select("value"))
    assert one["numFiles"] < len(readings.inputFiles()) / 5
    part = load_readings(spark, SF).where(F.to_date("reading_timestamp").isin(days[:6]))
    assert rows(stats.group_summary(DS.merged_groups(spark, path))) == rows(stats.overall_summary(part))
    lo, hi = days[1], days[3]
    few = part.where(F.to_date("reading_timestamp").between(F.lit(lo), F.lit(hi)))
    assert rows(stats.group_summary(DS.merged_groups(spark, path, lo, hi))) == rows(stats.overall_summary(few))
    told = DS.approximate_distinct(spark, path, lo, hi).first()
    exact = few.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("patient_id").alias("p"), F.count_distinct("device_id").alias("d")).first()
    assert told.readings == exact.n and abs(told.patients - exact.p) <= 0.05 * exact.p and abs(told.devices - exact.d) <= 0.05 * exact.d + 1


def test_empty(spark, odd):
    path = work_path(spark, "states-test")
    DS.write_days(odd, path)
    assert DS.merged_groups(spark, path, "2030-01-01").count() == 0
    assert tuple(DS.approximate_distinct(spark, path, "2030-01-01").first()) == (0, 0, 0)


def test_report_sections_add_up_with_a_missing_metric(spark, odd):
    r = daily_report(odd, "2024-02-01", "2024-02-01 00:00:00").first()
    assert sum(m.total_readings for m in r.metric_statistics) == r.summary.total_readings == len(ODD)
    assert [m.metric_type for m in r.metric_statistics] == [None, "lone", "m"]
    assert sum(m["count"] for m in r.abnormality_rates) == r.summary.total_abnormal
    assert [m.metric for m in r.abnormality_rates] == ["m", None, "lone"]
    assert len(r.metric_statistics) == stats.metric_summary(odd).count() == stats.abnormality_rates(odd).count()
