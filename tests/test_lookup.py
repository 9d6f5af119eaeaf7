"""Lookups by bucket: results, and which files and row groups a lookup opens."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitalspark.operators import lookup as L
from vitalspark.operators.recent import last_n_readings
from vitalspark.session import work_path
from vitalspark.sources.fixtures import load_readings
from scans import scan_metrics

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def table(spark):
    path = work_path(spark, "lookup-test")
    L.write_lookup_table(load_readings(spark, SF), path, 8, 4)
    return path


def rows(df):
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("n, metric", [(20, None), (3, "click"), (10_000, None), (1, "nothing")])
def test_same_as_the_whole_table(spark, table, n, metric):
    r = load_readings(spark, SF).persist()
    for patient in [p.patient_id for p in r.select("patient_id").distinct().orderBy("patient_id").limit(4).collect()] + ["P999999", "no such"]:
        assert rows(L.lookup_last_n(spark, table, patient, n, metric)) == rows(last_n_readings(r, patient, n, metric))
    r.unpersist()


def test_a_lookup_opens_the_newest_dates_of_one_bucket(spark, table):
    patient = load_readings(spark, SF).groupBy("patient_id").count().orderBy(F.desc("count"), "patient_id").first().patient_id
    bucket = L._bucket_rows(spark, table, patient)
    dates = L.stored_dates(bucket)
    assert len(dates) > 10 and dates == sorted(dates, reverse=True)
    assert len({f.split("/bucket=")[1].split("/")[0] for f in bucket.inputFiles()}) == 1
    newest = L.lookup_last_n(spark, table, patient, 1)
    m = scan_metrics(newest)
    own = {r.reading_date for r in bucket.where(F.col("patient_id") == patient).select("reading_date").distinct().collect()}
    steps, seen = [], 0
    while not own & set(dates[:seen]):
        seen += L.FIRST_DATES * 2 ** len(steps)
        steps.append(seen)
    files = [f for f in bucket.inputFiles() if any(f"reading_date={d}/" in f for d in dates[:seen])]
    assert m["numFiles"] == len(files) < len(bucket.inputFiles()) / 2
    assert len(bucket.inputFiles()) < len(spark.read.parquet(table).inputFiles()) / 4


def test_row_groups_without_the_key_are_skipped(spark, table):
    """A key between those of a file, so that ranges of values don't exclude it."""
    keys = sorted(r.patient_key for r in L._bucket_rows(spark, table, "P000007").select("patient_key").distinct().collect())
    day = spark.read.parquet(table)
    absent = keys[1][:-1] + ("0" if keys[1][-1] != "0" else "1")
    m = scan_metrics(day.where(F.col("patient_key") == absent).select("value"))
    assert m["numOutputRows"] == 0


def test_hot_patient_is_split_and_null_times_come_last(spark):
    at = dt.datetime(2024, 1, 1)
    data = [("hot", at + dt.timedelta(seconds=i), "m", float(i), "u", "d", False, 0.0, 1.0) for i in range(4000)]
    data += [("hot", None, "m", -1.0, "u", "d", False, 0.0, 1.0), ("other", at, "m", 5.0, "u", "d", None, 0.0, 1.0)]
    r = spark.createDataFrame(data, "patient_id string, reading_timestamp timestamp_ntz, metric_type string, value double, unit string, "
                                    "device_id string, is_abnormal boolean, threshold_min double, threshold_max double")
    path = work_path(spark, "lookup-hot")
    L.write_lookup_table(r, path, 2, 8)
    bucket = L._bucket_rows(spark, path, "hot")
    sizes = [x["count"] for x in bucket.where("patient_id = 'hot'").groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) > 3 and max(sizes) < 2000
    assert [x.value for x in L.lookup_last_n(spark, path, "hot", 3).collect()] == [3999.0, 3998.0, 3997.0]
    assert [x.value for x in L.lookup_last_n(spark, path, "hot", 4001).collect()][-2:] == [0.0, -1.0]
    assert L.stored_dates(bucket)[-1] is None


def test_empty_table(spark):
    path = work_path(spark, "lookup-empty")
    L.write_lookup_table(load_readings(spark, SF).where("false"), path, 2, 2)
    assert L.lookup_last_n(spark, path, "P000007").collect() == []
