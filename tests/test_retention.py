"""Expired dates leave the stored table; everything else keeps its files."""

import datetime as dt
import os

from pyspark.sql import functions as F

from vitalspark.operators.retention import drop_expired, expired_dates
from vitalspark.operators.transforms import readings_within_retention
from vitalspark.session import work_path
from vitalspark.sinks.files import write_readings_table


def files(path):
    return {f for _, _, names in os.walk(path.removeprefix("file:")) for f in names if f.endswith(".parquet")}


def table(spark, written=False):
    t = dt.datetime(2024, 1, 1)
    rows = [(f"p{i % 3}", t + dt.timedelta(hours=6 * i), "m", float(i)) for i in range(40)] + [("p", None, "m", -1.0)]
    r = spark.createDataFrame(rows, "patient_id string, reading_timestamp timestamp_ntz, metric_type string, value double")
    if written:     # the first date was written again much later, one row of the second has no write time
        late = F.when(F.col("value") == 0, F.lit("2024-06-01 00:00:00").cast("timestamp_ntz")).when(F.col("value") != 5, F.col("reading_timestamp"))
        r = r.withColumn("written_at", late)
    path = work_path(spark, "retention-test")
    write_readings_table(r, path)
    return r, path


def test_whole_dates_are_dropped(spark):
    r, path = table(spark)
    before = files(path)
    as_of = "2024-01-08 12:00:00"       # the limit, three days before, is in the middle of 5 January
    assert expired_dates(spark, path, as_of, 3) == [dt.date(2024, 1, d) for d in (1, 2, 3, 4)]
    assert drop_expired(spark, path, as_of, 3) == [dt.date(2024, 1, d) for d in (1, 2, 3, 4)]
    assert files(path) < before
    left = spark.read.parquet(path)
    assert left.where("reading_date IS NULL").count() == 1 and left.agg(F.min("reading_date")).first()[0] == dt.date(2024, 1, 5)
    want = {x.value for x in readings_within_retention(r, as_of, 3).collect()}
    assert {x.value for x in readings_within_retention(left, as_of, 3).collect()} == want
    assert drop_expired(spark, path, as_of, 3) == [] and drop_expired(spark, path, "2020-01-01 00:00:00", 3) == []


def test_by_write_time(spark):
    r, path = table(spark, written=True)
    assert drop_expired(spark, path, "2024-01-08 12:00:00", 3, "written_at") == [dt.date(2024, 1, 3), dt.date(2024, 1, 4)]
    assert drop_expired(spark, path, "2025-01-08 00:00:00", 3, "written_at")[0] == dt.date(2024, 1, 1)
    assert spark.read.parquet(path).select("reading_date").distinct().count() == 2      # the unknown write time, the unknown date
