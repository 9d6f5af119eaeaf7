"""Point lookups (W1, W2) over a table laid out like the store's: by patient, newest first.

The table has a folder for each of a number of hash buckets of the store's
patient key, in it a folder a date, and in each file the rows sorted by key and
time with a Bloom filter on the key.  A lookup lists one bucket, goes through
its dates from the newest, a few at a time, and stops once it has seen enough
rows; of the files that it opens, row groups without the key are skipped by
their filter.  A patient or a day with most of all rows is split over files, as
rows are dealt out by ranges that include the time.
"""

from __future__ import annotations

import datetime as dt
import os
import re
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import patient_key
from .recent import LAST_N, LAST_N_COLUMNS, newest_first

BUCKETS = 64
LAYOUT = "_layout"                  # a table of one row below the path: the number of buckets
FIRST_DATES = 2                     # dates of the first step; each step takes twice as many as the one before


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def write_lookup_table(readings: DataFrame, path: str, buckets: int = BUCKETS, partitions: int | None = None,
                       keys_per_file: int = 100_000) -> None:
    """Write readings as bucket / date / files.  ``keys_per_file`` sizes the Bloom filters (about 1.2 bytes a key)."""
    spark = readings.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (readings.withColumn("patient_key", patient_key()).withColumn("reading_date", F.to_date("reading_timestamp"))
            .withColumn("bucket", bucket_of(F.col("patient_key"), buckets)))
    order = [F.col("bucket"), F.col("reading_date"), F.col("patient_key"), F.col("reading_timestamp").desc()]
    (rows.repartitionByRange(n, *order).sortWithinPartitions(*order).write.partitionBy("bucket", "reading_date")
     .option("parquet.bloom.filter.enabled#patient_key", "true")
     .option("parquet.bloom.filter.expected.ndv#patient_key", str(keys_per_file)).parquet(path))
    spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(os.path.join(path, LAYOUT))


def _bucket_rows(spark: SparkSession, path: str, patient_id: str) -> DataFrame | None:
    """The bucket of a patient; None where nothing is stored in it."""
    buckets = spark.read.parquet(os.path.join(path, LAYOUT)).first().buckets
    # folded by the optimizer, so no job runs
    bucket = spark.sql("SELECT 1 AS one").select(bucket_of(patient_key(F.lit(patient_id)), buckets)).first()[0]
    try:
        return spark.read.option("basePath", path).parquet(os.path.join(path, f"bucket={bucket}"))
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def stored_dates(rows: DataFrame) -> list[dt.date | None]:
    """The dates of a bucket's folders, newest first, the one of rows without a time last; from the file listing alone."""
    named = {m.group(1) for f in rows.inputFiles() if (m := re.search(r"/reading_date=([^/]+)/", unquote(f)))}
    dates = sorted((dt.date.fromisoformat(d) for d in named if d[0].isdigit()), reverse=True)
    return dates + [None] * any(not d[0].isdigit() for d in named)


def _on(dates: list) -> Column:
    days = [d for d in dates if d is not None]
    cond = F.col("reading_date").isin(days) if days else F.lit(False)
    return cond | F.col("reading_date").isNull() if None in dates else cond


def lookup_last_n(spark: SparkSession, path: str, patient_id: str, n: int = LAST_N, metric_type: str | None = None) -> DataFrame:
    """W1/W2 over a lookup table: the newest n readings of a patient (of one metric).  A date's rows are all newer than
    those of the dates before, so the dates seen once n rows are found hold the result."""
    rows = _bucket_rows(spark, path, patient_id)
    if rows is None:
        return spark.createDataFrame([], "patient_id string, reading_timestamp timestamp_ntz, metric_type string, value double, "
                                         "unit string, is_abnormal boolean")
    own = rows.where(F.col("patient_key") == patient_key(F.lit(patient_id)))
    if metric_type is not None:
        own = own.where(F.col("metric_type") == metric_type)
    dates = stored_dates(rows)
    seen, found, step = 0, 0, FIRST_DATES
    while seen < len(dates) and found < n:
        found += own.where(_on(dates[seen:seen + step])).limit(n - found).count()
        seen, step = min(seen + step, len(dates)), 2 * step
    return own.where(_on(dates[:seen])).orderBy(*newest_first()).limit(n).select(*LAST_N_COLUMNS)
