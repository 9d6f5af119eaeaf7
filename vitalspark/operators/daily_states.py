"""A1-A8 by day: mergeable partial figures, one folder a date.

``write_days`` reads the dates that are new (date partitions of the reading
table) and writes two small tables: ``groups``, a row a date and group of the
statistics job with count, abnormal count, number and sum of values, their
squared distance from their mean, and range; and ``sketches``, a row a date with
HyperLogLog sketches of its patients and devices.  A date that is written again
takes its folder's place, the others stay.

``merged_groups`` folds any range of dates to the rows that ``figure_groups``
gives over all their readings, so every section and the report derive from it;
distinct figures are exact, from the (patient, metric) and (device, patient)
pairs.  ``approximate_distinct`` is the cheap form over the sketches alone.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .stats import GROUP_KEYS, STATISTICS_SETS, figure_groups

DATE = "reading_date"


def _on(days) -> Column:
    known = [d for d in days if d is not None]
    cond = F.col(DATE).isin(known) if known else F.lit(False)
    return cond | F.col(DATE).isNull() if None in days else cond


def write_days(readings: DataFrame, path: str, days=None) -> None:
    """The figures of ``days`` (all, if None) of a reading table with the column ``reading_date`` or of plain readings."""
    if DATE not in readings.columns:
        readings = readings.withColumn(DATE, F.to_date("reading_timestamp"))
    if days is not None:
        readings = readings.where(_on(days))

    def put(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(DATE).parquet(os.path.join(path, name))

    put(figure_groups(readings, STATISTICS_SETS, [DATE]).drop("sd"), "groups")
    put(readings.groupBy(DATE).agg(F.count(F.lit(1)).alias("n"), F.hll_sketch_agg("patient_id").alias("patients"),
                                   F.hll_sketch_agg("device_id").alias("devices")), "sketches")


def _between(df: DataFrame, first, last) -> DataFrame:
    """Without bounds also the readings without a time."""
    for bound, cond in ((first, F.col(DATE) >= F.lit(first).cast("date")), (last, F.col(DATE) <= F.lit(last).cast("date"))):
        df = df if bound is None else df.where(cond)
    return df


def merged_groups(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """The groups of all readings from date ``first`` to ``last``, with the columns of ``figure_groups``."""
    days = _between(spark.read.parquet(os.path.join(path, "groups")), first, last)
    keys = ["kind", *GROUP_KEYS]
    # the spread of values around the common mean: within the days, and of the days' means; a row a day meets in a group
    every = Window.partitionBy(*keys)
    mean = F.try_divide(F.sum("s").over(every), F.sum("nv").over(every))
    spread = F.coalesce(F.col("m2") + F.col("nv") * F.pow(F.try_divide("s", "nv") - F.col("_mean"), F.lit(2)), F.lit(0.0))
    out = (days.withColumn("_mean", mean).groupBy(*keys)
           .agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.sum("nv").alias("nv"), F.sum("s").alias("s"),
                F.sum(spread).alias("m2"), F.min("mn").alias("mn"), F.max("mx").alias("mx")))
    return out.select(*keys, "n", "a", "nv", "s", F.when(F.col("nv") > 1, F.sqrt(F.col("m2") / (F.col("nv") - 1))).alias("sd"), "m2", "mn", "mx")


def approximate_distinct(spark: SparkSession, path: str, first=None, last=None) -> DataFrame:
    """One row: readings, and about how many patients and devices they come from."""
    days = _between(spark.read.parquet(os.path.join(path, "sketches")), first, last)
    return days.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("readings"),
                    F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("patients")), F.lit(0)).alias("patients"),
                    F.coalesce(F.hll_sketch_estimate(F.hll_union_agg("devices")), F.lit(0)).alias("devices"))
