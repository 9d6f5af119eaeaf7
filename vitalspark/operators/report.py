"""The daily report document (one row of scalars, structs and arrays).

The readings are scanned once, into one row a metric, a patient and a device
(grouping sets), written as a table; every section derives from it.  The arrays
hold one element a metric and at most ``high_risk_limit`` patients after a
top-k.  Each array is an uncorrelated scalar subquery, so the report needs no
join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import date_literal, ntz_literal, pct, round_half_up
from . import stats
from .transforms import prune_dates


def _arr(df: DataFrame, fields, before):
    """Scalar subquery: the rows of ``df`` as one sorted array of structs.
    ``before(a, b)`` orders two elements; the sort runs inside the subquery."""
    items = F.collect_list(F.struct(*fields))
    return df.select(F.array_sort(items, lambda a, b: F.when(before(a, b), F.lit(-1))
                                  .when(before(b, a), F.lit(1)).otherwise(F.lit(0)))).scalar()


def _before(a, b):
    """Ascending; a missing value comes first."""
    return F.coalesce(a < b, a.isNull() & b.isNotNull())


def _desc_then(key, tie):
    return lambda a, b: (a[key] > b[key]) | ((a[key] == b[key]) & _before(a[tie], b[tie]))


def readings_of_day(readings: DataFrame, day) -> DataFrame:
    """The readings of one date: a time range (pushed to the Parquet row groups)
    and, on the reading table, its date partition, so only that day is read."""
    start = date_literal(day).cast("timestamp_ntz")
    return (prune_dates(readings, F.col("reading_date") == date_literal(day))
            .filter((F.col("reading_timestamp") >= start)
                    & (F.col("reading_timestamp") < start + F.make_dt_interval(days=F.lit(1)))))


def daily_report(readings: DataFrame, report_date, generated_at, day=None,
                 high_risk_limit: int = stats.HIGH_RISK_LIMIT, groups: DataFrame | None = None) -> DataFrame:
    """The report of ``readings`` (optionally only those of ``day``), labelled
    with ``report_date`` and ``generated_at`` (parameters, never now()).
    ``groups``: ``stats.written_groups`` of the same readings when the caller
    already has them.  Averages are over the values that are there.  Readings
    without a metric are a group of their own, first among equals, so the
    sections add up to the summary."""
    if groups is None:
        groups = stats.written_groups(readings if day is None else readings_of_day(readings, day), stats.REPORT_SETS)
    summary = stats.group_summary(groups, on_rounded=False)
    per_patient = stats.group_patients(groups)
    raw = F.col("abnormal_readings") / F.col("total_readings") * 100
    per_metric = stats.group_metrics(groups).withColumnRenamed("abnormal_percentage", "abnormal_rate")
    metrics = _arr(per_metric, ["metric_type", "total_readings", "avg_value", "abnormal_count", "abnormal_rate"],
                   lambda a, b: _before(a["metric_type"], b["metric_type"]))
    rates_src = per_metric.select(F.col("metric_type").alias("metric"), F.col("abnormal_count").alias("count"),
                                  F.col("abnormal_rate").alias("rate"))
    rates = _arr(rates_src, ["metric", "count", "rate"], _desc_then("count", "metric"))
    high = (per_patient.filter(raw > stats.HIGH_RISK_PCT)
            .orderBy(F.desc("abnormal_percentage"), "patient_id").limit(high_risk_limit))
    high_arr = _arr(high, ["patient_id", "total_readings", "abnormal_readings", "abnormal_percentage"],
                    _desc_then("abnormal_percentage", "patient_id"))
    return summary.select(
        date_literal(report_date).alias("report_date"),
        ntz_literal(generated_at).alias("generated_at"),
        F.struct(*[F.col(c) for c in summary.columns]).alias("summary"),
        metrics.alias("metric_statistics"),
        rates.alias("abnormality_rates"),
        high_arr.alias("high_risk_patients"),
    )
