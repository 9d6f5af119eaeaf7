"""Windowed stream operators.

Each is a plain DataFrame function: on a stream it becomes a stateful query
(state keyed by window and group, evicted by the watermark); on a batch frame
the same code gives the batch answer, which is how the tests check it.

Exact distinct counts per window (T4) and per-patient totals over metrics
(T6) are two chained aggregates — Spark refuses ``count(DISTINCT)`` on a
stream, and chained stateful aggregates run in append mode.  The first level
is partially aggregated before its shuffle, so a patient or metric that holds
a third of the rows arrives at the state store pre-summed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import abnormal_count, pct, round_half_up, wall_clock_utc
from ..operators.transforms import abnormal_readings

ALERT_MIN = 2


def _ntz(c):
    return wall_clock_utc(c)


def abnormal_feed(readings: DataFrame) -> DataFrame:
    """Every abnormal reading, once (append)."""
    return abnormal_readings(readings)


def tumbling_metric_alerts(readings: DataFrame, window: str = "1 minute", min_count: int = ALERT_MIN,
                           rounded: bool = True, time_col: str = "event_time") -> DataFrame:
    """Abnormal readings per (tumbling window, patient, metric): count,
    avg, max, min; kept when the count reaches ``min_count``."""
    agg = (readings.filter(F.col("is_abnormal") == F.lit(True))
           .groupBy(F.window(time_col, window).alias("window"), "patient_id", "metric_type")
           .agg(F.count(F.lit(1)).alias("abnormal_count"), F.avg("value").alias("avg_value"),
                F.max("value").alias("max_value"), F.min("value").alias("min_value"))
           .filter(F.col("abnormal_count") >= min_count))
    r = (lambda c: round_half_up(c, 2)) if rounded else (lambda c: c)
    return agg.select(_ntz("window.start").alias("window_start"), _ntz("window.end").alias("window_end"),
                      "patient_id", "metric_type", "abnormal_count",
                      r(F.col("avg_value")).alias("avg_value"), r(F.col("max_value")).alias("max_value"),
                      r(F.col("min_value")).alias("min_value"))


def window_statistics(readings: DataFrame, window: str = "1 minute", time_col: str = "event_time") -> DataFrame:
    """T4: per window total, abnormal, exact distinct patients, abnormal %."""
    per_patient = (readings.groupBy(F.window(time_col, window).alias("window"), "patient_id")
                   .agg(F.count(F.lit(1)).alias("n"), abnormal_count().alias("a")))
    per_window = (per_patient.groupBy("window")
                  .agg(F.sum("n").alias("total_readings"), F.sum("a").alias("abnormal_readings"),
                       F.count(F.lit(1)).alias("unique_patients")))
    return per_window.select(_ntz("window.start").alias("period_start"), _ntz("window.end").alias("period_end"),
                             "total_readings", "abnormal_readings", "unique_patients",
                             pct("abnormal_readings", "total_readings").alias("abnormal_rate_pct"))


def window_statistics_approx(readings: DataFrame, window: str = "1 minute",
                             time_col: str = "event_time") -> DataFrame:
    """T4 for update mode: one aggregate, distinct patients by HyperLogLog++."""
    agg = (readings.groupBy(F.window(time_col, window).alias("window"))
           .agg(F.count(F.lit(1)).alias("total_readings"), abnormal_count().alias("abnormal_readings"),
                F.approx_count_distinct("patient_id").alias("unique_patients")))
    return agg.select(_ntz("window.start").alias("period_start"), _ntz("window.end").alias("period_end"),
                      "total_readings", "abnormal_readings", "unique_patients",
                      pct("abnormal_readings", "total_readings").alias("abnormal_rate_pct"))


def stream_running_totals(readings: DataFrame) -> DataFrame:
    """T5: messages so far, abnormal so far, rate (complete mode: one row)."""
    return (readings.agg(F.count(F.lit(1)).alias("total_readings"), abnormal_count().alias("abnormal_readings"))
            .withColumn("abnormal_rate_pct", pct("abnormal_readings", "total_readings")))


def patient_alerts_by_window(readings: DataFrame, window: str = "1 minute", min_total: int = ALERT_MIN,
                             time_col: str = "event_time") -> DataFrame:
    """Per (window, patient) the abnormal readings over all metrics, with
    the count per metric as a map; kept when the total reaches ``min_total``.
    The map holds one entry per metric, so it is bounded by the metric count."""
    per_metric = (readings.filter(F.col("is_abnormal") == F.lit(True))
                  .groupBy(F.window(time_col, window).alias("window"), "patient_id", "metric_type")
                  .agg(F.count(F.lit(1)).alias("n")))
    per_patient = (per_metric.groupBy("window", "patient_id")
                   .agg(F.sum("n").alias("total_abnormal"),
                        F.map_from_entries(F.sort_array(F.collect_list(F.struct("metric_type", "n"))))
                        .alias("metric_counts"))
                   .filter(F.col("total_abnormal") >= min_total))
    return per_patient.select(_ntz("window.start").alias("window_start"), _ntz("window.end").alias("window_end"),
                              "patient_id", "total_abnormal", "metric_counts")


def window_totals(readings: DataFrame, window: str = "1 minute", time_col: str = "event_time") -> DataFrame:
    """Per aligned tumbling window its end, readings, abnormal, rate."""
    agg = (readings.groupBy(F.window(time_col, window).alias("window"))
           .agg(F.count(F.lit(1)).alias("readings"), abnormal_count().alias("abnormal")))
    return agg.select(_ntz("window.end").alias("window_end"), "readings", "abnormal",
                      pct("abnormal", "readings").alias("abnormal_rate_pct"))
