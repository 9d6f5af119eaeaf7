"""Last-N readings and risk rankings.

Per-patient last-N (W3) ranks in two steps, within (patient, one of SPREAD
buckets of its readings) and then within the patient.  Spark plans each with a
partial WindowGroupLimit before the exchange.  So however many input tasks hold
readings of one patient, their candidates meet in SPREAD tasks, and the last
step gets at most n * SPREAD rows of a patient.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import patient_key

LAST_N = 20
TOP_RISK = 10
SPREAD = 64
RISK_THRESHOLD = 70

LAST_N_COLUMNS = ["patient_id", "reading_timestamp", "metric_type", "value", "unit", "is_abnormal"]


def newest_first():
    return [F.col("reading_timestamp").desc(), F.col("metric_type").asc()]


def last_n_readings(readings: DataFrame, patient_id: str, n: int = LAST_N,
                    metric_type: str | None = None) -> DataFrame:
    """Newest n readings of one patient (optionally one metric);
    ties in time ordered by metric, as the store's clustering order does.  A
    table that holds the store's patient key is looked up by that (P7), so the
    id may be given in either form; the condition reaches the Parquet scan."""
    if "patient_key" in readings.columns:
        cond = F.col("patient_key") == patient_key(F.lit(patient_id))
    else:
        cond = F.col("patient_id") == patient_id
    if metric_type is not None:
        cond = cond & (F.col("metric_type") == metric_type)
    return readings.filter(cond).orderBy(*newest_first()).limit(n).select(*LAST_N_COLUMNS)


def last_n_all_patients(readings: DataFrame, n: int = LAST_N) -> DataFrame:
    """Newest n readings of every patient in one pass, with their rank."""
    spread = F.pmod(F.xxhash64("reading_timestamp", "metric_type"), F.lit(SPREAD))
    part = Window.partitionBy("patient_id", "_spread").orderBy(*newest_first())
    w = Window.partitionBy("patient_id").orderBy(*newest_first())
    near = (readings.withColumn("_spread", spread).withColumn("_rank", F.row_number().over(part))
            .filter(F.col("_rank") <= n).drop("_rank", "_spread"))
    return (near.withColumn("reading_rank", F.row_number().over(w))
            .filter(F.col("reading_rank") <= n)
            .select(*LAST_N_COLUMNS, "reading_rank"))


def high_risk_by_score(patients: DataFrame, threshold: int = RISK_THRESHOLD, n: int = TOP_RISK) -> DataFrame:
    """Patients at/above the risk threshold, highest first, first n."""
    return (patients.filter(F.col("risk_score") >= threshold)
            .orderBy(F.desc("risk_score"), "patient_id").limit(n)
            .select("patient_id", F.col("personal_info.name").alias("name"), "risk_score"))


def ranked_high_risk(patients: DataFrame, threshold: int = RISK_THRESHOLD, n: int = TOP_RISK) -> DataFrame:
    """W4 with rank 1..n.  The global window runs over the <= n rows left
    after the top-k, never over the whole table."""
    top = high_risk_by_score(patients, threshold, n)
    w = Window.orderBy(F.desc("risk_score"), "patient_id")
    return top.withColumn("rank", F.row_number().over(w))
