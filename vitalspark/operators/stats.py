"""Hospital-wide statistics (A1–A11): hash aggregates over one table.

Each function is lazy; Spark plans a partial (map-side) aggregate before the
exchange, so a hot key (one metric, device or patient holding a third of the
rows) reaches the final aggregate as one partial row per input partition.
Distinct counts go through Spark's distinct-aggregate rewrite, which first
shuffles on (group key, distinct column), so a hot group is spread over the
distinct values rather than landing in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import abnormal_count, pct, round_half_up
from ..session import materialize

# fixed values: alert thresholds and report sizes
HIGH_RISK_PCT = 20.0
HIGH_RISK_LIMIT = 20
TOP_PATIENTS = 10
TOP_DEVICES = 10
HIGH_RISK_SCORE = 70
FIRST_PATIENT_INDEX = 100000


def metric_summary(readings: DataFrame) -> DataFrame:
    """A1: per metric count, avg, sample stddev, min, max, abnormal count and %."""
    return (readings.groupBy("metric_type")
            .agg(F.count(F.lit(1)).alias("total_readings"),
                 round_half_up(F.avg("value"), 2).alias("avg_value"),
                 round_half_up(F.stddev_samp("value"), 2).alias("std_dev"),
                 round_half_up(F.min("value"), 2).alias("min_value"),
                 round_half_up(F.max("value"), 2).alias("max_value"),
                 abnormal_count().alias("abnormal_count"))
            .withColumn("abnormal_percentage", pct("abnormal_count", "total_readings"))
            .orderBy("metric_type"))


def patient_summary(readings: DataFrame) -> DataFrame:
    """A2: per patient count, abnormal count, distinct metrics, abnormal %."""
    return (readings.groupBy("patient_id")
            .agg(F.count(F.lit(1)).alias("total_readings"),
                 abnormal_count().alias("abnormal_readings"),
                 F.count_distinct("metric_type").alias("metrics_measured"))
            .withColumn("abnormal_percentage", pct("abnormal_readings", "total_readings")))


def patient_summary_top(readings: DataFrame, n: int = TOP_PATIENTS) -> DataFrame:
    """A2 report: the n patients with the highest abnormal % (ties by id)."""
    return patient_summary(readings).orderBy(F.desc("abnormal_percentage"), "patient_id").limit(n)


def _raw_pct(readings_summary: DataFrame) -> Column:
    return readings_summary["abnormal_readings"] / readings_summary["total_readings"] * 100


def high_risk_patients(readings: DataFrame, threshold: float = HIGH_RISK_PCT,
                       limit: int | None = HIGH_RISK_LIMIT, on_rounded: bool = True) -> DataFrame:
    """A3: patients whose abnormal % is strictly above ``threshold``, highest
    first, first ``limit`` (None = all).  ``on_rounded`` compares the rounded %
    (batch report) instead of the raw ratio (plain twin)."""
    return _high_risk(patient_summary(readings), threshold, limit, on_rounded)


def _high_risk(s: DataFrame, threshold, limit, on_rounded) -> DataFrame:
    cond = (s["abnormal_percentage"] if on_rounded else _raw_pct(s)) > threshold
    out = s.filter(cond).orderBy(F.desc("abnormal_percentage"), "patient_id")
    return out.limit(limit) if limit is not None else out


def abnormality_rates(readings: DataFrame, order_by: str = "rate") -> DataFrame:
    """A4: per metric total, abnormal, rate; by rate (or abnormal count) desc."""
    out = (readings.groupBy("metric_type")
           .agg(F.count(F.lit(1)).alias("total"), abnormal_count().alias("abnormal"))
           .withColumn("abnormal_rate", pct("abnormal", "total")))
    key = "abnormal_rate" if order_by == "rate" else "abnormal"
    return out.orderBy(F.desc(key), "metric_type")


def device_activity(readings: DataFrame, top: int | None = TOP_DEVICES) -> DataFrame:
    """A5: per device count, distinct patients, abnormal, rate; busiest first."""
    out = (readings.groupBy("device_id")
           .agg(F.count(F.lit(1)).alias("total_readings"),
                F.count_distinct("patient_id").alias("patients_monitored"),
                abnormal_count().alias("abnormal_readings")))
    return _busiest(out, top)


def _busiest(per_device: DataFrame, top) -> DataFrame:
    out = (per_device.withColumn("abnormal_rate", pct("abnormal_readings", "total_readings"))
           .orderBy(F.desc("total_readings"), "device_id"))
    return out.limit(top) if top is not None else out


def hourly_distribution(readings: DataFrame) -> DataFrame:
    """Readings and abnormal readings per hour of day."""
    return (readings.groupBy(F.hour("reading_timestamp").alias("hour"))
            .agg(F.count(F.lit(1)).alias("readings_count"), abnormal_count().alias("abnormal_count"))
            .orderBy("hour"))


def overall_summary(readings: DataFrame, threshold: float = HIGH_RISK_PCT, on_rounded: bool = True) -> DataFrame:
    """One row of totals (readings, patients, high-risk patients, devices,
    abnormal, overall rate; 0 when empty; a NULL patient or device is none) in one pass: one aggregate with the
    grouping sets (patient) and (device), then one global aggregate over its
    small output.  Each input row is expanded twice before the partial
    aggregate, so a hot patient or device is summed map-side."""
    g = (readings.groupingSets([["patient_id"], ["device_id"]], "patient_id", "device_id")
         .agg(F.count(F.lit(1)).alias("n"), abnormal_count().alias("a"), F.grouping_id().alias("gid")))
    is_patient = F.col("gid") == 1  # device_id rolled up
    raw = F.col("a") / F.col("n") * 100
    hot = is_patient & ((round_half_up(raw, 2) if on_rounded else raw) > threshold)
    return (g.agg(F.coalesce(F.sum(F.when(is_patient, F.col("n"))), F.lit(0)).cast("long").alias("total_readings"),
                  F.count_if(is_patient & F.col("patient_id").isNotNull()).alias("total_patients"),
                  F.count_if(hot).alias("high_risk_patients"),
                  F.count_if((F.col("gid") == 2) & F.col("device_id").isNotNull()).alias("total_devices"),
                  F.coalesce(F.sum(F.when(is_patient, F.col("a"))), F.lit(0)).cast("long").alias("total_abnormal"))
            .withColumn("overall_abnormal_rate",
                        F.coalesce(pct("total_abnormal", "total_readings"), F.lit(0.0))))


def risk_overview(patients: DataFrame, threshold: int = HIGH_RISK_SCORE) -> DataFrame:
    """Patients, average risk (2 decimals), count at/above threshold, % of all.
    NULL averages on empty input instead of a division error."""
    return (patients.agg(F.count(F.lit(1)).alias("total_patients"),
                         round_half_up(F.avg("risk_score"), 2).alias("avg_risk_score"),
                         F.count_if(F.col("risk_score") >= threshold).alias("high_risk_count"))
            .withColumn("high_risk_percentage",
                        F.when(F.col("total_patients") > 0, pct("high_risk_count", "total_patients"))))


def dashboard_kpis(patients: DataFrame, readings: DataFrame) -> DataFrame:
    """A10: the dashboard's four figures computed from the data."""
    # one scalar subquery (one scan of the readings) carrying both counts
    r = readings.agg(F.struct(F.count(F.lit(1)).alias("n"), abnormal_count().alias("a"))).scalar()
    return (patients.agg(F.count(F.lit(1)).alias("total_patients"),
                         round_half_up(F.avg("risk_score"), 2).alias("avg_risk_score"))
            .select("total_patients", r["n"].alias("total_readings"), r["a"].alias("abnormal_readings"),
                    "avg_risk_score"))


def next_patient_index(patients: DataFrame, first: int = FIRST_PATIENT_INDEX) -> DataFrame:
    """Numeric part of the greatest id + 1, or ``first`` when there is none."""
    num = F.expr("try_cast(substring(patient_id, 2) AS BIGINT)")
    return patients.agg(F.coalesce(F.max(num) + 1, F.lit(first).cast("long")).alias("next_index"))


# --- all sections from one scan (report and statistics job) ------------------------------

# What each figure needs of the readings: groups of one kind, whose number
# follows the metrics, patients and devices, not the readings.
REPORT_SETS = {"metric": ["metric_type"], "patient": ["patient_id"], "device": ["device_id"]}
# distinct metrics of a patient and distinct patients of a device need the pairs
STATISTICS_SETS = {"metric": ["metric_type"], "patient": ["patient_id", "metric_type"],
                   "device": ["device_id", "patient_id"], "hour": ["hour"]}


GROUP_KEYS = ["metric_type", "patient_id", "device_id", "hour"]


def figure_groups(readings: DataFrame, sets: dict[str, list[str]], by: list[str] | None = None) -> DataFrame:
    """One pass over the readings: a row for every group of every set (within each value of the columns ``by``), with
    its ``kind``, counts, sum of the values that are there, deviation, squared distance from their mean (m2) and range."""
    by = by or []
    keys = [*by, *GROUP_KEYS]
    r = readings.withColumn("hour", F.hour("reading_timestamp"))
    # grouping_id has a bit for each key that a set leaves out
    gid = {name: sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in by and k not in cols) for name, cols in sets.items()}
    kind = F.col("gid")
    named = None
    for name, g in gid.items():
        named = F.when(kind == g, name) if named is None else named.when(kind == g, name)
    return (r.groupingSets([[F.col(c) for c in (*by, *cols)] for cols in sets.values()], *keys)
            .agg(F.grouping_id().alias("gid"), F.count(F.lit(1)).alias("n"), abnormal_count().alias("a"),
                 F.count("value").alias("nv"), F.sum("value").alias("s"), F.stddev_samp("value").alias("sd"),
                 (F.var_pop("value") * F.count("value")).alias("m2"), F.min("value").alias("mn"), F.max("value").alias("mx"))
            .select(named.alias("kind"), *keys, "n", "a", "nv", "s", "sd", "m2", "mn", "mx"))


def written_groups(readings: DataFrame, sets: dict[str, list[str]]) -> DataFrame:
    """The one scan of the readings: ``figure_groups`` written once below the
    shared checkpoint folder (lineage cut; survives executor loss)."""
    return materialize(figure_groups(readings, sets), "figure-groups")


def group_patients(groups: DataFrame) -> DataFrame:
    return (groups.where("kind = 'patient'").groupBy("patient_id")
            .agg(F.sum("n").alias("total_readings"), F.sum("a").alias("abnormal_readings"),
                 F.count_distinct("metric_type").alias("metrics_measured"))
            .withColumn("abnormal_percentage", pct("abnormal_readings", "total_readings")))


def group_metrics(groups: DataFrame) -> DataFrame:
    return groups.where("kind = 'metric'").select(
        "metric_type", F.col("n").alias("total_readings"), F.col("a").alias("abnormal_count"),
        round_half_up(F.try_divide("s", "nv"), 2).alias("avg_value"), round_half_up("sd", 2).alias("std_dev"),
        round_half_up("mn", 2).alias("min_value"), round_half_up("mx", 2).alias("max_value"),
        pct("a", "n").alias("abnormal_percentage"))


def group_summary(groups: DataFrame, threshold: float = HIGH_RISK_PCT, on_rounded: bool = True) -> DataFrame:
    """A7 from written groups."""
    patients = group_patients(groups)
    raw = F.col("abnormal_readings") / F.col("total_readings") * 100
    hot = (round_half_up(raw, 2) if on_rounded else raw) > threshold
    devices = groups.where("kind = 'device'").agg(F.count_distinct("device_id")).scalar()
    return (patients.agg(F.coalesce(F.sum("total_readings"), F.lit(0)).cast("long").alias("total_readings"),
                         F.count("patient_id").alias("total_patients"), F.count_if(hot).alias("high_risk_patients"),
                         F.coalesce(F.sum("abnormal_readings"), F.lit(0)).cast("long").alias("total_abnormal"))
            .select("total_readings", "total_patients", "high_risk_patients", devices.alias("total_devices"),
                    "total_abnormal", F.coalesce(pct("total_abnormal", "total_readings"), F.lit(0.0)).alias("overall_abnormal_rate")))


def statistics_sections(readings: DataFrame | None = None, threshold: float = HIGH_RISK_PCT,
                        on_rounded: bool = True, high_risk_limit: int | None = HIGH_RISK_LIMIT,
                        top_patients: int = TOP_PATIENTS, top_devices: int | None = TOP_DEVICES,
                        groups: DataFrame | None = None) -> dict[str, DataFrame]:
    """A1–A7 from one scan of the readings, or from groups already written
    (``written_groups`` of STATISTICS_SETS), with the columns and order of the
    single-section functions above."""
    g = groups if groups is not None else written_groups(readings, STATISTICS_SETS)
    metrics, patients = group_metrics(g), group_patients(g)
    devices = (g.where("kind = 'device'").groupBy("device_id")
               .agg(F.sum("n").alias("total_readings"), F.count_distinct("patient_id").alias("patients_monitored"),
                    F.sum("a").alias("abnormal_readings")))
    return {
        "metric_summary": (metrics.select("metric_type", "total_readings", "avg_value", "std_dev", "min_value", "max_value",
                                          "abnormal_count", "abnormal_percentage").orderBy("metric_type")),
        "patient_summary_top": patients.orderBy(F.desc("abnormal_percentage"), "patient_id").limit(top_patients),
        "high_risk_patients": _high_risk(patients, threshold, high_risk_limit, on_rounded),
        "abnormality_rates": (metrics.select("metric_type", F.col("total_readings").alias("total"),
                                             F.col("abnormal_count").alias("abnormal"),
                                             F.col("abnormal_percentage").alias("abnormal_rate"))
                              .orderBy(F.desc("abnormal_rate"), "metric_type")),
        "device_activity": _busiest(devices, top_devices),
        "hourly_distribution": (g.where("kind = 'hour'").select("hour", F.col("n").alias("readings_count"),
                                                                F.col("a").alias("abnormal_count")).orderBy("hour")),
        "overall_summary": group_summary(g, threshold, on_rounded),
    }
