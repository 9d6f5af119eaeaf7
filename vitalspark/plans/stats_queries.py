"""Registered statistics queries (A1–A11) and their oracle SQL."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..operators import daily_states, stats
from ..operators.transforms import with_patient_key
from ..sinks.files import write_readings_table
from ..sources.fixtures import load_patients, load_readings
from ..sources.readers import read_readings_table
from .registry import ORACLE, register
from .sql_fixtures import with_both, with_patients, with_readings
from .stored import stored

_ABN = "CAST(count_if(is_abnormal) AS BIGINT)"


@register("metric_summary", with_readings(f"""
SELECT metric_type, count(*) AS total_readings, round(avg(value), 2) AS avg_value,
       round(stddev_samp(value), 2) AS std_dev, round(min(value), 2) AS min_value,
       round(max(value), 2) AS max_value, {_ABN} AS abnormal_count,
       round(count_if(is_abnormal) / count(*) * 100, 2) AS abnormal_percentage
FROM readings GROUP BY metric_type ORDER BY metric_type"""))
def q_metric_summary(spark, sf_dir):
    return stats.metric_summary(load_readings(spark, sf_dir))


_PATIENT_SUMMARY = f"""ps AS (
  SELECT patient_id, count(*) AS total_readings, {_ABN} AS abnormal_readings,
         count(DISTINCT metric_type) AS metrics_measured,
         round(count_if(is_abnormal) / count(*) * 100, 2) AS abnormal_percentage,
         count_if(is_abnormal) / count(*) * 100 AS raw_percentage
  FROM readings GROUP BY patient_id)"""


def _with_ps(body):
    return with_readings(body, _PATIENT_SUMMARY)


@register("patient_summary", _with_ps(
    "SELECT patient_id, total_readings, abnormal_readings, metrics_measured, abnormal_percentage FROM ps"))
def q_patient_summary(spark, sf_dir):
    return stats.patient_summary(load_readings(spark, sf_dir))


@register("patient_summary_top10", _with_ps(
    "SELECT patient_id, total_readings, abnormal_readings, metrics_measured, abnormal_percentage FROM ps "
    "ORDER BY abnormal_percentage DESC, patient_id LIMIT 10"))
def q_patient_summary_top10(spark, sf_dir):
    return stats.patient_summary_top(load_readings(spark, sf_dir), 10)


@register("high_risk_patients", _with_ps(
    "SELECT patient_id, total_readings, abnormal_readings, metrics_measured, abnormal_percentage FROM ps "
    "WHERE abnormal_percentage > 20.0 ORDER BY abnormal_percentage DESC, patient_id LIMIT 20"))
def q_high_risk_patients(spark, sf_dir):
    return stats.high_risk_patients(load_readings(spark, sf_dir))


@register("high_risk_patients_raw", _with_ps(
    "SELECT patient_id, total_readings, abnormal_readings, metrics_measured, abnormal_percentage FROM ps "
    "WHERE raw_percentage > 20.0 ORDER BY abnormal_percentage DESC, patient_id"))
def q_high_risk_patients_raw(spark, sf_dir):
    return stats.high_risk_patients(load_readings(spark, sf_dir), limit=None, on_rounded=False)


@register("abnormality_rates", with_readings(f"""
SELECT metric_type, count(*) AS total, {_ABN} AS abnormal,
       round(count_if(is_abnormal) / count(*) * 100, 2) AS abnormal_rate
FROM readings GROUP BY metric_type ORDER BY abnormal_rate DESC, metric_type"""))
def q_abnormality_rates(spark, sf_dir):
    return stats.abnormality_rates(load_readings(spark, sf_dir))


@register("abnormality_rates_by_count", with_readings(f"""
SELECT metric_type, count(*) AS total, {_ABN} AS abnormal,
       round(count_if(is_abnormal) / count(*) * 100, 2) AS abnormal_rate
FROM readings GROUP BY metric_type ORDER BY abnormal DESC, metric_type"""))
def q_abnormality_rates_by_count(spark, sf_dir):
    return stats.abnormality_rates(load_readings(spark, sf_dir), order_by="count")


@register("device_activity", with_readings(f"""
SELECT device_id, count(*) AS total_readings, count(DISTINCT patient_id) AS patients_monitored,
       {_ABN} AS abnormal_readings, round(count_if(is_abnormal) / count(*) * 100, 2) AS abnormal_rate
FROM readings GROUP BY device_id ORDER BY total_readings DESC, device_id LIMIT 10"""))
def q_device_activity(spark, sf_dir):
    return stats.device_activity(load_readings(spark, sf_dir))


@register("device_activity_all", with_readings(f"""
SELECT device_id, count(*) AS total_readings, count(DISTINCT patient_id) AS patients_monitored,
       {_ABN} AS abnormal_readings, round(count_if(is_abnormal) / count(*) * 100, 2) AS abnormal_rate
FROM readings GROUP BY device_id"""))
def q_device_activity_all(spark, sf_dir):
    return stats.device_activity(load_readings(spark, sf_dir), top=None)


@register("hourly_distribution", with_readings(f"""
SELECT CAST(hour(reading_timestamp) AS INTEGER) AS hour, count(*) AS readings_count, {_ABN} AS abnormal_count
FROM readings GROUP BY 1 ORDER BY 1"""))
def q_hourly_distribution(spark, sf_dir):
    return stats.hourly_distribution(load_readings(spark, sf_dir))


@register("overall_summary", _with_ps("""
SELECT CAST(coalesce(sum(total_readings), 0) AS BIGINT) AS total_readings,
       count(*) AS total_patients,
       CAST(count_if(abnormal_percentage > 20.0) AS BIGINT) AS high_risk_patients,
       (SELECT count(DISTINCT device_id) FROM readings) AS total_devices,
       CAST(coalesce(sum(abnormal_readings), 0) AS BIGINT) AS total_abnormal,
       coalesce(round(sum(abnormal_readings) / sum(total_readings) * 100, 2), 0.0) AS overall_abnormal_rate
FROM ps"""))
def q_overall_summary(spark, sf_dir):
    return stats.overall_summary(load_readings(spark, sf_dir))


@register("risk_overview", with_patients("""
SELECT count(*) AS total_patients, round(avg(risk_score), 2) AS avg_risk_score,
       CAST(count_if(risk_score >= 70) AS BIGINT) AS high_risk_count,
       CASE WHEN count(*) > 0 THEN round(count_if(risk_score >= 70) / count(*) * 100, 2) END AS high_risk_percentage
FROM patients_flat"""))
def q_risk_overview(spark, sf_dir):
    return stats.risk_overview(load_patients(spark, sf_dir))


@register("dashboard_kpis", with_both(f"""
SELECT count(*) AS total_patients,
       (SELECT count(*) FROM readings) AS total_readings,
       (SELECT {_ABN} FROM readings) AS abnormal_readings,
       round(avg(risk_score), 2) AS avg_risk_score
FROM patients_flat"""))
def q_dashboard_kpis(spark, sf_dir):
    return stats.dashboard_kpis(load_patients(spark, sf_dir), load_readings(spark, sf_dir))


@register("next_patient_index", with_patients("""
SELECT coalesce(max(try_cast(substring(patient_id, 2) AS BIGINT)) + 1, 100000) AS next_index
FROM patients_flat"""))
def q_next_patient_index(spark, sf_dir):
    return stats.next_patient_index(load_patients(spark, sf_dir))


# --- the sections from partial figures a day ---------------------------------------------

_SECTIONS = {"metric_summary": "metric_summary", "patient_summary_top10": "patient_summary_top", "high_risk_patients": "high_risk_patients",
             "abnormality_rates": "abnormality_rates", "device_activity": "device_activity", "hourly_distribution": "hourly_distribution",
             "overall_summary": "overall_summary"}


def _day_states(spark, sf_dir):
    """The figures of all dates: first of those before the last one, then of the last one as a new day."""
    def write(path):
        table = stored(spark, sf_dir, "readings-table", lambda p: write_readings_table(with_patient_key(load_readings(spark, sf_dir)), p))
        readings = read_readings_table(spark, table)
        days = sorted(r[0] for r in readings.select("reading_date").distinct().collect())      # a row a day
        daily_states.write_days(readings, path, days[:-1])
        daily_states.write_days(readings, path, days[-1:])
    return stored(spark, sf_dir, "day-states", write)


def _by_day(section):
    def query(spark, sf_dir):
        groups = daily_states.merged_groups(spark, _day_states(spark, sf_dir))
        return stats.statistics_sections(groups=groups)[section]
    query.__doc__ = f"{section} merged from the figures of each day."
    return query


for _key, _section in _SECTIONS.items():
    register(f"by_day_{_key}")(_by_day(_section))
    ORACLE[f"by_day_{_key}"] = ORACLE[_key]


@register("day_states_range", with_readings("""
SELECT count(*) AS readings, count(DISTINCT patient_id) AS patients, count(DISTINCT device_id) AS devices FROM readings
WHERE reading_timestamp >= TIMESTAMP '2024-01-10' AND reading_timestamp < TIMESTAMP '2024-01-20'"""))
def q_day_states_range(spark, sf_dir):
    """Exact figures of ten days from their states alone."""
    groups = daily_states.merged_groups(spark, _day_states(spark, sf_dir), "2024-01-10", "2024-01-19")
    s = stats.group_summary(groups)
    return s.select(F.col("total_readings").alias("readings"), F.col("total_patients").alias("patients"), F.col("total_devices").alias("devices"))
