"""DuckDB forms of the fixture mapping (FIXTURES.md), for the oracle SQL.

Built from the same fixed values as the Spark side (``schemas``), so both
sides read the same dimension and the same patient rules.
"""

from __future__ import annotations

from .. import schemas as S


def padded(number: str, width: int = 6) -> str:
    """The number as text of at least ``width`` digits; a longer one stays whole."""
    return f"lpad(CAST({number} AS VARCHAR), CAST(greatest({width}, length(CAST({number} AS VARCHAR))) AS INTEGER), '0')"


def _metric_values() -> str:
    rows = ", ".join(
        f"('{m}', CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE), '{unit}')" for (m, lo, hi, unit) in S.TESTDATA_METRICS)
    return f"m(metric_type, threshold_min, threshold_max, unit) AS (VALUES {rows})"


READINGS_ID = f"""{_metric_values()},
readings_id AS (
  SELECT 'P' || {padded('e.user_id')} AS patient_id,
         e.ts AS reading_timestamp, e.event_type AS metric_type, e.value, m.unit,
         'DEV_' || json_extract_string(e.props, '$.k') AS device_id,
         (e.value < m.threshold_min OR e.value > m.threshold_max) AS is_abnormal,
         m.threshold_min, m.threshold_max, e.event_id
  FROM events e JOIN m ON m.metric_type = e.event_type),
readings AS (
  SELECT patient_id, reading_timestamp, metric_type, value, unit, device_id, is_abnormal,
         threshold_min, threshold_max FROM readings_id)"""

_BLOOD = "[" + ", ".join(f"'{b}'" for b in S.BLOOD_TYPES) + "]"

PATIENTS_FLAT = f"""patients_flat AS (
  SELECT 'P' || {padded('c_custkey')} AS patient_id, c_name AS name,
         DATE '1940-01-01' + CAST((c_custkey * 97) % 25000 AS INTEGER) AS date_of_birth,
         CASE c_custkey % 3 WHEN 0 THEN 'M' WHEN 1 THEN 'F' ELSE 'Other' END AS gender,
         c_mktsegment AS condition,
         '+000' || {padded('c_custkey', 9)} AS phone,
         'patient' || CAST(c_custkey AS VARCHAR) || '@example.org' AS email,
         ({_BLOOD})[c_nationkey % 8 + 1] AS blood_type,
         CAST((c_custkey * 37 + 11) % 101 AS INTEGER) AS risk_score,
         CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE CAST((c_custkey * 31) % 101 AS INTEGER) END AS prev_score,
         c_custkey
  FROM customer)"""


def with_readings(body: str, *more: str) -> str:
    extra = "".join(f",\n{m}" for m in more)
    return f"WITH {READINGS_ID}{extra}\n{body}"


def with_patients(body: str, *more: str) -> str:
    extra = "".join(f",\n{m}" for m in more)
    return f"WITH {PATIENTS_FLAT}{extra}\n{body}"


def with_both(body: str, *more: str) -> str:
    extra = "".join(f",\n{m}" for m in more)
    return f"WITH {READINGS_ID},\n{PATIENTS_FLAT}{extra}\n{body}"
