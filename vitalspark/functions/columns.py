"""Column expressions shared by the operators (all native, no UDF)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: the RFC 4122 DNS namespace used for name-based patient keys
NAMESPACE_DNS_HEX = "6ba7b8109dad11d180b400c04fd430c8"


def ntz_literal(t) -> Column:
    """A wall-clock instant (ISO text or datetime) as a TIMESTAMP_NTZ literal.
    Passed as text: a Python datetime literal would go through the local zone."""
    if isinstance(t, dt.datetime):
        t = t.isoformat(sep=" ")
    return F.lit(str(t)).cast("timestamp_ntz")


def date_literal(d) -> Column:
    return F.lit(d.isoformat() if isinstance(d, dt.date) else str(d)).cast("date")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(x, scale: int = 2) -> Column:
    """HALF_UP rounding of the value taken at 12 decimals.  A mean such as
    1.025 may come out one bit below or above the half-way point depending on
    summation order; fixing 12 decimals first makes the rounding independent
    of that noise (the SQL oracles state the same rule)."""
    return F.round(_c(x).cast("decimal(38,12)"), scale).cast("double")


def pct(part, whole, scale: int = 2) -> Column:
    """round(part / whole * 100, scale); NULL when whole is 0."""
    return round_half_up(F.try_divide(_c(part), _c(whole)) * 100, scale)


def abnormal_count(flag="is_abnormal") -> Column:
    """Count of rows whose flag is true (NULL counts as normal)."""
    return F.count_if(_c(flag) == F.lit(True))


def status_label(flag="is_abnormal") -> Column:
    return F.when(_c(flag), F.lit("ABNORMAL")).otherwise(F.lit("Normal"))


def patient_key(patient_id="patient_id") -> Column:
    """Name-based UUID (version 5, DNS namespace) of an id without '-';
    ids that already hold '-' pass unchanged.  Pure column arithmetic:
    sha1(namespace bytes || utf-8 id), version nibble 5, variant bits 10."""
    pid = _c(patient_id)
    h = F.sha1(F.concat(F.unhex(F.lit(NAMESPACE_DNS_HEX)), F.encode(pid, "UTF-8")))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    uuid5 = F.concat_ws(
        "-",
        F.substring(h, 1, 8),
        F.substring(h, 9, 4),
        F.concat(F.lit("5"), F.substring(h, 14, 3)),
        F.concat(variant, F.substring(h, 18, 3)),
        F.substring(h, 21, 12),
    )
    return F.when(pid.contains("-"), pid).otherwise(uuid5)


def normalize_reading_time(text="reading_timestamp") -> Column:
    """ISO text → 'yyyy-MM-dd HH:mm:ss[.ffffff]': 'T' → blank, trailing 'Z' dropped."""
    return F.regexp_replace(F.translate(_c(text), "T", " "), "Z$", "")


def parse_reading_time(text="reading_timestamp") -> Column:
    """ISO text → TIMESTAMP_NTZ wall clock in UTC; junk becomes NULL instead of
    failing the job.  Text without a zone is taken as UTC ('Z' included); text
    with an offset (+02:00) is moved to UTC."""
    t = F.translate(_c(text), "T", " ")
    with_offset = t.rlike(r"[+-]\d\d:?\d\d$")
    instant = F.try_to_timestamp(t)  # honours the offset
    plain = F.try_to_timestamp(F.regexp_replace(t, "Z$", "")).cast("timestamp_ntz")
    return F.when(with_offset, wall_clock_utc(instant)).otherwise(plain)


def event_time(c="reading_timestamp") -> Column:
    """A reading time (TIMESTAMP_NTZ wall clock in UTC) → the TIMESTAMP instant
    a watermark needs, whatever the session time zone is."""
    local = F.convert_timezone(F.lit("UTC"), F.current_timezone(), _c(c).cast("timestamp_ntz"))
    return local.cast("timestamp")


def wall_clock_utc(c) -> Column:
    """A TIMESTAMP instant (e.g. a window bound) → TIMESTAMP_NTZ wall clock in UTC."""
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), _c(c).cast("timestamp_ntz"))


def sql_literal(v) -> str:
    """A Python scalar as a Spark SQL literal (for inline VALUES tables)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return "'" + str(v).replace("'", "''") + "'"


def values_table(spark, rows, columns: list[str]):
    """A small fixed table as an inline VALUES relation.  Spark plans it as a
    local relation: broadcasting it needs no job, and its size is known."""
    body = ", ".join("(" + ", ".join(sql_literal(v) for v in r) + ")" for r in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")
