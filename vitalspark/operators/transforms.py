"""Projections, filters and predicates over readings and patient documents
(P1–P16).  All are narrow transformations (no shuffle) except P16, which is
one hash aggregate on the document key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.columns import event_time, ntz_literal, parse_reading_time, patient_key, status_label

FEED_COLUMNS = ["patient_id", "reading_timestamp", "metric_type", "value", "unit",
                "threshold_min", "threshold_max"]
RETENTION_DAYS = 90  # fixed value: time-to-live of a reading (7,776,000 s)
RECENT_HOURS = 24
CORRUPT = "_corrupt_record"


# --- messages -------------------------------------------------------------------

def parse_json_readings(messages: DataFrame, schema=S.READING_MESSAGE_SCHEMA,
                        message_time: str = "timestamp", keep=()) -> DataFrame:
    """Message bytes → JSON struct → flat reading columns + message time
    (+ ``keep`` columns such as the offset).  Malformed bodies yield all-NULL
    fields (see ``malformed_split``)."""
    return (messages
            .select(F.from_json(F.col("value").cast("string"), schema).alias("data"),
                    F.col(message_time).cast("timestamp_ntz").alias("message_timestamp"), *keep)
            .select("data.*", "message_timestamp", *keep))


def tag_malformed(messages: DataFrame, schema=S.READING_MESSAGE_SCHEMA) -> DataFrame:
    """One parse of every message: ``data`` (the reading struct), ``raw`` text,
    message time, the other message columns, ``reason`` and ``malformed``.
    PERMISSIVE parsing keeps the text of a body that is not a JSON object in
    ``_corrupt_record``; such a body (or a missing one) is malformed, and so is
    a reading without patient, metric or a time that can be read: it could not
    be stored under its key.  ``reason`` names the first of these."""
    full = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
    extra = [c for c in messages.columns if c not in ("value", "timestamp")]
    parsed = messages.select(
        F.from_json(F.col("value").cast("string"), full,
                    {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("data"),
        F.col("value").cast("string").alias("raw"),
        F.col("timestamp").cast("timestamp_ntz").alias("message_timestamp"), *extra)
    data = F.col("data")
    reason = F.when(data.isNull() | data[CORRUPT].isNotNull(), F.lit("not_json"))
    for c in S.READING_KEY:
        if c in schema.fieldNames():
            reason = reason.when(data[c].isNull(), F.lit(f"missing:{c}"))
    if dict((f.name, f.dataType.simpleString()) for f in schema.fields).get("reading_timestamp") == "string":
        reason = reason.when(parse_reading_time(data["reading_timestamp"]).isNull(), F.lit("unreadable:reading_timestamp"))
    return parsed.withColumn("reason", reason).withColumn("malformed", F.col("reason").isNotNull())


def malformed_split(messages: DataFrame, schema=S.READING_MESSAGE_SCHEMA) -> tuple[DataFrame, DataFrame]:
    """(good readings, dead letters) from one tagged parse; the raw text is
    kept in the dead-letter frame.  Persist ``messages`` (or run in
    ``foreachBatch`` on a persisted batch) when both outputs are written."""
    extra = [c for c in messages.columns if c not in ("value", "timestamp")]
    tagged = tag_malformed(messages, schema)
    good = tagged.filter(~F.col("malformed")).select("data.*", "message_timestamp", *extra).drop(CORRUPT)
    bad = tagged.filter(F.col("malformed")).select("raw", "reason", "message_timestamp", *extra)
    return good, bad


def add_processed_at(df: DataFrame) -> DataFrame:
    """Stamp processing time (once per query, as Spark evaluates now())."""
    return df.withColumn("processed_at", F.current_timestamp())


# --- readings -------------------------------------------------------------------

def abnormal_readings(readings: DataFrame) -> DataFrame:
    """The live abnormal feed (NULL flag counts as normal)."""
    return readings.filter(F.col("is_abnormal") == F.lit(True)).select(*FEED_COLUMNS)


def parse_reading_time_col(df: DataFrame, col: str = "reading_timestamp") -> DataFrame:
    """P5 + P6: ISO text (with 'T', optional 'Z') → TIMESTAMP_NTZ, NULL on junk."""
    return df.withColumn(col, parse_reading_time(col))


def with_event_time(df: DataFrame, col: str = "reading_timestamp", out: str = "event_time") -> DataFrame:
    """TIMESTAMP column for watermarks (input may be text or TIMESTAMP_NTZ)."""
    src = F.col(col)
    if dict(df.dtypes).get(col) == "string":
        src = parse_reading_time(col)
    return df.withColumn(out, event_time(src))


def with_patient_key(df: DataFrame, col: str = "patient_id", out: str = "patient_key") -> DataFrame:
    """Store key of a patient id (uuid5 unless the id already holds '-')."""
    return df.withColumn(out, patient_key(col))


def reading_status_label(readings: DataFrame) -> DataFrame:
    """P11: 'ABNORMAL' / 'Normal' next to each reading."""
    return readings.withColumn("status", status_label())


def prune_dates(readings: DataFrame, on_date: Column) -> DataFrame:
    """Add the date-partition condition implied by a time filter when the
    readings come from the reading table (partitioned by ``reading_date``):
    Spark then lists only those date folders.  The time filter itself stays;
    it is pushed to the Parquet row groups."""
    return readings.filter(on_date) if "reading_date" in readings.columns else readings


def recent_abnormal(readings: DataFrame, as_of, hours: int = RECENT_HOURS) -> DataFrame:
    """Abnormal readings strictly after ``as_of - hours`` (4 columns)."""
    cutoff = ntz_literal(as_of) - F.make_dt_interval(hours=F.lit(hours))
    return (prune_dates(readings, F.col("reading_date") >= F.to_date(cutoff))
            .filter((F.col("is_abnormal") == F.lit(True)) & (F.col("reading_timestamp") > cutoff))
            .select("patient_id", "metric_type", "value", "reading_timestamp"))


def readings_within_retention(readings: DataFrame, as_of, days: int = RETENTION_DAYS,
                              written_at: str = "reading_timestamp") -> DataFrame:
    """Rows whose time-to-live has not run out at ``as_of``.  A row lives
    while written_at > as_of - days; pass ``written_at`` if the write time is kept."""
    cutoff = ntz_literal(as_of) - F.make_dt_interval(days=F.lit(days))
    if written_at == "reading_timestamp":
        readings = prune_dates(readings, F.col("reading_date") >= F.to_date(cutoff))
    return readings.filter(F.col(written_at) > cutoff)


def classify_readings(readings: DataFrame, dim: DataFrame) -> DataFrame:
    """Attach the metric's range from the dimension and flag values
    outside [min, max], naming the bound broken.  The dimension is a fixed
    handful of rows: broadcasting it is bounded and keeps the readings side
    unshuffled (also as a stream–static join)."""
    base = readings.drop("is_abnormal", "threshold_min", "threshold_max", "unit")
    d = F.broadcast(dim.select("metric_type", "threshold_min", "threshold_max", "unit"))
    v, lo, hi = F.col("value"), F.col("threshold_min"), F.col("threshold_max")
    return (base.join(d, "metric_type", "inner")
            .withColumn("threshold_violated",
                        F.when(v < lo, F.lit("threshold_min")).when(v > hi, F.lit("threshold_max")))
            .withColumn("is_abnormal", F.col("threshold_violated").isNotNull())
            .select(*S.READING_COLUMNS, "threshold_violated"))


# --- patient documents -------------------------------------------------------------

def patient_by_id(patients: DataFrame, patient_id: str | None = None) -> DataFrame:
    """One document by id (or any one document when id is None)."""
    if patient_id is None:
        return patients.limit(1)
    return patients.filter(F.col("patient_id") == patient_id).limit(1)


def risk_score_by_id(patients: DataFrame, patient_id: str) -> DataFrame:
    """Point lookup with projection."""
    return (patients.filter(F.col("patient_id") == patient_id)
            .select("patient_id", "risk_score", "last_updated"))


def nested_projection(patients: DataFrame, default: str = "N/A") -> DataFrame:
    """P10: nested reads with a default for missing values (nested column
    pruning reads only these leaves from Parquet)."""
    return patients.select(
        "patient_id",
        F.coalesce(F.col("personal_info.name"), F.lit(default)).alias("name"),
        F.coalesce(F.col("personal_info.contact.phone"), F.lit(default)).alias("phone"),
        "risk_score")


def _reasons(patients: DataFrame) -> Column:
    pi = F.col("personal_info")
    checks = [F.when(F.col(c).isNull(), F.lit(f"missing:{c}")) for c in S.REQUIRED_PATIENT_FIELDS]
    checks += [F.when(pi.isNotNull() & pi[c].isNull(), F.lit(f"missing:personal_info.{c}"))
               for c in S.REQUIRED_PERSONAL_FIELDS]
    checks += [
        F.when(pi["gender"].isNotNull() & ~pi["gender"].isin(*S.GENDERS), F.lit("enum:personal_info.gender")),
        F.when(F.col("medical_info.blood_type").isNotNull()
               & ~F.col("medical_info.blood_type").isin(*S.BLOOD_TYPES), F.lit("enum:medical_info.blood_type")),
        F.when((F.col("risk_score") < 0) | (F.col("risk_score") > 100), F.lit("range:risk_score")),
    ]
    return F.array_compact(F.array(*checks))


def validate_patients(patients: DataFrame) -> DataFrame:
    """Documents with ``reasons`` (array of broken rules) and ``is_valid``."""
    return (patients.withColumn("reasons", _reasons(patients))
            .withColumn("is_valid", F.size("reasons") == 0))


def duplicate_patients(patients: DataFrame) -> DataFrame:
    """Ids held by more than one document (the unique index, as a check)."""
    return (patients.groupBy("patient_id").agg(F.count(F.lit(1)).alias("copies"))
            .filter(F.col("copies") > 1))
