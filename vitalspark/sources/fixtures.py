"""Readings, patients and update batches derived from the given tables.

The mapping is documented in FIXTURES.md: ``events`` become vital-sign
readings, ``customer`` rows become patient documents.  Every builder is a lazy
DataFrame expression over the scanned tables, so its work grows with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import values_table
from .tables import load_table


def metric_dim(spark: SparkSession, rows=None) -> DataFrame:
    """The metric dimension as a DataFrame (a handful of fixed rows)."""
    rows = S.TESTDATA_METRICS if rows is None else rows
    return values_table(spark, rows, ["metric_type", "threshold_min", "threshold_max", "unit"])


def vital_signs_dim(spark: SparkSession) -> DataFrame:
    """The monitoring devices' own vital-sign table (normal and abnormal bounds)."""
    return values_table(spark, S.VITAL_SIGNS, S.METRIC_DIM_SCHEMA.fieldNames())


def pad_id(prefix: str, col: Column, width: int) -> Column:
    """``prefix`` and the number padded to ``width`` digits; a longer number stays whole."""
    digits = col.cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.lit(width), F.length(digits)), F.lit("0")))


def readings_from_events(events: DataFrame, dim: DataFrame, keep_event_id: bool = False) -> DataFrame:
    """events ⋈ metric dimension → readings.

    The dimension has a fixed handful of rows, so broadcasting it is bounded
    and the events side is never shuffled.
    """
    e = events.alias("e")
    m = F.broadcast(dim).alias("m")
    cols = [
        pad_id("P", F.col("e.user_id"), 6).alias("patient_id"),
        F.col("e.ts").alias("reading_timestamp"),
        F.col("e.event_type").alias("metric_type"),
        F.col("e.value").alias("value"),
        F.col("m.unit").alias("unit"),
        F.concat(F.lit("DEV_"), F.get_json_object("e.props", "$.k")).alias("device_id"),
        ((F.col("e.value") < F.col("m.threshold_min"))
         | (F.col("e.value") > F.col("m.threshold_max"))).alias("is_abnormal"),
        F.col("m.threshold_min").alias("threshold_min"),
        F.col("m.threshold_max").alias("threshold_max"),
    ]
    if keep_event_id:
        cols.append(F.col("e.event_id").alias("event_id"))
    return e.join(m, F.col("m.metric_type") == F.col("e.event_type")).select(*cols)


def load_readings(spark: SparkSession, sf_dir: str, keep_event_id: bool = False) -> DataFrame:
    return readings_from_events(load_table(spark, sf_dir, "events"), metric_dim(spark), keep_event_id)


# --- patients -------------------------------------------------------------------

# fixed values: the constant history entry given to patients with a previous score
BASELINE_HISTORY_AT = "2023-12-01 00:00:00"
BASELINE_HISTORY_FACTORS = ["baseline"]


def patients_flat(customer: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    return customer.select(
        pad_id("P", k, 6).alias("patient_id"),
        F.col("c_name").alias("name"),
        F.expr("date_add(DATE'1940-01-01', CAST((c_custkey * 97) % 25000 AS INT))").alias("date_of_birth"),
        F.when(k % 3 == 0, "M").when(k % 3 == 1, "F").otherwise("Other").alias("gender"),
        F.col("c_mktsegment").alias("condition"),
        pad_id("+000", k, 9).alias("phone"),
        F.concat(F.lit("patient"), k.cast("string"), F.lit("@example.org")).alias("email"),
        F.element_at(F.array(*[F.lit(b) for b in S.BLOOD_TYPES]),
                     (F.col("c_nationkey") % 8 + 1).cast("int")).alias("blood_type"),
        ((k * 37 + 11) % 101).cast("int").alias("risk_score"),
        F.when(k % 4 == 0, F.lit(None).cast("int"))
         .otherwise(((k * 31) % 101).cast("int")).alias("prev_score"),
        k.alias("c_custkey"),
    )


def nest_patients(flat: DataFrame, keep_custkey: bool = False) -> DataFrame:
    """Flat patient rows → the nested patient document schema."""
    history_entry = F.struct(
        F.col("prev_score").alias("score"),
        F.lit(BASELINE_HISTORY_AT).cast("timestamp_ntz").alias("calculated_at"),
        F.array(*[F.lit(x) for x in BASELINE_HISTORY_FACTORS]).alias("factors"))
    doc = flat.select(
        F.col("patient_id"),
        F.struct(
            F.col("name"), F.col("date_of_birth"), F.col("gender"),
            F.struct(F.col("phone"), F.col("email"),
                     F.lit(None).cast(S.ADDRESS).alias("address")).alias("contact"),
        ).alias("personal_info"),
        F.struct(
            F.col("blood_type"),
            F.array().cast("array<string>").alias("allergies"),
            F.array(F.col("condition")).alias("chronic_conditions"),
            F.array().cast(f"array<{S.MEDICATION.simpleString()}>").alias("current_medications"),
        ).alias("medical_info"),
        F.col("risk_score"),
        F.when(F.col("prev_score").isNull(), F.lit(None))
         .otherwise(F.array(history_entry)).alias("risk_score_history"),
        F.lit(None).cast(f"array<{S.NOTE.simpleString()}>").alias("medical_notes"),
        F.lit(None).cast("timestamp_ntz").alias("last_updated"),
        *([F.col("c_custkey")] if keep_custkey else []),
    )
    return doc


def load_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nest_patients(patients_flat(load_table(spark, sf_dir, "customer")))


def dirty_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients with validator breaks: gender X (key % 50), risk 101 (% 70),
    no name (% 90) and duplicated documents (% 110)."""
    flat = patients_flat(load_table(spark, sf_dir, "customer"))
    k = F.col("c_custkey")
    flat = (flat
            .withColumn("gender", F.when(k % 50 == 0, "X").otherwise(F.col("gender")))
            .withColumn("risk_score", F.when(k % 70 == 0, F.lit(101)).otherwise(F.col("risk_score")))
            .withColumn("name", F.when(k % 90 == 0, F.lit(None).cast("string")).otherwise(F.col("name"))))
    doubled = flat.filter(k % 110 == 0)
    return nest_patients(flat.unionByName(doubled))


# --- update batches -------------------------------------------------------------

# fixed values: an update id that matches no patient, and the update instants
UNMATCHED_PATIENT_ID = "P999999999"
UPDATE_AT = "2024-02-01 08:00:00"


def profile_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Phone changes: key % 5 = 0 (seq 1), key % 15 = 0 again (seq 2), one unmatched id."""
    c = load_table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    first = c.filter(k % 5 == 0).select(pad_id("P", k, 6).alias("patient_id"), F.lit(1).cast("long").alias("seq"),
                                        pad_id("+000555", k, 6).alias("phone"))
    second = c.filter(k % 15 == 0).select(pad_id("P", k, 6).alias("patient_id"), F.lit(2).cast("long").alias("seq"),
                                          pad_id("+000666", k, 6).alias("phone"))
    stray = values_table(spark, [(UNMATCHED_PATIENT_ID, 1, "+000000000000")], ["patient_id", "seq", "phone"])
    return first.unionByName(second).unionByName(stray.withColumn("seq", F.col("seq").cast("long")))


def note_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Medical notes on the same patients as the profile updates."""
    p = profile_updates(spark, sf_dir)
    return p.select(
        "patient_id", "seq",
        F.concat(F.lit("Dr. "), F.expr("substring(patient_id, 2)")).alias("doctor"),
        F.concat(F.lit("note "), F.col("seq").cast("string"), F.lit(" for "), F.col("patient_id")).alias("note"),
        (F.lit(UPDATE_AT).cast("timestamp_ntz") + F.make_dt_interval(mins=F.col("seq").cast("int"))).alias("at"),
    )


def risk_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """key % 3 = 0: score + 10 capped at 95; factors empty for odd keys."""
    flat = patients_flat(load_table(spark, sf_dir, "customer"))
    k = F.col("c_custkey")
    return flat.filter(k % 3 == 0).select(
        "patient_id",
        F.lit(1).cast("long").alias("seq"),
        F.least(F.col("risk_score") + 10, F.lit(95)).cast("int").alias("new_score"),
        F.when(k % 2 == 1, F.array().cast("array<string>"))
         .otherwise(F.array(F.lit("recent_abnormal_readings"), F.lit("age_factor"))).alias("factors"),
        F.lit(UPDATE_AT).cast("timestamp_ntz").alias("at"),
    )


def reading_upserts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(base, incoming) for the upsert: base = every reading at seq 0; incoming
    = event_id % 10 = 0 with value + 1 (seq 1) and event_id % 20 = 0 with value + 2 (seq 2)."""
    r = load_readings(spark, sf_dir, keep_event_id=True)
    base = r.drop("event_id").withColumn("seq", F.lit(0).cast("long"))
    one = (r.filter(F.col("event_id") % 10 == 0).drop("event_id")
           .withColumn("value", F.col("value") + 1).withColumn("seq", F.lit(1).cast("long")))
    two = (r.filter(F.col("event_id") % 20 == 0).drop("event_id")
           .withColumn("value", F.col("value") + 2).withColumn("seq", F.lit(2).cast("long")))
    return base, one.unionByName(two)


# fixed values: broken messages come besides the readings, with offsets of their own
BROKEN_EVERY = 97
BROKEN_OFFSET = 5 * 10 ** 13
PARTITIONS = 10


def reading_messages(readings_with_id: DataFrame, broken_every: int | None = BROKEN_EVERY) -> DataFrame:
    """Every reading as a message: value = JSON bytes (timestamp as ISO text),
    timestamp = message time, partition and offset (= event_id).  Beside every
    ``broken_every``-th reading's message stands one more with a body that is
    no JSON, at an offset of its own."""
    body = F.to_json(F.struct(*[
        F.date_format("reading_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias(c) if c == "reading_timestamp"
        else F.col(c) for c in S.READING_COLUMNS]))
    whole = F.struct(body.cast("binary").alias("value"), F.col("event_id").alias("offset"))
    bodies = F.array(whole)
    if broken_every:
        broken = F.struct(F.lit("{bad").cast("binary").alias("value"), (F.col("event_id") + BROKEN_OFFSET).alias("offset"))
        bodies = F.when(F.col("event_id") % broken_every == 0, F.array(whole, broken)).otherwise(bodies)
    return (readings_with_id
            .select(F.explode(bodies).alias("m"), F.col("reading_timestamp").cast("timestamp").alias("timestamp"),
                    (F.col("event_id") % PARTITIONS).cast("int").alias("partition"))
            .select("m.value", "timestamp", "partition", "m.offset"))


def iso_time_readings(readings_with_id: DataFrame) -> DataFrame:
    """Readings with ISO-text timestamps; odd event ids carry a trailing Z."""
    iso = F.date_format("reading_timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return readings_with_id.withColumn(
        "reading_timestamp",
        F.when(F.col("event_id") % 2 == 1, F.concat(iso, F.lit("Z"))).otherwise(iso))
