"""Schemas of readings, reading messages, patient documents and updates.

All timestamps leave our operators as TIMESTAMP_NTZ (wall-clock UTC); the
streaming operators convert to a TIMESTAMP instant only for the watermark
(through UTC, whatever the session zone) and convert back before they emit.
"""

from __future__ import annotations

from pyspark.sql import types as T

# Logical key of a reading (one row per patient, instant and metric).
READING_KEY = ("patient_id", "reading_timestamp", "metric_type")

# fixed values: the reading's fields, in the order of the source's messages and table
READING_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("reading_timestamp", T.TimestampNTZType()),
    T.StructField("metric_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
    T.StructField("unit", T.StringType()),
    T.StructField("device_id", T.StringType()),
    T.StructField("is_abnormal", T.BooleanType()),
    T.StructField("threshold_min", T.DoubleType()),
    T.StructField("threshold_max", T.DoubleType()),
])

READING_COLUMNS = [f.name for f in READING_SCHEMA.fields]

# A reading as it travels in a message: the timestamp is ISO text.
READING_MESSAGE_SCHEMA = T.StructType([
    f if f.name != "reading_timestamp" else T.StructField("reading_timestamp", T.StringType())
    for f in READING_SCHEMA.fields
])

METRIC_DIM_SCHEMA = T.StructType([
    T.StructField("metric_type", T.StringType()),
    T.StructField("threshold_min", T.DoubleType()),
    T.StructField("threshold_max", T.DoubleType()),
    T.StructField("abnormal_low", T.DoubleType()),
    T.StructField("abnormal_high", T.DoubleType()),
    T.StructField("unit", T.StringType()),
])

# --- fixed values: vital-sign ranges of the monitoring devices --------------
# metric, normal low, normal high, abnormal low, abnormal high, unit
VITAL_SIGNS = [
    ("heart_rate", 60.0, 100.0, 45.0, 120.0, "bpm"),
    ("blood_pressure_systolic", 90.0, 120.0, 80.0, 140.0, "mmHg"),
    ("blood_pressure_diastolic", 60.0, 80.0, 50.0, 90.0, "mmHg"),
    ("oxygen_saturation", 95.0, 100.0, 90.0, 100.0, "%"),
    ("temperature", 36.1, 37.2, 35.0, 38.5, "°C"),
    ("respiratory_rate", 12.0, 20.0, 10.0, 25.0, "breaths/min"),
]

# --- fixed values: test-data mapping (events.event_type -> metric) -----------
# metric, normal low, normal high, unit (abnormal bounds are not used here)
TESTDATA_METRICS = [
    ("click", 3.0, 120.0, "bpm"),
    ("view", 2.0, 110.0, "mmHg"),
    ("purchase", 3.0, 140.0, "%"),
    ("signup", 4.0, 100.0, "C"),
    ("error", 2.0, 130.0, "breaths/min"),
]

# Patient document (one fixed StructType, every field nullable).
ADDRESS = T.StructType([
    T.StructField("street", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("wilaya", T.StringType()),
    T.StructField("postal_code", T.StringType()),
])
CONTACT = T.StructType([
    T.StructField("phone", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("address", ADDRESS),
])
PERSONAL_INFO = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("date_of_birth", T.DateType()),
    T.StructField("gender", T.StringType()),
    T.StructField("contact", CONTACT),
])
MEDICATION = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("dosage", T.StringType()),
    T.StructField("frequency", T.StringType()),
    T.StructField("started", T.DateType()),
])
MEDICAL_INFO = T.StructType([
    T.StructField("blood_type", T.StringType()),
    T.StructField("allergies", T.ArrayType(T.StringType())),
    T.StructField("chronic_conditions", T.ArrayType(T.StringType())),
    T.StructField("current_medications", T.ArrayType(MEDICATION)),
])
RISK_ENTRY = T.StructType([
    T.StructField("score", T.IntegerType()),
    T.StructField("calculated_at", T.TimestampNTZType()),
    T.StructField("factors", T.ArrayType(T.StringType())),
])
NOTE = T.StructType([
    T.StructField("date", T.TimestampNTZType()),
    T.StructField("doctor", T.StringType()),
    T.StructField("note", T.StringType()),
])
PATIENT_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("personal_info", PERSONAL_INFO),
    T.StructField("medical_info", MEDICAL_INFO),
    T.StructField("risk_score", T.IntegerType()),
    T.StructField("risk_score_history", T.ArrayType(RISK_ENTRY)),
    T.StructField("medical_notes", T.ArrayType(NOTE)),
    T.StructField("last_updated", T.TimestampNTZType()),
])

# --- fixed values: document validator enums ---------------------------------
GENDERS = ["M", "F", "Other"]
BLOOD_TYPES = ["A+", "A-", "B+", "B-", "AB+", "AB-", "O+", "O-"]
REQUIRED_PATIENT_FIELDS = ["patient_id", "personal_info", "medical_info", "risk_score"]
REQUIRED_PERSONAL_FIELDS = ["name", "date_of_birth", "gender"]

# Update batches (one row per requested change; ``seq`` orders changes).
PROFILE_UPDATE_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("phone", T.StringType()),
])
NOTE_UPDATE_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("doctor", T.StringType()),
    T.StructField("note", T.StringType()),
    T.StructField("at", T.TimestampNTZType()),
])
RISK_UPDATE_SCHEMA = T.StructType([
    T.StructField("patient_id", T.StringType()),
    T.StructField("seq", T.LongType()),
    T.StructField("new_score", T.IntegerType()),
    T.StructField("factors", T.ArrayType(T.StringType())),
    T.StructField("at", T.TimestampNTZType()),
])
