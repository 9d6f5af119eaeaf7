"""Registered patient-document queries: lookups, validation, rankings and
mutations (P8–P10, P15–P16, W4–W5, U1–U6).  Nested outputs are compared
through ``flatten_patients``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import documents as D
from ..operators.document_store import DocumentStore
from ..operators import patient_tables as PT
from ..operators import recent, transforms
from ..session import work_path
from ..sinks.files import write_patients_table
from ..sources import fixtures as X
from ..sources.readers import read_patient_documents
from .registry import register
from .sql_fixtures import padded, with_patients
from .stored import stored

PATIENT = "P000007"
PROFILE_UPDATED_AT = "2024-02-01 09:00:00"

# flat view of the untouched documents (history = one baseline entry when prev_score is set)
_FLAT = """flat AS (
  SELECT patient_id, name, date_of_birth, gender, phone, email, blood_type, condition AS conditions,
         risk_score, CAST(CASE WHEN prev_score IS NULL THEN 0 ELSE 1 END AS INTEGER) AS history_entries,
         prev_score AS last_history_score,
         CASE WHEN prev_score IS NULL THEN NULL ELSE 'baseline' END AS last_history_factors,
         CAST(0 AS INTEGER) AS notes, CAST(NULL AS VARCHAR) AS last_note,
         CAST(NULL AS TIMESTAMP) AS last_updated, c_custkey
  FROM patients_flat)"""
_FLAT_COLS = ("patient_id, name, date_of_birth, gender, phone, email, blood_type, conditions, risk_score, "
              "history_entries, last_history_score, last_history_factors, notes, last_note, last_updated")


def _stored(spark, sf_dir):
    """The documents as a table clustered by patient, written and read back: a lookup reads the row groups of one id."""
    path = stored(spark, sf_dir, "patients-table", lambda p: write_patients_table(X.load_patients(spark, sf_dir), p))
    return read_patient_documents(spark, path, "parquet")


@register("patient_by_id", with_patients(f"SELECT {_FLAT_COLS} FROM flat WHERE patient_id = '{PATIENT}'", _FLAT))
def q_patient_by_id(spark, sf_dir):
    return D.flatten_patients(transforms.patient_by_id(_stored(spark, sf_dir), PATIENT))


@register("risk_score_by_id", with_patients(
    f"SELECT patient_id, risk_score, CAST(NULL AS TIMESTAMP) AS last_updated FROM patients_flat "
    f"WHERE patient_id = '{PATIENT}'"))
def q_risk_score_by_id(spark, sf_dir):
    return transforms.risk_score_by_id(_stored(spark, sf_dir), PATIENT)


@register("nested_projection", with_patients(
    "SELECT patient_id, coalesce(name, 'N/A') AS name, coalesce(phone, 'N/A') AS phone, risk_score "
    "FROM patients_flat"))
def q_nested_projection(spark, sf_dir):
    return transforms.nested_projection(X.load_patients(spark, sf_dir))


_DIRTY = """dirty AS (
  SELECT patient_id, CASE WHEN c_custkey % 90 = 0 THEN NULL ELSE name END AS name,
         CASE WHEN c_custkey % 50 = 0 THEN 'X' ELSE gender END AS gender, blood_type,
         CASE WHEN c_custkey % 70 = 0 THEN 101 ELSE risk_score END AS risk_score, c_custkey
  FROM patients_flat),
dirty_all AS (SELECT * FROM dirty UNION ALL SELECT * FROM dirty WHERE c_custkey % 110 = 0)"""


@register("validate_patients", with_patients("""
SELECT patient_id,
       concat_ws(';', CASE WHEN name IS NULL THEN 'missing:personal_info.name' END,
                      CASE WHEN gender NOT IN ('M', 'F', 'Other') THEN 'enum:personal_info.gender' END,
                      CASE WHEN risk_score < 0 OR risk_score > 100 THEN 'range:risk_score' END) AS reasons,
       (name IS NOT NULL AND gender IN ('M', 'F', 'Other') AND risk_score BETWEEN 0 AND 100) AS is_valid
FROM dirty_all""", _DIRTY))
def q_validate_patients(spark, sf_dir):
    v = transforms.validate_patients(X.dirty_patients(spark, sf_dir))
    return v.select("patient_id", F.array_join("reasons", ";").alias("reasons"), "is_valid")


@register("duplicate_patients", with_patients(
    "SELECT patient_id, count(*) AS copies FROM dirty_all GROUP BY patient_id HAVING count(*) > 1", _DIRTY))
def q_duplicate_patients(spark, sf_dir):
    return transforms.duplicate_patients(X.dirty_patients(spark, sf_dir))


@register("high_risk_by_score", with_patients(
    "SELECT patient_id, name, risk_score FROM patients_flat WHERE risk_score >= 70 "
    "ORDER BY risk_score DESC, patient_id LIMIT 10"))
def q_high_risk_by_score(spark, sf_dir):
    return recent.high_risk_by_score(X.load_patients(spark, sf_dir), 70, 10)


@register("ranked_high_risk", with_patients(
    "SELECT patient_id, name, risk_score, "
    "CAST(row_number() OVER (ORDER BY risk_score DESC, patient_id) AS INTEGER) AS rank "
    "FROM patients_flat WHERE risk_score >= 70 ORDER BY risk_score DESC, patient_id LIMIT 10"))
def q_ranked_high_risk(spark, sf_dir):
    return recent.ranked_high_risk(X.load_patients(spark, sf_dir), 70, 10)


# --- mutations ----------------------------------------------------------------------

_PROFILE_UPD = f"""upd AS (
  SELECT 'P' || {padded('c_custkey')} AS patient_id, 1 AS seq,
         '+000555' || {padded('c_custkey')} AS phone FROM customer WHERE c_custkey % 5 = 0
  UNION ALL
  SELECT 'P' || {padded('c_custkey')}, 2,
         '+000666' || {padded('c_custkey')} FROM customer WHERE c_custkey % 15 = 0
  UNION ALL SELECT '{X.UNMATCHED_PATIENT_ID}', 1, '+000000000000'),
notes_upd AS (
  SELECT patient_id, seq, 'Dr. ' || substr(patient_id, 2) AS doctor,
         'note ' || CAST(seq AS VARCHAR) || ' for ' || patient_id AS note,
         TIMESTAMP '{X.UPDATE_AT}' + seq * INTERVAL 1 MINUTE AS at
  FROM upd)"""

_RISK_UPD = f"""risk_upd AS (
  SELECT patient_id, 1 AS seq, CAST(least(risk_score + 10, 95) AS INTEGER) AS new_score,
         c_custkey % 2 = 0 AS has_factors, TIMESTAMP '{X.UPDATE_AT}' AS at
  FROM patients_flat WHERE c_custkey % 3 = 0)"""


@register("update_profiles", with_patients(f"""
SELECT f.patient_id, name, date_of_birth, gender, coalesce(l.phone, f.phone) AS phone, email, blood_type, conditions,
       risk_score, history_entries, last_history_score, last_history_factors, notes, last_note,
       CASE WHEN l.patient_id IS NOT NULL THEN TIMESTAMP '{PROFILE_UPDATED_AT}' END AS last_updated
FROM flat f LEFT JOIN (SELECT patient_id, arg_max(phone, seq) AS phone FROM upd GROUP BY patient_id) l
  ON l.patient_id = f.patient_id""", _FLAT, _PROFILE_UPD))
def q_update_profiles(spark, sf_dir):
    docs = D.update_profiles(X.load_patients(spark, sf_dir), X.profile_updates(spark, sf_dir), PROFILE_UPDATED_AT)
    return D.flatten_patients(docs)


@register("add_medical_notes", with_patients("""
SELECT f.patient_id, name, date_of_birth, gender, phone, email, blood_type, conditions, risk_score,
       history_entries, last_history_score, last_history_factors,
       CAST(coalesce(n.k, 0) AS INTEGER) AS notes, n.last_note, n."at" AS last_updated
FROM flat f LEFT JOIN (SELECT patient_id, count(*) AS k, arg_max(note, seq) AS last_note, arg_max("at", seq) AS "at"
                       FROM notes_upd GROUP BY patient_id) n ON n.patient_id = f.patient_id""",
    _FLAT, _PROFILE_UPD))
def q_add_medical_notes(spark, sf_dir):
    return PT.flatten(PT.add_notes(PT.split(X.load_patients(spark, sf_dir)), X.note_updates(spark, sf_dir)))


_RISK_FLAT = f"""SELECT f.patient_id, name, date_of_birth, gender, phone, email, blood_type, conditions,
       coalesce(r.new_score, f.risk_score) AS risk_score,
       CAST(history_entries + CASE WHEN r.has_factors THEN 1 ELSE 0 END AS INTEGER) AS history_entries,
       CASE WHEN r.has_factors THEN r.new_score ELSE last_history_score END AS last_history_score,
       CASE WHEN r.has_factors THEN 'recent_abnormal_readings,age_factor' ELSE last_history_factors END
         AS last_history_factors,
       notes, last_note, r."at" AS last_updated
FROM flat f LEFT JOIN risk_upd r ON r.patient_id = f.patient_id"""


@register("update_risk_scores", with_patients(_RISK_FLAT, _FLAT, _RISK_UPD))
def q_update_risk_scores(spark, sf_dir):
    return PT.flatten(PT.update_scores(PT.split(X.load_patients(spark, sf_dir)), X.risk_updates(spark, sf_dir)))


@register("bulk_risk_update", with_patients("""
SELECT count(*) AS updates, count(*) AS matched, count(*) AS updated,
       CAST(count_if(r.new_score <> p.risk_score) AS BIGINT) AS score_changed
FROM risk_upd r JOIN patients_flat p USING (patient_id)""", _RISK_UPD))
def q_bulk_risk_update(spark, sf_dir):
    _, summary = D.bulk_risk_update(X.load_patients(spark, sf_dir), X.risk_updates(spark, sf_dir).drop("seq"))
    return summary


@register("update_match_report", with_patients("""
SELECT l.patient_id, p.patient_id IS NOT NULL AS matched, p.patient_id IS NOT NULL AS modified,
       (p.patient_id IS NOT NULL AND l.phone IS DISTINCT FROM p.phone) AS field_changed
FROM (SELECT patient_id, arg_max(phone, seq) AS phone FROM upd GROUP BY patient_id) l
LEFT JOIN patients_flat p ON p.patient_id = l.patient_id""", _PROFILE_UPD))
def q_update_match_report(spark, sf_dir):
    return D.profile_match_report(X.load_patients(spark, sf_dir), X.profile_updates(spark, sf_dir))


@register("history_counts", with_patients("""
SELECT f.patient_id,
       CAST(history_entries + CASE WHEN r.has_factors THEN 1 ELSE 0 END AS INTEGER) AS history_entries,
       CAST(coalesce(n.k, 0) AS INTEGER) AS notes
FROM flat f LEFT JOIN risk_upd r ON r.patient_id = f.patient_id
LEFT JOIN (SELECT patient_id, count(*) AS k FROM notes_upd GROUP BY patient_id) n ON n.patient_id = f.patient_id""",
    _FLAT, _PROFILE_UPD, _RISK_UPD))
def q_history_counts(spark, sf_dir):
    t = PT.add_notes(PT.split(X.load_patients(spark, sf_dir)), X.note_updates(spark, sf_dir))
    return PT.history_counts(PT.update_scores(t, X.risk_updates(spark, sf_dir)))


@register("bulk_risk_documents", with_patients(_RISK_FLAT, _FLAT, _RISK_UPD))
def q_bulk_risk_documents(spark, sf_dir):
    """U4: the documents that the bulk update gives."""
    docs, _ = D.bulk_risk_update(X.load_patients(spark, sf_dir), X.risk_updates(spark, sf_dir).drop("seq"))
    return D.flatten_patients(docs)


# --- the stored documents -------------------------------------------------------------


@register("document_store_updates", with_patients(f"""
SELECT f.patient_id, name, date_of_birth, gender, coalesce(l.phone, f.phone) AS phone, email, blood_type, conditions,
       coalesce(r.new_score, f.risk_score) AS risk_score,
       CAST(history_entries + CASE WHEN r.has_factors THEN 1 ELSE 0 END AS INTEGER) AS history_entries,
       CASE WHEN r.has_factors THEN r.new_score ELSE last_history_score END AS last_history_score,
       CASE WHEN r.has_factors THEN 'recent_abnormal_readings,age_factor' ELSE last_history_factors END AS last_history_factors,
       CAST(coalesce(l.k, 0) AS INTEGER) AS notes, l.last_note, coalesce(r."at", l."at") AS last_updated
FROM flat f
LEFT JOIN (SELECT patient_id, arg_max(phone, seq) AS phone, count(*) AS k, arg_max(note, seq) AS last_note, arg_max("at", seq) AS "at"
           FROM upd JOIN notes_upd USING (patient_id, seq) GROUP BY patient_id) l ON l.patient_id = f.patient_id
LEFT JOIN risk_upd r ON r.patient_id = f.patient_id""", _FLAT, _PROFILE_UPD, _RISK_UPD))
def q_document_store_updates(spark, sf_dir):
    """U1-U4 on stored documents: three batches, one of them run twice, and an old one that comes again late."""
    store = DocumentStore.create(X.load_patients(spark, sf_dir), work_path(spark, "documents"), 16)
    store.update_profiles(X.profile_updates(spark, sf_dir), PROFILE_UPDATED_AT, 1)
    store.add_notes(X.note_updates(spark, sf_dir), 2)
    store.add_notes(X.note_updates(spark, sf_dir), 2)
    store.update_scores(X.risk_updates(spark, sf_dir).drop("seq"), 3)
    store.update_profiles(X.profile_updates(spark, sf_dir), "2030-01-01 00:00:00", 1)
    return PT.flatten(store.tables())


_TOLD = """judged AS (
  SELECT *, concat_ws(';', CASE WHEN name IS NULL THEN 'missing:personal_info.name' END,
                      CASE WHEN gender NOT IN ('M', 'F', 'Other') THEN 'enum:personal_info.gender' END,
                      CASE WHEN risk_score < 0 OR risk_score > 100 THEN 'range:risk_score' END) AS broken,
         row_number() OVER (PARTITION BY patient_id) AS copy FROM dirty_all),
told AS (
  SELECT patient_id, risk_score, CASE WHEN broken <> '' THEN broken
    WHEN c_custkey % 3 = 0 OR copy > 1 THEN 'duplicate:patient_id' ELSE '' END AS reasons FROM judged)"""


@register("document_store_inserts", with_patients("""
SELECT 'stored' AS status, patient_id, risk_score, '' AS reasons FROM told WHERE reasons = ''
UNION ALL SELECT 'stored', patient_id, risk_score, '' FROM patients_flat WHERE c_custkey % 3 = 0
UNION ALL SELECT 'rejected', patient_id, risk_score, reasons FROM told WHERE reasons <> ''""", _DIRTY, _TOLD))
def q_document_store_inserts(spark, sf_dir):
    """K7 with P15 and P16: a third of the patients is stored; then all come, some broken, some twice, in a batch that is
    run twice."""
    some = X.nest_patients(X.patients_flat(X.load_table(spark, sf_dir, "customer")), keep_custkey=True)
    store = DocumentStore.create(some.where("c_custkey % 3 = 0").drop("c_custkey"), work_path(spark, "documents"), 16)
    for _ in range(2):
        store.insert(X.dirty_patients(spark, sf_dir), 1)
    out = store.tables().documents.select(F.lit("stored").alias("status"), "patient_id", "risk_score", F.lit("").alias("reasons"))
    return out.unionByName(store.rejected().select(F.lit("rejected").alias("status"), "patient_id", "risk_score", F.array_join("reasons", ";").alias("reasons")))
