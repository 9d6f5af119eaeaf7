"""Patient documents with notes and risk history as child rows.

An update appends rows and folds the newest score and time into the documents;
both are aggregates that are reduced map-side, so a patient with a third of
all updates is never one row of one task.  ``assemble`` builds the arrays of
the nested document, for an export or a point read of chosen patients.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from .documents import KEY, flatten_patients, fold

# what orders the entries of a patient: the batch that brought them (0: the document itself), then seq
ORDER = ["batch", "seq"]


@dataclass(frozen=True)
class PatientTables:
    documents: DataFrame    # one row a patient, both arrays empty
    notes: DataFrame        # patient_id, batch, seq, date, doctor, note
    history: DataFrame      # patient_id, batch, seq, score, calculated_at, factors


def split(patients: DataFrame) -> PatientTables:
    def rows(array: str) -> DataFrame:
        return (patients.select(KEY, F.posexplode(array).alias("seq", "x"))
                .select(KEY, F.lit(0).alias("batch"), F.col("seq").cast("long").alias("seq"), "x.*"))

    empty = {c: F.lit(None).cast(S.PATIENT_SCHEMA[c].dataType) for c in ("medical_notes", "risk_score_history")}
    return PatientTables(patients.withColumns(empty), rows("medical_notes"), rows("risk_score_history"))


def _of_patients(rows: DataFrame, t: PatientTables) -> DataFrame:
    """Rows of patients that have a document."""
    return rows.join(t.documents.select(KEY), KEY, "left_semi")


def note_change(notes: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    """One row a patient, and the columns of a document that it sets."""
    return notes.groupBy(KEY).agg(F.max_by("at", "seq").alias("_at")), {"last_updated": F.col("_at")}


def note_rows(notes: DataFrame, batch: int) -> DataFrame:
    return notes.select(KEY, F.lit(batch).alias("batch"), "seq", F.col("at").alias("date"), "doctor", "note")


def add_notes(t: PatientTables, notes: DataFrame, batch: int = 1) -> PatientTables:
    """Append (seq, at, doctor, note); ``last_updated`` becomes the latest note's time."""
    return PatientTables(fold(t.documents, *note_change(notes)), t.notes.unionByName(_of_patients(note_rows(notes, batch), t)), t.history)


def score_change(updates: DataFrame) -> tuple[DataFrame, dict[str, Column]]:
    last = updates.groupBy(KEY).agg(F.max_by("new_score", "seq").alias("_score"), F.max_by("at", "seq").alias("_at"))
    return last, {"risk_score": F.col("_score"), "last_updated": F.col("_at")}


def history_rows(updates: DataFrame, batch: int) -> DataFrame:
    """History entries of the updates that carry factors."""
    return (updates.where(F.coalesce(F.size("factors") > 0, F.lit(False)))
            .select(KEY, F.lit(batch).alias("batch"), "seq", F.col("new_score").alias("score"), F.col("at").alias("calculated_at"), "factors"))


def update_scores(t: PatientTables, updates: DataFrame, batch: int = 1) -> PatientTables:
    """Set the newest score; updates with factors also enter the history."""
    return PatientTables(fold(t.documents, *score_change(updates)), t.notes, t.history.unionByName(_of_patients(history_rows(updates, batch), t)))


def _last(value: Column) -> Column:
    return F.max_by(value, F.struct(*ORDER))


def _with_counts(t: PatientTables, columns: list) -> DataFrame:
    notes = t.notes.groupBy(KEY).agg(F.count(F.lit(1)).alias("_notes"), _last(F.col("note")).alias("_note"))
    history = t.history.groupBy(KEY).agg(F.count(F.lit(1)).alias("_entries"),
                                         _last(F.struct("score", "factors")).alias("_entry"))
    return t.documents.select(KEY, *columns).join(notes, KEY, "left").join(history, KEY, "left")


def _number(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0)).cast("int")


def history_counts(t: PatientTables) -> DataFrame:
    """Number of risk-history entries and notes per patient."""
    return _with_counts(t, []).select(KEY, _number("_entries").alias("history_entries"), _number("_notes").alias("notes"))


def flatten(t: PatientTables) -> DataFrame:
    """``documents.flatten_patients`` of the tables, without building an array."""
    flat = flatten_patients(t.documents)
    own = [c for c in flat.columns if c not in (KEY, "history_entries", "last_history_score", "last_history_factors", "notes", "last_note")]
    counted = _with_counts(PatientTables(flat, t.notes, t.history), own)
    values = {"history_entries": _number("_entries"), "last_history_score": F.col("_entry.score"),
              "last_history_factors": F.array_join("_entry.factors", ","), "notes": _number("_notes"), "last_note": F.col("_note")}
    return counted.select(*[values[c].alias(c) if c in values else F.col(c) for c in flat.columns])


def assemble(t: PatientTables, ids: DataFrame | None = None) -> DataFrame:
    """Nested documents of all patients or of those in ``ids``: here each patient's entries meet in one row."""
    def arrays(rows: DataFrame, fields, name: str) -> DataFrame:
        if ids is not None:
            rows = rows.join(ids, KEY, "left_semi")
        entries = F.sort_array(F.collect_list(F.struct(*ORDER, F.struct(*fields).alias("x"))))
        return rows.groupBy(KEY).agg(F.transform(entries, lambda e: e["x"]).alias(name))

    docs = t.documents if ids is None else t.documents.join(ids, KEY, "left_semi")
    notes = arrays(t.notes, S.NOTE.fieldNames(), "_n")
    history = arrays(t.history, S.RISK_ENTRY.fieldNames(), "_h")
    return (docs.join(notes, KEY, "left").join(history, KEY, "left")
            .select(*[F.col({"medical_notes": "_n", "risk_score_history": "_h"}.get(c, c)).alias(c) for c in t.documents.columns]))
