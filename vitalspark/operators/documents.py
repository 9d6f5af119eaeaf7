"""Patient-document mutations (U1–U6) as set-based jobs.

Each job folds an update batch into the patient documents with one left join
on ``patient_id``.  The batch is first reduced to one row per patient (last
scalar by ``seq``, appended elements in ``seq`` order), so the join can never
multiply documents.  The per-patient batch is written once below the shared
checkpoint folder and counted from the written table (computed once, lineage
cut); under ``BROADCAST_ROWS`` rows and ``BROADCAST_BYTES`` of measured data it
is broadcast, so the documents are joined where they are read and never
shuffled.  A larger batch is a sort-merge join
on the patient key (AQE splits a skewed key).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import ntz_literal
from ..session import fits_broadcast, written_and_counted

KEY = "patient_id"
# Update batches up to this many patients are broadcast to the document scan.
BROADCAST_ROWS = 200_000


def sized(batch: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``batch`` written once, marked for broadcast when its row count is under
    ``limit`` and its measured size under ``BROADCAST_BYTES``."""
    written, n, nbytes = written_and_counted(batch, "update-batch")
    return F.broadcast(written) if fits_broadcast(n, nbytes, limit) else written


def _empty(elem_type) -> Column:
    return F.array().cast(f"array<{elem_type.simpleString()}>")


def _append(arr: str, new: Column, elem_type) -> Column:
    """arr ++ new, treating a missing array as empty (``array_append`` on NULL is NULL)."""
    return F.concat(F.coalesce(F.col(arr), _empty(elem_type)), new)


def _size0(c: str) -> Column:
    return F.when(F.col(c).isNull(), F.lit(0)).otherwise(F.size(c))


def fold(patients: DataFrame, per_patient: DataFrame, set_cols: dict[str, Column]) -> DataFrame:
    """Left-join the per-patient batch and replace the given top-level columns
    on matched rows; unmatched documents pass unchanged."""
    return fold_sized(patients, sized(per_patient.withColumn("_matched", F.lit(True))), set_cols)


def fold_sized(patients: DataFrame, u: DataFrame, set_cols: dict[str, Column]) -> DataFrame:
    """``fold`` of a batch already written and sized (with ``_matched``)."""
    joined = patients.join(u, KEY, "left")
    matched = F.col("_matched").isNotNull()
    out = [F.when(matched, set_cols[c]).otherwise(F.col(c)).alias(c) if c in set_cols else F.col(c)
           for c in patients.columns]
    return joined.select(*out)


# --- U1 profile fields --------------------------------------------------------------

def _profile_batch(updates: DataFrame, fields: dict[str, str]) -> DataFrame:
    # last non-NULL value per field wins (max_by skips rows whose ordering is NULL)
    aggs = [F.max_by(F.col(src), F.when(F.col(src).isNotNull(), F.col("seq"))).alias(src)
            for src in fields.values()]
    aggs.append(F.max("seq").alias("_seq"))
    return updates.groupBy(KEY).agg(*aggs)


def update_profiles(patients: DataFrame, updates: DataFrame, updated_at,
                    fields: dict[str, str] | None = None) -> DataFrame:
    """Set dotted nested fields (e.g. ``personal_info.contact.phone``) from
    update columns and stamp ``last_updated``; unmatched ids are ignored."""
    return fold(patients, *profile_change(updates, updated_at, fields))


def profile_change(updates: DataFrame, updated_at, fields: dict[str, str] | None = None) -> tuple[DataFrame, dict[str, Column]]:
    """One row a patient, and the columns of a document that it sets."""
    fields = fields or {"personal_info.contact.phone": "phone"}
    batch = _profile_batch(updates, fields)
    set_cols: dict[str, Column] = {}
    for path, src in fields.items():
        top, _, rest = path.partition(".")
        cur = set_cols.get(top, F.col(top))
        newv = F.coalesce(F.col(src), F.col(path))
        set_cols[top] = cur.withField(rest, newv) if rest else newv
    set_cols["last_updated"] = ntz_literal(updated_at)
    return batch.drop("_seq"), set_cols


# --- U2 medical notes ---------------------------------------------------------------

def add_medical_notes(patients: DataFrame, notes: DataFrame) -> DataFrame:
    """Append struct(date, doctor, note) in ``seq`` order; ``last_updated``
    becomes the latest note time."""
    batch = (notes.groupBy(KEY)
             .agg(F.sort_array(F.collect_list(F.struct("seq", "at", "doctor", "note"))).alias("_notes"),
                  F.max_by("at", "seq").alias("_at")))
    new = F.transform("_notes", lambda x: F.struct(x["at"].alias("date"), x["doctor"].alias("doctor"),
                                                   x["note"].alias("note")))
    return fold(patients, batch, {"medical_notes": _append("medical_notes", new, S.NOTE),
                                   "last_updated": F.col("_at")})


# --- U3/U4 risk scores --------------------------------------------------------------

def _risk_batch(updates: DataFrame) -> DataFrame:
    has_factors = F.coalesce(F.size("factors") > 0, F.lit(False))
    return (updates.groupBy(KEY)
            .agg(F.max_by("new_score", "seq").alias("_score"),
                 F.max_by("at", "seq").alias("_at"),
                 # collect_list skips the NULLs of updates without factors
                 F.sort_array(F.collect_list(F.when(has_factors, F.struct("seq", "new_score", "at", "factors"))))
                 .alias("_hist")))


def _risk_cols() -> dict[str, Column]:
    new = F.transform("_hist", lambda x: F.struct(x["new_score"].alias("score"), x["at"].alias("calculated_at"),
                                                  x["factors"].alias("factors")))
    return {
        "risk_score": F.col("_score"),
        "risk_score_history": F.when(F.size("_hist") > 0, _append("risk_score_history", new, S.RISK_ENTRY))
                               .otherwise(F.col("risk_score_history")),
        "last_updated": F.col("_at"),
    }


def update_risk_scores(patients: DataFrame, updates: DataFrame) -> DataFrame:
    """Set the score; append (score, calculated_at, factors) to the history
    only for updates that carry factors."""
    return fold(patients, _risk_batch(updates), _risk_cols())


def bulk_risk_update(patients: DataFrame, scores: DataFrame) -> tuple[DataFrame, DataFrame]:
    """U4: apply a score table (patient_id, new_score, factors, at[, seq]) to
    every patient in one job; returns (new documents, one-row summary).  The
    per-patient batch is built and written once for both.  Without ``seq`` the
    scores of one patient are ordered by ``at``; two at one time are an error."""
    batch = sized(_risk_batch(ordered_scores(scores)).withColumn("_matched", F.lit(True)))
    return fold_sized(patients, batch, _risk_cols()), score_summary(patients, batch)


def ordered_scores(scores: DataFrame) -> DataFrame:
    """Scores with a ``seq``: without one, by ``at``."""
    if "seq" in scores.columns:
        return scores
    if scores.groupBy(KEY, "at").count().where("count > 1").limit(1).count():
        raise ValueError("several scores of one patient at one time, and no seq column to order them")
    return scores.withColumn("seq", F.unix_micros(F.col("at").cast("timestamp")))


def score_summary(patients: DataFrame, batch: DataFrame) -> DataFrame:
    """One row: updates, matched and changed documents of a batch of scores (one row a patient, ``_score``)."""
    report = _match_sized(patients, batch, F.col("risk_score"), F.col("_score"), "score_changed")
    return report.agg(F.count(F.lit(1)).alias("updates"), F.count_if("matched").alias("matched"),
                      F.count_if("modified").alias("updated"), F.count_if("score_changed").alias("score_changed"))


# --- U5 match reports ---------------------------------------------------------------

def _match(patients: DataFrame, batch: DataFrame, old: Column, new: Column, name: str) -> DataFrame:
    return _match_sized(patients, sized(batch), old, new, name)


def _match_sized(patients: DataFrame, batch: DataFrame, old: Column, new: Column, name: str) -> DataFrame:
    docs = patients.select(KEY, old.alias("_old"), F.lit(True).alias("_doc"))
    j = batch.join(docs, KEY, "left")
    matched = F.col("_doc").isNotNull()
    return j.select(KEY, matched.alias("matched"),
                    # every matched update stamps last_updated, so it modifies the document
                    matched.alias("modified"),
                    (matched & ~new.eqNullSafe(F.col("_old"))).alias(name))


def profile_match_report(patients: DataFrame, updates: DataFrame, path="personal_info.contact.phone",
                         src="phone") -> DataFrame:
    """Per updated id, whether it matched a document and whether the field changed."""
    batch = _profile_batch(updates, {path: src})
    return _match(patients, batch, F.col(path), F.col(src), "field_changed")


def risk_match_report(patients: DataFrame, updates: DataFrame) -> DataFrame:
    batch = _risk_batch(updates)
    return _match(patients, batch, F.col("risk_score"), F.col("_score"), "score_changed")


# --- U6 history sizes ---------------------------------------------------------------

def history_counts(patients: DataFrame) -> DataFrame:
    """Number of risk-history entries and notes per patient (0 when absent)."""
    return patients.select(KEY, _size0("risk_score_history").alias("history_entries"),
                           _size0("medical_notes").alias("notes"))


# --- flat view for comparison and export ------------------------------------------------

def flatten_patients(patients: DataFrame) -> DataFrame:
    """One flat row per document: scalar leaves, array sizes and last elements."""
    hist, notes = F.col("risk_score_history"), F.col("medical_notes")
    return patients.select(
        KEY,
        F.col("personal_info.name").alias("name"),
        F.col("personal_info.date_of_birth").alias("date_of_birth"),
        F.col("personal_info.gender").alias("gender"),
        F.col("personal_info.contact.phone").alias("phone"),
        F.col("personal_info.contact.email").alias("email"),
        F.col("medical_info.blood_type").alias("blood_type"),
        F.array_join("medical_info.chronic_conditions", ",").alias("conditions"),
        "risk_score",
        _size0("risk_score_history").alias("history_entries"),
        F.try_element_at(hist, F.lit(-1))["score"].alias("last_history_score"),
        F.array_join(F.try_element_at(hist, F.lit(-1))["factors"], ",").alias("last_history_factors"),
        _size0("medical_notes").alias("notes"),
        F.try_element_at(notes, F.lit(-1))["note"].alias("last_note"),
        "last_updated",
    )
