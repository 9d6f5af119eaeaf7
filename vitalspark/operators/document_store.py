"""Stored patient documents: updates rewrite the hash buckets that they touch (U1-U4), inserts are checked.

A store is three tables below one path: ``documents`` (one row a patient, in a
folder for each hash bucket of the id), and the child rows ``notes`` and
``history``, in a folder for each update batch.  A batch reads the buckets of
its patients alone, writes their new rows aside, and replaces those folders by
dynamic partition overwrite; all other files keep their names.  Child rows of a
batch are one folder, so nothing is appended twice.

Batches are numbered by the caller (1, 2, ...; the documents as loaded are batch
0).  Everything a batch sets is absolute, and a document remembers the last
batch that changed it: a batch that is run again, after a failure or twice,
gives the same store, and an older one that comes late changes no document that
a newer one has changed.  One writer at a time; a reader beside it may see some
buckets before and some after the batch.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..session import materialize
from . import documents as D
from . import patient_tables as PT
from .documents import KEY
from .patient_tables import PatientTables
from .transforms import validate_patients

BUCKETS = 64
LAYOUT = "_layout"      # a table of one row: the number of buckets
DOCUMENTS = T.StructType([*S.PATIENT_SCHEMA.fields, T.StructField("batch", T.IntegerType()), T.StructField("bucket", T.IntegerType())])
NOTES = T.StructType([T.StructField(KEY, T.StringType()), T.StructField("seq", T.LongType()), *S.NOTE.fields, T.StructField("batch", T.IntegerType())])
HISTORY = T.StructType([T.StructField(KEY, T.StringType()), T.StructField("seq", T.LongType()), *S.RISK_ENTRY.fields, T.StructField("batch", T.IntegerType())])


class DocumentStore:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self.buckets = spark.read.parquet(self._at(LAYOUT)).first().buckets

    @classmethod
    def create(cls, patients: DataFrame, path: str, buckets: int = BUCKETS) -> DocumentStore:
        """A new store of nested documents; an existing one is refused."""
        spark, t = patients.sparkSession, PT.split(patients)
        bucket = F.pmod(F.xxhash64(KEY), F.lit(buckets)).cast("int")
        docs = t.documents.withColumn("batch", F.lit(0)).withColumn("bucket", bucket)
        _clustered(docs).write.partitionBy("bucket").parquet(os.path.join(path, "documents"))
        t.notes.write.partitionBy("batch").parquet(os.path.join(path, "notes"))
        t.history.write.partitionBy("batch").parquet(os.path.join(path, "history"))
        spark.createDataFrame([(buckets,)], "buckets int").coalesce(1).write.parquet(os.path.join(path, LAYOUT))
        return cls(spark, path)

    def _at(self, name: str) -> str:
        return os.path.join(self.path, name)

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self._at(name))

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(KEY), F.lit(self.buckets)).cast("int")

    def documents_of(self, ids: DataFrame) -> tuple[DataFrame, list[int]]:
        """The documents in the buckets of these ids, and the buckets (no more than the store has)."""
        touched = sorted(r[0] for r in ids.select(self._bucket().alias("b")).distinct().collect())
        return self._read("documents", DOCUMENTS).where(F.col("bucket").isin(touched) if touched else F.lit(False)), touched

    def tables(self) -> PatientTables:
        return PatientTables(self._read("documents", DOCUMENTS).drop("batch", "bucket"), self._read("notes", NOTES), self._read("history", HISTORY))

    def document(self, patient_id: str) -> DataFrame:
        """P8 over the store: one nested document, from one bucket."""
        one = self.spark.sql("SELECT 1 AS one").select(F.lit(patient_id).alias(KEY))
        bucket = one.select(self._bucket()).first()[0]
        docs = self._read("documents", DOCUMENTS).where((F.col("bucket") == bucket) & (F.col(KEY) == patient_id)).drop("batch", "bucket")
        t = self.tables()
        return PT.assemble(PatientTables(docs, t.notes, t.history), one)

    def _apply(self, batch: int, per_patient: DataFrame, set_cols: dict[str, Column], children: tuple[str, DataFrame] | None = None) -> None:
        """Child rows first, then the documents: a batch that stops between leaves child rows that its next run replaces."""
        if batch < 1:
            raise ValueError("batches are numbered from 1")
        u = D.sized(per_patient.withColumn("_matched", F.lit(True)))
        docs, touched = self.documents_of(u)
        if children is not None:
            name, rows = children
            # the ids are those of the batch's buckets, read from one column
            (rows.join(docs.select(KEY), KEY, "left_semi").drop("batch")
             .write.mode("overwrite").parquet(os.path.join(self._at(name), f"batch={batch}")))
        if not touched:
            return
        newer = docs.where(F.col("batch") > batch)
        changed = D.fold_sized(docs.where(F.col("batch") <= batch), u, {**set_cols, "batch": F.lit(batch)})
        # written aside first: a folder is replaced only by rows that are already there
        aside = materialize(changed.unionByName(newer), "document-buckets")
        (_clustered(aside).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket").parquet(self._at("documents")))

    def update_profiles(self, updates: DataFrame, updated_at, batch: int, fields: dict[str, str] | None = None) -> None:
        """U1."""
        self._apply(batch, *D.profile_change(updates, updated_at, fields))

    def add_notes(self, notes: DataFrame, batch: int) -> None:
        """U2."""
        self._apply(batch, *PT.note_change(notes), ("notes", PT.note_rows(notes, batch)))

    def update_scores(self, updates: DataFrame, batch: int) -> DataFrame:
        """The scores (with ``seq``, or one a patient and time); the one-row summary, taken before the change."""
        updates = D.ordered_scores(updates)
        per_patient, set_cols = PT.score_change(updates)
        docs, _ = self.documents_of(per_patient)
        summary = materialize(D.score_summary(docs, per_patient), "score-summary")
        self._apply(batch, per_patient, set_cols, ("history", PT.history_rows(updates, batch)))
        return summary


    # --- K7 with P15 and P16 -------------------------------------------------------------------------------------------

    def insert(self, incoming: DataFrame, batch: int, seq: str | None = None) -> DataFrame:
        """Insert nested documents that are valid and whose id is new; the others go to ``rejected`` with their reasons.
        Of several valid documents with one id the first is inserted (by ``seq``, else by a hash of the document).
        Returns patient_id, accepted and reasons of every incoming document.

        Only the buckets of the incoming ids are read, one column of them; a large batch is joined with a runtime Bloom
        filter of its ids in front of that scan (Spark's own, on in ``CLUSTER_CONF``)."""
        if batch < 1:
            raise ValueError("batches are numbered from 1")
        own = S.PATIENT_SCHEMA.fieldNames()
        order = F.col(seq) if seq else F.xxhash64(*own)
        checked = validate_patients(incoming.select(*own, order.alias("_order"))).withColumn("_row", F.monotonically_increasing_id())
        checked = materialize(checked, "incoming-documents")
        ids = D.sized(checked.where("is_valid").select(KEY).distinct())
        docs, _ = self.documents_of(ids)
        # rows of this very batch are there from a run of it that failed
        there = docs.select(KEY, "batch").join(ids, KEY, "left_semi")
        there = there.select(KEY, F.when(F.col("batch") == batch, "before").otherwise("other").alias("_there"))
        first = checked.where("is_valid").groupBy(KEY).agg(F.min(F.struct("_order", "_row")).alias("_first"))
        known = (checked.join(there, KEY, "left").join(first, KEY, "left")
                 .withColumn("_again", (F.col("_there").eqNullSafe("other")) | (F.col("_row") != F.col("_first._row"))))
        reasons = F.when(~F.col("is_valid"), F.col("reasons")).when(F.col("_again"), F.array(F.lit("duplicate:patient_id"))).otherwise(F.col("reasons"))
        known = materialize(known.withColumn("reasons", reasons).withColumn("accepted", F.size("reasons") == 0), "checked-documents")
        rejected = known.where("NOT accepted").select(*own, "reasons")
        rejected.write.mode("overwrite").parquet(os.path.join(self._at("rejected"), f"batch={batch}"))
        accepted = PT.split(known.where("accepted").select(*own))
        for name, rows in (("notes", accepted.notes), ("history", accepted.history)):
            rows.drop("batch").write.mode("overwrite").parquet(os.path.join(self._at(name), f"batch={batch}"))
        new = PT.split(known.where("accepted AND _there IS NULL").select(*own)).documents
        (_clustered(new.withColumn("batch", F.lit(batch)).withColumn("bucket", self._bucket()))
         .write.mode("append").partitionBy("bucket").parquet(self._at("documents")))
        return known.select(KEY, "accepted", "reasons")

    def rejected(self) -> DataFrame:
        """Documents that were not inserted: their columns, reasons and batch."""
        schema = T.StructType([*S.PATIENT_SCHEMA.fields, T.StructField("reasons", T.ArrayType(T.StringType())), T.StructField("batch", T.IntegerType())])
        return self._read("rejected", schema)


def open_store(spark: SparkSession, path: str) -> DocumentStore | None:
    try:
        return DocumentStore(spark, path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _clustered(docs: DataFrame) -> DataFrame:
    """Rows by bucket, sorted by id: few files a bucket, and a lookup reads few row groups."""
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return docs.repartitionByRange(n, "bucket", KEY).sortWithinPartitions("bucket", KEY)
