"""Stored documents: batches rewrite the buckets they touch, run again without harm, and inserts are checked."""

import os

import pytest
from pyspark.sql import functions as F

from vitalspark.operators import document_store as DS
from vitalspark.operators import documents as D
from vitalspark.operators import patient_tables as PT
from vitalspark.operators.document_store import DocumentStore
from vitalspark.session import work_path
from vitalspark.sources import fixtures as X

SF = "/root/testdata/sf0.01"
AT = "2024-02-01 09:00:00"


@pytest.fixture
def store(spark):
    return DocumentStore.create(X.load_patients(spark, SF), work_path(spark, "store-test"), 16)


def files(store):
    out = {}
    for folder, _, names in os.walk(os.path.join(store.path, "documents").removeprefix("file:")):
        if "bucket=" in folder:
            out[os.path.basename(folder)] = sorted(n for n in names if n.endswith(".parquet"))
    return out


def flat(df):
    return sorted(map(tuple, df.collect()), key=str)


def one_update(spark, patient="P000007", phone="+1"):
    return spark.createDataFrame([(patient, 1, phone)], "patient_id string, seq long, phone string")


def test_create_reads_back(spark, store):
    assert flat(PT.flatten(store.tables())) == flat(D.flatten_patients(X.load_patients(spark, SF)))
    assert flat(D.flatten_patients(PT.assemble(store.tables()))) == flat(D.flatten_patients(X.load_patients(spark, SF)))
    with pytest.raises(Exception, match="ALREADY_EXISTS|already exists"):
        DocumentStore.create(X.load_patients(spark, SF), store.path, 16)


def test_untouched_files_keep_their_names(spark, store):
    before = files(store)
    store.update_profiles(one_update(spark), AT, 1)
    after = files(store)
    changed = [b for b in before if before[b] != after[b]]
    assert len(before) == 16 and len(changed) == 1
    doc = store.document("P000007").first()
    assert doc.personal_info.contact.phone == "+1" and str(doc.last_updated) == AT
    assert store.tables().documents.count() == X.load_patients(spark, SF).count()


def test_a_batch_reads_only_its_buckets(spark, store):
    docs, touched = store.documents_of(one_update(spark))
    assert len(touched) == 1 and "PartitionFilters: [isnotnull(bucket" in docs._jdf.queryExecution().toString()


def test_unmatched_ids_change_nothing(spark, store):
    before = flat(PT.flatten(store.tables()))
    store.update_profiles(one_update(spark, "P999999999"), AT, 1)
    notes = spark.createDataFrame([("P999999999", 1, "d", "n")], "patient_id string, seq long, doctor string, note string").withColumn("at", F.lit(AT).cast("timestamp_ntz"))
    store.add_notes(notes, 2)
    store.add_notes(notes.where("false"), 3)
    assert flat(PT.flatten(store.tables())) == before


def test_reruns_and_late_batches(spark, store):
    notes = X.note_updates(spark, SF)
    store.add_notes(notes, 1)
    once = flat(PT.flatten(store.tables()))
    store.add_notes(notes, 1)
    assert flat(PT.flatten(store.tables())) == once
    store.update_profiles(one_update(spark, phone="new"), AT, 3)
    store.update_profiles(one_update(spark, phone="old"), AT, 2)
    assert store.document("P000007").first().personal_info.contact.phone == "new"
    with pytest.raises(ValueError):
        store.add_notes(notes, 0)


def test_a_batch_that_stopped_between_is_completed(spark, store, monkeypatch):
    notes = X.note_updates(spark, SF)
    want = flat(PT.flatten(PT.add_notes(PT.split(X.load_patients(spark, SF)), notes)))

    def stop(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        m.setattr(DS, "materialize", stop)
        with pytest.raises(RuntimeError):
            store.add_notes(notes, 1)
    store.add_notes(notes, 1)
    assert flat(PT.flatten(store.tables())) == want


def test_summary_of_scores(spark, store):
    want = D.bulk_risk_update(X.load_patients(spark, SF), X.risk_updates(spark, SF).drop("seq"))
    assert flat(store.update_scores(X.risk_updates(spark, SF).drop("seq"), 1)) == flat(want[1])
    assert flat(PT.flatten(store.tables())) == flat(D.flatten_patients(want[0]))


def test_a_third_of_the_updates_on_one_patient(spark, store):
    hot = spark.range(3000).select(F.lit("P000001").alias("patient_id"), F.col("id").alias("seq"), F.lit("d").alias("doctor"),
                                   F.concat(F.lit("n"), F.col("id")).alias("note"), F.lit(AT).cast("timestamp_ntz").alias("at"))
    store.add_notes(hot, 1)
    r = PT.flatten(store.tables()).where("patient_id = 'P000001'").first()
    assert (r.notes, r.last_note) == (3000, "n2999")


def test_inserts(spark, store):
    docs = X.load_patients(spark, SF).limit(1)
    new = docs.withColumn("patient_id", F.lit("N1"))
    many = new.withColumn("seq", F.lit(2)).unionByName(new.withColumn("risk_score", F.lit(3)).withColumn("seq", F.lit(1)))
    many = many.unionByName(docs.withColumn("seq", F.lit(1))).unionByName(new.withColumn("patient_id", F.lit(None).cast("string")).withColumn("seq", F.lit(1)))
    many = many.unionByName(new.withColumn("patient_id", F.lit("N2")).withColumn("risk_score", F.lit(101)).withColumn("seq", F.lit(1)))
    for _ in range(2):
        told = sorted((str(r.patient_id), r.accepted, r.reasons) for r in store.insert(many, 5, "seq").collect())
        existing = docs.first().patient_id
        assert told == sorted([("N1", True, []), ("N1", False, ["duplicate:patient_id"]), (existing, False, ["duplicate:patient_id"]),
                               ("None", False, ["missing:patient_id"]), ("N2", False, ["range:risk_score"])])
        assert store.document("N1").first().risk_score == 3
        assert store.rejected().count() == 4 and store.tables().documents.count() == X.load_patients(spark, SF).count() + 1
    assert [r.accepted for r in store.insert(new, 6).collect()] == [False]
    assert store.insert(new.where("false"), 7).count() == 0


def test_large_inserts_meet_a_bloom_filter(spark, store):
    """Past the broadcast bound the ids' filter stands in front of the scan of stored ids."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
            "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "0"}
    ids = X.load_patients(spark, SF).select("patient_id").where("patient_id LIKE '%7'")
    before = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        docs, _ = store.documents_of(ids)
        assert "might_contain" in docs.select("patient_id", "batch").join(ids, "patient_id", "left_semi")._jdf.queryExecution().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
