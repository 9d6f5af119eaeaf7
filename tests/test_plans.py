"""The physical plans keep the properties the design relies on at scale."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_SMALL
from vitalspark import schemas as S
from vitalspark.operators import documents as D
from vitalspark.operators import recent, stats
from vitalspark.operators.upsert import upsert
from vitalspark.plans import stream_queries
from vitalspark.plans.registry import QUERIES
from vitalspark.session import work_path
from vitalspark.sinks.files import write_readings_table
from vitalspark.sources import fixtures as X
from vitalspark.sources.readers import read_readings_table


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_last_n_limits_before_the_shuffle(spark):
    p = plan(recent.last_n_all_patients(X.load_readings(spark, SF_SMALL), 20))
    head = p.split("\n\n")[0]
    # partial limit below the exchange, final limit above it
    assert head.index("WindowGroupLimit") < head.index("Exchange") < head.rindex("WindowGroupLimit")


def test_aggregates_are_partial_before_the_shuffle(spark):
    r = X.load_readings(spark, SF_SMALL)
    for df in (stats.metric_summary(r), stats.patient_summary(r), stats.device_activity(r),
               stats.overall_summary(r)):
        assert "partial_count" in plan(df)


def test_dimension_join_is_a_broadcast_of_a_local_table(spark):
    p = plan(X.load_readings(spark, SF_SMALL))
    assert "BroadcastHashJoin" in p and "LocalTableScan" in p and "Scan ExistingRDD" not in p


def test_small_upsert_does_not_shuffle_the_base(spark):
    base, incoming = X.reading_upserts(spark, SF_SMALL)
    p = plan(upsert(base, incoming))
    assert "BroadcastHashJoin LeftAnti" in p and "SortMergeJoin" not in p


def test_small_update_batch_is_broadcast(spark):
    docs = X.load_patients(spark, SF_SMALL)
    for df in (D.update_risk_scores(docs, X.risk_updates(spark, SF_SMALL)),
               D.add_medical_notes(docs, X.note_updates(spark, SF_SMALL)),
               D.update_profiles(docs, X.profile_updates(spark, SF_SMALL), "2024-02-01 00:00:00")):
        p = plan(df)
        assert "BroadcastHashJoin LeftOuter" in p and "SortMergeJoin" not in p


def test_reading_table_prunes_partitions_and_pushes_filters(spark):
    path = work_path(spark, "table")
    write_readings_table(X.load_readings(spark, SF_SMALL), path)
    df = read_readings_table(spark, path, ["patient_id", "value"],
                             (F.col("reading_date") == F.lit("2024-01-05").cast("date"))
                             & (F.col("patient_id") == "P000007"))
    p = plan(df)
    assert "PartitionFilters: [isnotnull(reading_date" in p
    assert "EqualTo(patient_id,P000007)" in p
    assert "ReadSchema: struct<patient_id:string,value:double>" in p


@pytest.mark.parametrize("key", sorted(k for k, fn in QUERIES.items()
                                       if fn.__module__ != stream_queries.__name__))
def test_no_python_evaluation(spark, key):
    p = plan(E.queries()[key](spark, SF_SMALL))
    assert not any(k in p for k in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                                    "MapInPandas", "PythonUDF"))


def test_document_schema_is_fixed(spark):
    # same names and types; derived documents only know more about non-null structs
    assert X.load_patients(spark, SF_SMALL).schema.simpleString() == S.PATIENT_SCHEMA.simpleString()


def test_time_filters_prune_the_reading_table(spark):
    from vitalspark.operators import transforms
    from vitalspark.operators.report import daily_report
    r = X.load_readings(spark, SF_SMALL)
    path = work_path(spark, "readings")
    write_readings_table(r, path)
    table = read_readings_table(spark, path)
    as_of = "2024-01-20 00:00:00"
    for op in (lambda df: transforms.recent_abnormal(df, as_of, 24),
               lambda df: transforms.readings_within_retention(df, as_of, 3)):
        pruned = op(table)
        p = plan(pruned)
        assert "PartitionFilters: [isnotnull(reading_date" in p and "reading_date#" in p.split("PartitionFilters")[1]
        cols = [c for c in pruned.columns if c != "reading_date"]
        got, want = pruned.select(*cols), op(r).select(*cols)
        assert got.count() == want.count() > 0 and got.exceptAll(want).count() == 0
    day = "2024-01-07"
    a = daily_report(table, "2024-01-07", "2024-01-08 00:00:00", day=day).first()
    b = daily_report(r, "2024-01-07", "2024-01-08 00:00:00", day=day).first()
    assert a == b and 0 < a.summary.total_readings < r.count()


def test_update_batch_over_the_byte_bound_is_not_broadcast(spark, monkeypatch):
    import vitalspark.session as sess
    monkeypatch.setattr(D, "fits_broadcast", lambda rows, nbytes, max_rows: sess.fits_broadcast(rows, nbytes, max_rows, 1))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(D.add_medical_notes(X.load_patients(spark, SF_SMALL), X.note_updates(spark, SF_SMALL)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin LeftOuter" in p and "BroadcastHashJoin" not in p
    assert not sess.fits_broadcast(10, sess.BROADCAST_BYTES + 1, 1000) and sess.fits_broadcast(10, 100, 1000)


def test_upsert_reads_untouched_dates_by_partition_filter(spark):
    from vitalspark.operators.upsert import reading_date, upsert
    from vitalspark.session import work_path
    from vitalspark.sinks.files import write_readings_table
    path = work_path(spark, "t")
    base, incoming = X.reading_upserts(spark, SF_SMALL)
    write_readings_table(base, path)
    one_day = incoming.withColumn("reading_date", reading_date()).where("reading_date = '2024-01-10'")
    p = plan(upsert(spark.read.parquet(path), one_day))
    assert len([x for x in p.splitlines() if x.startswith("PartitionFilters") and "2024-01-10" in x]) == 2


def test_lookups_push_the_key_to_the_scan(spark):
    from vitalspark.plans import document_queries, reading_queries
    for q, text in ((reading_queries.q_last_n_readings, "EqualTo(patient_key,"), (document_queries.q_patient_by_id, "EqualTo(patient_id,P000007)")):
        assert text in plan(q(spark, SF_SMALL))
