"""Streams equal their batch form; late rows are dropped; replays are harmless."""

import contextlib
import io
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from vitalspark.plans import stream_queries as Q
from vitalspark.session import work_path
from vitalspark.sources.fixtures import BROKEN_OFFSET, load_readings
from vitalspark.streaming import operators as T
from vitalspark.streaming import sinks as K
from vitalspark.streaming.progress import read_progress, start_counted
from vitalspark.streaming.sources import message_stream, readings_from_messages, with_watermark


def _batch(spark):
    r = load_readings(spark, SF_SMALL)
    return with_watermark(r, Q.WATERMARK)


def _same(a, b):
    ra, rb = sorted(map(tuple, a.collect())), sorted(map(tuple, b.select(*a.columns).collect()))
    assert ra == rb


def test_window_statistics_stream_equals_batch(spark):
    _same(Q.q_window_statistics(spark, SF_SMALL), T.window_statistics(_batch(spark), Q.WINDOW))


def test_patient_alerts_stream_equals_batch(spark):
    stream = Q.q_patient_alerts_by_window(spark, SF_SMALL)
    batch = T.patient_alerts_by_window(_batch(spark), Q.WINDOW).select(
        "window_start", "window_end", "patient_id", "total_abnormal",
        F.explode("metric_counts").alias("metric_type", "metric_count"))
    _same(stream, batch)


def test_alerts_update_mode_equals_append_mode(spark):
    _same(Q.q_sink_stream_update(spark, SF_SMALL), Q.q_tumbling_metric_alerts(spark, SF_SMALL))


def test_late_rows_are_dropped(spark):
    late_run = Q.q_event_time_watermark(spark, SF_SMALL)
    _same(late_run, T.window_totals(_batch(spark), Q.WINDOW))


def test_window_totals_sum_to_total(spark):
    totals = Q.q_window_totals(spark, SF_SMALL).agg(F.sum("readings")).first()[0]
    running = Q.q_stream_running_totals(spark, SF_SMALL).first().total_readings
    assert totals == running == _batch(spark).count()


def test_ingest_replay_is_harmless(spark):
    src = Q.write_messages(spark, SF_SMALL)
    table = work_path(spark, "table")
    write = K.ingest_writer(table)
    batch = spark.read.parquet(src)
    write(batch, 0)
    n = K.read_ingested(spark, table).count()
    write(batch, 0)  # the same micro-batch again after a failure
    assert K.read_ingested(spark, table).count() == n == load_readings(spark, SF_SMALL).count()
    assert K.read_dead_letters(spark, table).count() == batch.filter(F.col("offset") >= BROKEN_OFFSET).count() > 0


def test_run_all_stops_every_query(spark):
    src = Q.write_messages(spark, SF_SMALL)
    stream = with_watermark(readings_from_messages(message_stream(spark, src)), Q.WATERMARK)
    qs = {"feed": K.start_append(T.abnormal_feed(stream), work_path(spark, "o"), work_path(spark, "c"),
                                 trigger={"processingTime": "1 second"}),
          "totals": K.start_update(T.stream_running_totals(stream), work_path(spark, "o"), work_path(spark, "c"),
                                   output_mode="complete", trigger={"processingTime": "1 second"})}
    qs["feed"].processAllAvailable()
    qs["feed"].stop()
    K.run_all(spark, qs, wait="any", timeout_s=30)
    assert not any(q.isActive for q in qs.values())


def _rows(spark, table):
    return sorted(map(tuple, K.read_ingested(spark, table).collect()))


def _later(msgs, seq):
    return (msgs.withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(hours=F.lit(seq)))
            .withColumn("value", F.encode(F.regexp_replace(F.decode("value", "UTF-8"), '"unit":"[^"]*"', f'"unit":"u{seq}"'), "UTF-8")))


def test_compaction_keeps_the_table(spark):
    src = Q.write_messages(spark, SF_SMALL)
    table = work_path(spark, "table")
    write = K.ingest_writer(table)
    msgs = spark.read.parquet(src)
    write(msgs, 0)
    fix = msgs.filter(F.col("offset") % 10 == 0)
    write(_later(fix, 1), 1)
    before = _rows(spark, table)
    assert K.compact_ingested(spark, table) == 1
    assert _rows(spark, table) == before
    assert K.compact_ingested(spark, table) == 1  # again, without a new batch
    assert _rows(spark, table) == before
    write(fix, 2)  # older messages that arrive late don't win
    assert _rows(spark, table) == before
    assert K.compact_ingested(spark, table) == 2
    assert _rows(spark, table) == before


def test_untouched_dates_are_not_shuffled(spark):
    table = work_path(spark, "table")
    write = K.ingest_writer(table)
    msgs = spark.read.parquet(Q.write_messages(spark, SF_SMALL))
    write(msgs, 0)
    K.compact_ingested(spark, table)
    day = F.to_date("timestamp") == F.lit("2024-01-10").cast("date")
    write(_later(msgs.filter(day), 1), 1)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        K.read_ingested(spark, table).explain("formatted")
    scans = [x for x in buf.getvalue().splitlines() if x.startswith("PartitionFilters")]
    assert len([x for x in scans if "reading_date" in x]) == 2
    K.compact_ingested(spark, table)
    folders = {f.split("/")[-1] for f in K._state(spark, table)[1].values()}
    assert len(folders) == 2  # only the touched day was written anew


def test_a_batch_that_lands_during_a_compaction_stays(spark, monkeypatch):
    table = work_path(spark, "table")
    write = K.ingest_writer(table)
    msgs = spark.read.parquet(Q.write_messages(spark, SF_SMALL, None))
    half = F.col("offset") % 2 == 0
    write(msgs.filter(half), 0)
    merged = K._merged

    def landing(*args):
        out = merged(*args)
        monkeypatch.setattr(K, "_merged", merged)
        write(msgs.filter(~half), 1)
        return out

    monkeypatch.setattr(K, "_merged", landing)
    assert K.compact_ingested(spark, table) == 0
    assert K.read_ingested(spark, table).count() == msgs.count()
    assert K.compact_ingested(spark, table) == 1
    assert K.read_ingested(spark, table).count() == msgs.count()


def test_half_written_batches_and_versions_are_not_read(spark):
    table = work_path(spark, "table")
    write = K.ingest_writer(table)
    msgs = spark.read.parquet(Q.write_messages(spark, SF_SMALL, None))
    write(msgs.filter("offset % 2 = 0"), 0)
    n = K.read_ingested(spark, table).count()
    # data of a batch and of a version whose log entry was never written
    r = K.read_ingested(spark, table).withColumn("reading_date", F.to_date("reading_timestamp"))
    r.write.parquet(os.path.join(table, "readings", "left-behind"))
    r.write.partitionBy("reading_date").parquet(os.path.join(table, "compacted", "left-behind"))
    assert K.read_ingested(spark, table).count() == n


def test_another_checkpoint_is_refused(spark):
    src, table, out = Q.write_messages(spark, SF_SMALL), work_path(spark, "table"), work_path(spark, "out")
    ckpt = work_path(spark, "c")
    K.stream_to_table(message_stream(spark, src), table, ckpt).awaitTermination()
    n = K.read_ingested(spark, table).count()
    K.stream_to_table(message_stream(spark, src), table, ckpt).awaitTermination()  # its own goes on
    with pytest.raises(Exception, match="another checkpoint"):
        K.stream_to_table(message_stream(spark, src), table, work_path(spark, "c")).awaitTermination()
    assert K.read_ingested(spark, table).count() == n
    totals = T.stream_running_totals(readings_from_messages(message_stream(spark, src)))
    K.start_update(totals, out, work_path(spark, "c"), output_mode="complete").awaitTermination()
    with pytest.raises(Exception, match="another checkpoint"):
        K.start_update(totals, out, work_path(spark, "c"), output_mode="complete").awaitTermination()


def test_last_write_is_by_message_time_not_offset(spark):
    table = work_path(spark, "table")
    body = '{"patient_id": "P1", "reading_timestamp": "2024-01-01T00:00:00", "metric_type": "m", "value": %s}'
    rows = [(body % 1, "2024-01-01 10:00:00", 0, 900), (body % 2, "2024-01-01 11:00:00", 1, 5), (body % 3, "2024-01-01 10:30:00", 2, 7),
            ("{}", "2024-01-01 10:30:00", 2, 8), (None, "2024-01-01 10:30:00", 2, 9)]
    df = spark.createDataFrame(rows, "value string, timestamp string, partition int, offset long").selectExpr(
        "cast(value AS binary) AS value", "cast(timestamp AS timestamp) AS timestamp", "partition", "offset")
    K.ingest_writer(table)(df, 0)
    got = K.read_ingested(spark, table).collect()
    assert [r.value for r in got] == [2.0] and got[0].patient_key != "P1"
    assert sorted(r.reason for r in K.read_dead_letters(spark, table).collect()) == ["missing:patient_id", "not_json"]


def test_progress_counts_every_batch(spark):
    src, out = Q.write_messages(spark, SF_SMALL), work_path(spark, "o")
    spark.read.parquet(src).repartition(7).write.parquet(src + "-7")
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        start_counted(message_stream(spark, src + "-7", max_files_per_trigger=1), out, work_path(spark, "c")).awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    p = read_progress(spark, out).collect()
    assert len(p) == 7 and sum(r.messages for r in p) == spark.read.parquet(src).count()


def test_parse_once_fan_out_equals_direct_consumers(spark):
    src = Q.write_messages(spark, SF_SMALL)
    Q.add_sentinel(spark, src)
    parsed = readings_from_messages(message_stream(spark, src))
    _, shared = K.parse_once(spark, parsed, work_path(spark, "readings"), work_path(spark, "c"),
                             trigger={"availableNow": True})
    for op in (lambda s: T.abnormal_feed(s), lambda s: T.window_statistics(s, Q.WINDOW),
               lambda s: T.tumbling_metric_alerts(s, Q.WINDOW)):
        outs = []
        for stream in (shared, readings_from_messages(message_stream(spark, src))):
            out = work_path(spark, "o")
            K.start_append(op(with_watermark(stream, Q.WATERMARK)), out, work_path(spark, "c")).awaitTermination()
            outs.append(spark.read.parquet(out))
        assert outs[0].count() > 0
        _same(outs[0], outs[1])


def test_parse_once_with_a_processing_time_trigger(spark):
    src = Q.write_messages(spark, SF_SMALL)
    q, shared = K.parse_once(spark, readings_from_messages(message_stream(spark, src)), work_path(spark, "readings"),
                             work_path(spark, "c"), trigger={"processingTime": "1 second"})
    out = work_path(spark, "o")
    try:
        K.start_append(T.abnormal_feed(shared), out, work_path(spark, "c")).awaitTermination()
    finally:
        q.stop()
    direct = T.abnormal_feed(readings_from_messages(spark.read.parquet(src)))
    _same(spark.read.parquet(out), direct)
