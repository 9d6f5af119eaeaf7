"""Redelivery, windows that messages and timers close, the ingest log, and sinks with one owner."""

import datetime as dt
import json
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vitalspark.session import sub_folders, work_path
from vitalspark.streaming import live_windows as W
from vitalspark.streaming import sinks as K
from vitalspark.streaming.sources import MESSAGE_FILE_SCHEMA, message_stream, readings_from_messages

T0 = dt.datetime(2024, 1, 1)


def message(seconds, partition, offset, patient="p", metric="m", flag=True):
    at = T0 + dt.timedelta(seconds=seconds)
    body = {"patient_id": patient, "reading_timestamp": at.isoformat(), "metric_type": metric, "value": 1.0, "is_abnormal": flag}
    return bytearray(json.dumps(body).encode()), at, partition, offset


def put(spark, src, messages):
    spark.createDataFrame(messages, MESSAGE_FILE_SCHEMA).coalesce(1).write.mode("append").parquet(src)


# --- redelivery ---------------------------------------------------------------------------


def test_redelivered_messages_are_written_once_and_none_is_late(spark):
    src, table, ckpt = (work_path(spark, n) for n in ("messages", "table", "ckpt"))

    def run():
        K.stream_to_table(message_stream(spark, src), table, ckpt, once_within="1 day").awaitTermination()
        return K.read_written(spark, table).count(), sorted((r.patient_id, r.value) for r in K.read_ingested(spark, table).collect())

    first = [message(i, i % 2, i, f"p{i}") for i in range(20)]
    put(spark, src, first)
    assert run()[0] == 20
    put(spark, src, first[5:] + first[:3])              # delivered again
    assert run()[0] == 20
    old = message(-10 ** 7, 0, 1000, "late")            # of long ago, but new
    put(spark, src, [old, old, *first[:2]])
    written, rows = run()
    assert written == 21 and len(rows) == 21 and ("late", 1.0) in rows


# --- windows ------------------------------------------------------------------------------


def brute(messages, seconds):
    """(partition, opened, closed, n, abnormal by patient and metric) of windows closed by messages."""
    out = []
    for partition in sorted({m[2] for m in messages}):
        opened, held = None, []
        for body, at, _, _ in sorted((m for m in messages if m[2] == partition), key=lambda m: (m[1], m[3])):
            opened = opened or at
            held.append(json.loads(body))
            if at >= opened + dt.timedelta(seconds=seconds):
                abnormal = Counter((h["patient_id"], h["metric_type"]) for h in held if h["is_abnormal"])
                out.append((partition, opened, at, len(held), tuple(sorted(abnormal.items()))))
                opened, held = at, []
    return out


def closed(spark, out):
    rows = spark.read.parquet(out).collect()
    return sorted((r.partition, r.opened, r.closed, r.readings, tuple(sorted(((a.patient_id, a.metric_type), a.n) for a in r.alerts)), r.closed_by)
                  for r in rows)


@pytest.mark.parametrize("batches", [1, 4])
def test_windows_closed_by_messages(spark, batches):
    rng = random.Random(batches)
    messages, t = [], 0
    for i in range(400):
        t += rng.choice([0, 0, 1, 5, 30, 60, 200])
        messages.append(message(t, rng.randrange(3), i, f"p{rng.randrange(4)}", rng.choice("ab"), rng.choice([True, False, None])))
    src, out, ckpt = (work_path(spark, n) for n in ("messages", "out", "ckpt"))
    for k in range(batches):
        put(spark, src, messages[k * 400 // batches:(k + 1) * 400 // batches])
        K.start_append(W.live_windows(readings_from_messages(message_stream(spark, src)), 60, "3650 days"), out, ckpt).awaitTermination()
    got = closed(spark, out)
    assert [g[:5] for g in got] == brute(messages, 60) and {g[5] for g in got} == {"message"}
    alerts = W.live_alerts(spark.read.parquet(out)).collect()
    assert {(r.partition, r.opened, r.patient_id, r.total_abnormal) for r in alerts} == {
        (p, o, patient, n) for p, o, _, _, found in brute(messages, 60)
        for patient, n in Counter({x: sum(k for (y, _), k in found if y == x) for (x, _), _ in found}).items() if n >= 2}


def test_timers_close_silent_partitions_and_far_times_are_harmless(spark):
    src, out, ckpt = (work_path(spark, n) for n in ("messages", "out", "ckpt"))

    def run():
        K.start_append(W.live_windows(readings_from_messages(message_stream(spark, src)), 60, "10 seconds"), out, ckpt).awaitTermination()

    put(spark, src, [message(0, 0, 0), message(1, 0, 1, flag=None), message(5, 1, 2)])
    run()
    put(spark, src, [message(3600, 1, 3)])              # closes its own window, and the watermark that of the silent partition
    run()
    at = lambda s: T0 + dt.timedelta(seconds=s)         # noqa: E731
    got = closed(spark, out)
    assert (0, at(0), at(60), 2, ((("p", "m"), 1),), "timer") in got
    assert (1, at(5), at(3600), 2, ((("p", "m"), 2),), "message") in got
    far = bytearray(json.dumps({"patient_id": "p", "reading_timestamp": "9000-01-01T00:00:00", "metric_type": "m"}).encode())
    put(spark, src, [(far, at(4000), 0, 4)])
    run()
    assert len(closed(spark, out)) >= 2


# --- the ingest log ---------------------------------------------------------------------------


def test_a_thousand_logged_batches(spark, monkeypatch):
    """Entries that were folded are neither collected nor kept."""
    src, table, ckpt = (work_path(spark, n) for n in ("messages", "table", "ckpt"))
    put(spark, src, [message(i, 0, i, f"p{i}") for i in range(5)])
    K.stream_to_table(message_stream(spark, src), table, ckpt).awaitTermination()
    folder = K.read_log(spark, f"{table}/log", K.BATCH_LOG)[0].folder
    # 1,000 earlier batches, folded long ago
    (spark.range(1000).select(F.col("id").alias("batch_id"), F.lit(folder).alias("folder"), F.col("id").alias("entry"))
     .coalesce(1).write.mode("overwrite").partitionBy("entry").parquet(f"{table}/log"))
    spark.createDataFrame([(998, None, None)], K.VERSION_LOG).coalesce(1).write.parquet(f"{table}/versions/entry=998-x")
    upto, base, pending = K._state(spark, table)
    assert (upto, base, pending) == (998, {}, {999: folder})
    assert K.read_ingested(spark, table).count() == 5
    assert K.compact_ingested(spark, table) == 999
    assert [f.name for f in sub_folders(spark, f"{table}/log")] == ["entry=999"]
    assert len(sub_folders(spark, f"{table}/versions")) == 2        # the newest, and the one that a reader may still hold
    assert K.read_ingested(spark, table).count() == 5 and K.compact_ingested(spark, table) == 999


# --- sinks ------------------------------------------------------------------------------------


@pytest.mark.parametrize("shared", ["all", "abnormal"])
def test_a_second_writer_is_refused_on_either_route_sink(spark, shared):
    src = work_path(spark, "messages")
    put(spark, src, [message(i, 0, i, f"p{i}") for i in range(4)])
    paths = {n: work_path(spark, n) for n in ("all", "abnormal", "other")}

    def route(all_path, abnormal_path):
        K.start_route(readings_from_messages(message_stream(spark, src)), all_path, abnormal_path, work_path(spark, "ckpt")).awaitTermination()

    route(paths["all"], paths["abnormal"])
    with pytest.raises(Exception, match="another checkpoint"):
        route(*((paths["all"], paths["other"]) if shared == "all" else (paths["other"], paths["abnormal"])))
    assert spark.read.parquet(paths["abnormal"]).count() == 4
