"""Registered stream queries.

Each query writes reading messages derived from ``events`` to a message
folder, runs the stream over it with an ``availableNow`` trigger (checkpointed
below the shared checkpoint folder), and returns what the sink holds.
Append-mode window queries also receive one message far in the future, which
moves the watermark past the last real window — the way a live stream closes
its windows.  T2 and T8 restart from their checkpoint between phases.
"""

from __future__ import annotations

import datetime as dt
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.transforms import add_processed_at, classify_readings
from ..session import work_path
from ..sources.fixtures import BROKEN_EVERY, load_readings, metric_dim, reading_messages
from ..streaming import operators as T
from ..streaming import sinks as K
from ..streaming import live_windows as W
from ..streaming.progress import read_progress, start_counted
from ..streaming.sources import (MESSAGE_FILE_SCHEMA, message_stream, raw_readings, readings_from_messages,
                                 with_watermark)
from .registry import register
from .sql_fixtures import with_readings

WINDOW = "1 day"        # one-minute windows hold no alert in the test data
WATERMARK = "2 minutes"
# fixed value: the far-future event time that closes every real window
SENTINEL_TIME = "2999-01-01T00:00:00.000000"


def write_messages(spark: SparkSession, sf_dir: str, broken_every: int | None = BROKEN_EVERY) -> str:
    """Reading messages (value, timestamp, partition, offset) of every event, and broken ones among them, as files."""
    path = work_path(spark, "messages")
    reading_messages(load_readings(spark, sf_dir, keep_event_id=True), broken_every).write.parquet(path)
    return path


def add_sentinel(spark: SparkSession, path: str, partition: int = 0) -> None:
    """One abnormal reading far in the future.  It must be abnormal: Catalyst
    pushes an ``is_abnormal`` filter below the watermark node, so only rows
    that pass the filter advance event time for the alert queries."""
    body = {"patient_id": "P_SENTINEL", "reading_timestamp": SENTINEL_TIME, "metric_type": "click",
            "value": 50.0, "unit": "bpm", "device_id": "DEV_SENTINEL", "is_abnormal": True,
            "threshold_min": 3.0, "threshold_max": 120.0}
    row = (bytearray(json.dumps(body).encode()), dt.datetime(2999, 1, 1), partition, -1)
    spark.createDataFrame([row], MESSAGE_FILE_SCHEMA).write.mode("append").parquet(path)


def _readings_stream(spark, src):
    return with_watermark(readings_from_messages(message_stream(spark, src)), WATERMARK)


def _run_closed(spark, src, start):
    """Run ``start(stream, checkpoint)`` over the input plus the sentinel.  All
    files arrive in one micro-batch, so no real row is late (the watermark moves
    only at the end of a batch); the sentinel then moves it past every real
    window, and the following no-data batch emits them in append mode."""
    add_sentinel(spark, src)
    start(_readings_stream(spark, src), work_path(spark, "ckpt")).awaitTermination()


_GOOD = "readings_id WHERE true"
_ALL = ", ".join(S.READING_COLUMNS)
_DAY = ("date_trunc('day', reading_timestamp) AS window_start, "
        "date_trunc('day', reading_timestamp) + INTERVAL 1 DAY AS window_end")


@register("src_kafka_readings", with_readings(f"SELECT {_ALL} FROM {_GOOD}"))
def q_src_kafka_readings(spark, sf_dir):
    src, out = write_messages(spark, sf_dir), work_path(spark, "out")
    q = K.start_append(readings_from_messages(message_stream(spark, src)).drop("message_timestamp", "partition", "offset"),
                       out, work_path(spark, "ckpt"))
    q.awaitTermination()
    return spark.read.parquet(out)


@register("sink_stream_append", with_readings(f"""
SELECT patient_id, strftime(reading_timestamp, '%Y-%m-%dT%H:%M:%S.%f') AS reading_timestamp, metric_type, value, unit,
       device_id, is_abnormal, threshold_min, threshold_max, reading_timestamp AS message_timestamp FROM readings_id
UNION ALL
SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, reading_timestamp FROM readings_id
WHERE event_id % {BROKEN_EVERY} = 0"""))
def q_sink_stream_append(spark, sf_dir):
    """K1: the raw parsed feed (malformed bodies as NULL rows) appended once each."""
    src, out = write_messages(spark, sf_dir), work_path(spark, "out")
    K.start_append(raw_readings(message_stream(spark, src)), out, work_path(spark, "ckpt")).awaitTermination()
    return spark.read.parquet(out)


@register("stream_abnormal_feed", with_readings(f"""
SELECT patient_id, reading_timestamp, metric_type, value, unit, threshold_min, threshold_max
FROM {_GOOD} AND is_abnormal"""))
def q_stream_abnormal_feed(spark, sf_dir):
    src, out = write_messages(spark, sf_dir), work_path(spark, "out")
    q = K.start_append(T.abnormal_feed(readings_from_messages(message_stream(spark, src))), out,
                       work_path(spark, "ckpt"), trigger={"availableNow": True})
    q.awaitTermination()
    return spark.read.parquet(out)


_ALERTS = f"""SELECT {_DAY}, patient_id, metric_type, count(*) AS abnormal_count,
       round(avg(value), 2) AS avg_value, round(max(value), 2) AS max_value, round(min(value), 2) AS min_value
FROM {_GOOD} AND is_abnormal GROUP BY 1, 2, patient_id, metric_type HAVING count(*) >= 2"""


@register("tumbling_metric_alerts", with_readings(_ALERTS))
def q_tumbling_metric_alerts(spark, sf_dir):
    src, out = write_messages(spark, sf_dir), work_path(spark, "out")
    _run_closed(spark, src, lambda s, ck: K.start_append(T.tumbling_metric_alerts(s, WINDOW), out, ck))
    return spark.read.parquet(out)


@register("sink_stream_update", with_readings(_ALERTS))
def q_sink_stream_update(spark, sf_dir):
    """K2: the alerts in update mode; the sink keeps the newest row per key."""
    src, out = write_messages(spark, sf_dir), work_path(spark, "out")
    K.start_update(T.tumbling_metric_alerts(_readings_stream(spark, src), WINDOW), out,
                   work_path(spark, "ckpt")).awaitTermination()
    return K.read_keyed_latest(spark, out, ["window_start", "patient_id", "metric_type"])


@register("window_statistics", with_readings(f"""
SELECT date_trunc('day', reading_timestamp) AS period_start,
       date_trunc('day', reading_timestamp) + INTERVAL 1 DAY AS period_end,
       count(*) AS total_readings, CAST(count_if(is_abnormal) AS BIGINT) AS abnormal_readings,
       count(DISTINCT patient_id) AS unique_patients,
       round(count_if(is_abnormal) / count(*) * 100, 2) AS abnormal_rate_pct
FROM {_GOOD} GROUP BY 1, 2"""))
def q_window_statistics(spark, sf_dir):
    src, out = write_messages(spark, sf_dir), work_path(spark, "out")
    _run_closed(spark, src, lambda s, ck: K.start_append(T.window_statistics(s, WINDOW), out, ck))
    return spark.read.parquet(out)


@register("stream_running_totals", with_readings(f"""
SELECT count(*) AS total_readings, CAST(count_if(is_abnormal) AS BIGINT) AS abnormal_readings,
       round(count_if(is_abnormal) / count(*) * 100, 2) AS abnormal_rate_pct FROM {_GOOD}"""))
def q_stream_running_totals(spark, sf_dir):
    src, out = write_messages(spark, sf_dir), work_path(spark, "out")
    K.start_update(T.stream_running_totals(readings_from_messages(message_stream(spark, src))), out,
                   work_path(spark, "ckpt"), output_mode="complete").awaitTermination()
    return K.read_last_batch(spark, out)


_PM = f"""pm AS (SELECT {_DAY}, patient_id, metric_type, count(*) AS n
            FROM {_GOOD} AND is_abnormal GROUP BY 1, 2, patient_id, metric_type)"""
_PP = """pp AS (SELECT window_start, window_end, patient_id, sum(n) AS total FROM pm GROUP BY 1, 2, 3
            HAVING sum(n) >= 2)"""


@register("patient_alerts_by_window", with_readings("""
SELECT pp.window_start, pp.window_end, pp.patient_id, CAST(pp.total AS BIGINT) AS total_abnormal,
       pm.metric_type, pm.n AS metric_count
FROM pp JOIN pm USING (window_start, window_end, patient_id)""", _PM, _PP))
def q_patient_alerts_by_window(spark, sf_dir):
    src, out = write_messages(spark, sf_dir), work_path(spark, "out")
    _run_closed(spark, src, lambda s, ck: K.start_append(T.patient_alerts_by_window(s, WINDOW), out, ck))
    res = spark.read.parquet(out)
    return res.select("window_start", "window_end", "patient_id", "total_abnormal",
                      F.explode("metric_counts").alias("metric_type", "metric_count"))


_TOTALS = f"""SELECT date_trunc('day', reading_timestamp) + INTERVAL 1 DAY AS window_end, count(*) AS readings,
       CAST(count_if(is_abnormal) AS BIGINT) AS abnormal,
       round(count_if(is_abnormal) / count(*) * 100, 2) AS abnormal_rate_pct
FROM {_GOOD} GROUP BY 1"""


@register("window_totals", with_readings(_TOTALS))
def q_window_totals(spark, sf_dir):
    src, out = write_messages(spark, sf_dir), work_path(spark, "out")
    _run_closed(spark, src, lambda s, ck: K.start_append(T.window_totals(s, WINDOW), out, ck))
    return spark.read.parquet(out)


@register("event_time_watermark", with_readings(_TOTALS))
def q_event_time_watermark(spark, sf_dir):
    """After all readings, copies of the first day's readings arrive again
    (abnormal values): they are behind the watermark and must not count."""
    src, out = write_messages(spark, sf_dir), work_path(spark, "out")
    ckpt = work_path(spark, "ckpt")

    def start():
        return K.start_append(T.window_totals(_readings_stream(spark, src), WINDOW), out, ckpt)
    start().awaitTermination()
    late = (load_readings(spark, sf_dir, keep_event_id=True)
            .filter(F.col("reading_timestamp") < F.lit("2024-01-02").cast("timestamp_ntz"))
            .withColumn("value", F.col("value") + 1000).withColumn("is_abnormal", F.lit(True))
            .withColumn("event_id", F.col("event_id") + 10 ** 12))
    reading_messages(late, None).write.mode("append").parquet(src)
    start().awaitTermination()
    add_sentinel(spark, src)
    start().awaitTermination()
    return spark.read.parquet(out)


@register("route_abnormal", with_readings(f"""
SELECT 'all' AS sink, patient_id, reading_timestamp, metric_type, value FROM {_GOOD}
UNION ALL
SELECT 'abnormal', patient_id, reading_timestamp, metric_type, value FROM {_GOOD} AND is_abnormal"""))
def q_route_abnormal(spark, sf_dir):
    src = write_messages(spark, sf_dir)
    all_p, abn_p = work_path(spark, "all"), work_path(spark, "abnormal")
    K.start_route(readings_from_messages(message_stream(spark, src)), all_p, abn_p,
                  work_path(spark, "ckpt")).awaitTermination()
    cols = ["patient_id", "reading_timestamp", "metric_type", "value"]
    return (spark.read.parquet(all_p).select(F.lit("all").alias("sink"), *cols)
            .unionByName(spark.read.parquet(abn_p).select(F.lit("abnormal").alias("sink"), *cols)))


_CORRECTED = f"""SELECT patient_id, reading_timestamp, metric_type,
       value + CASE WHEN event_id % 20 = 0 THEN 2 WHEN event_id % 10 = 0 THEN 1 ELSE 0 END AS value,
       unit, device_id, is_abnormal, threshold_min, threshold_max FROM {_GOOD}"""


def _corrected_table(spark, sf_dir, compact_again: bool):
    """Base messages first (then compacted), then two rounds of corrections
    (event_id % 10, value + 1; event_id % 20, value + 2) as later messages of
    another partition with smaller offsets; last write wins."""
    src, table, ckpt = write_messages(spark, sf_dir), work_path(spark, "table"), work_path(spark, "ckpt")
    K.stream_to_table(message_stream(spark, src), table, ckpt).awaitTermination()
    K.compact_ingested(spark, table)  # the periodic compaction, after the initial load
    r = load_readings(spark, sf_dir, keep_event_id=True)
    for seq, every in ((1, 10), (2, 20)):
        fix = r.filter(F.col("event_id") % every == 0).withColumn("value", F.col("value") + seq)
        later = (reading_messages(fix, None).withColumn("timestamp", F.col("timestamp") + F.make_dt_interval(hours=F.lit(seq)))
                 .withColumn("partition", F.lit(10 + seq)).withColumn("offset", F.col("offset") - seq * 10 ** 12))
        later.write.mode("append").parquet(src)
        K.stream_to_table(message_stream(spark, src), table, ckpt).awaitTermination()
    if compact_again:
        K.compact_ingested(spark, table)
        K.compact_ingested(spark, table)
    return K.read_ingested(spark, table)


@register("stream_to_table", with_readings(_CORRECTED))
def q_stream_to_table(spark, sf_dir):
    return _corrected_table(spark, sf_dir, compact_again=False).drop("patient_key")


@register("compacted_table", with_readings(_CORRECTED))
def q_compacted_table(spark, sf_dir):
    """Load, compact, correct, compact twice, read."""
    return _corrected_table(spark, sf_dir, compact_again=True).drop("patient_key")


# bodies that parse but can't be stored, one of each beside every 97th reading: (body, reason)
_UNUSABLE = [("{bad", "not_json"), ("{}", "missing:patient_id"),
             ('{"patient_id": "P1", "reading_timestamp": "2024-01-01T00:00:00"}', "missing:metric_type"),
             ('{"patient_id": "P1", "metric_type": "click"}', "missing:reading_timestamp"),
             ('{"patient_id": "P1", "metric_type": "click", "reading_timestamp": "soon"}', "unreadable:reading_timestamp")]


@register("dead_letter_reasons", with_readings(f"""
SELECT reason, count(*) AS letters FROM readings_id CROSS JOIN (VALUES {", ".join(f"('{r}')" for _, r in _UNUSABLE)}) v(reason)
WHERE event_id % {BROKEN_EVERY} = 0 GROUP BY reason
UNION ALL SELECT 'stored', count(*) FROM readings_id"""))
def q_dead_letter_reasons(spark, sf_dir):
    """What the ingest counts as unusable and why, beside all readings that it stores."""
    src, table = work_path(spark, "messages"), work_path(spark, "table")
    messages = reading_messages(load_readings(spark, sf_dir, keep_event_id=True))
    broken = F.col("value") == F.lit("{bad").cast("binary")
    bodies = F.array(*[F.lit(b).cast("binary") for b, _ in _UNUSABLE])
    messages.withColumn("value", F.explode(F.when(broken, bodies).otherwise(F.array("value")))).write.parquet(src)
    K.stream_to_table(message_stream(spark, src), table, work_path(spark, "ckpt")).awaitTermination()
    stored = K.read_ingested(spark, table).agg(F.lit("stored").alias("reason"), F.count(F.lit(1)).alias("letters"))
    return K.read_dead_letters(spark, table).groupBy("reason").agg(F.count(F.lit(1)).alias("letters")).unionByName(stored)


@register("multi_query_lifecycle", with_readings(f"""
SELECT 'abnormal_feed' AS query, patient_id, metric_type, reading_timestamp AS at, CAST(NULL AS BIGINT) AS n, value
FROM {_GOOD} AND is_abnormal
UNION ALL
SELECT 'metric_alerts', patient_id, metric_type, window_start, abnormal_count, max_value FROM ({_ALERTS})
UNION ALL
SELECT 'window_statistics', NULL, NULL, date_trunc('day', reading_timestamp), count(*),
       round(count_if(is_abnormal) / count(*) * 100, 2) FROM {_GOOD} GROUP BY 4"""))
def q_multi_query_lifecycle(spark, sf_dir):
    """Three queries on one source with their own checkpoints and triggers (all that is there, a steady beat, one
    batch), and the contents of their sinks."""
    src = write_messages(spark, sf_dir)
    outs = {k: work_path(spark, k) for k in ("abnormal_feed", "metric_alerts", "window_statistics")}
    stream = _readings_stream(spark, src)
    qs = {
        "abnormal_feed": K.start_append(T.abnormal_feed(stream), outs["abnormal_feed"], work_path(spark, "ckpt"),
                                        trigger={"availableNow": True}),
        "metric_alerts": K.start_update(T.tumbling_metric_alerts(stream, WINDOW), outs["metric_alerts"],
                                        work_path(spark, "ckpt"), trigger={"processingTime": "1 second"}),
        "window_statistics": K.start_update(T.window_statistics_approx(stream, WINDOW),
                                            outs["window_statistics"], work_path(spark, "ckpt"), trigger={"once": True}),
    }
    qs["metric_alerts"].processAllAvailable()
    qs["metric_alerts"].stop()
    K.run_all(spark, qs, wait="all")
    feed = spark.read.parquet(outs["abnormal_feed"])
    alerts = K.read_keyed_latest(spark, outs["metric_alerts"], ["window_start", "patient_id", "metric_type"])
    stats = K.read_keyed_latest(spark, outs["window_statistics"], ["period_start"])
    none = F.lit(None).cast("string")
    return (feed.select(F.lit("abnormal_feed").alias("query"), "patient_id", "metric_type", F.col("reading_timestamp").alias("at"),
                        F.lit(None).cast("long").alias("n"), "value")
            .unionByName(alerts.select(F.lit("metric_alerts").alias("query"), "patient_id", "metric_type",
                                       F.col("window_start").alias("at"), F.col("abnormal_count").alias("n"), F.col("max_value").alias("value")))
            .unionByName(stats.select(F.lit("window_statistics").alias("query"), none.alias("patient_id"), none.alias("metric_type"),
                                      F.col("period_start").alias("at"), F.col("total_readings").alias("n"),
                                      F.col("abnormal_rate_pct").alias("value"))))


def _run_in_order(spark, sf_dir, start, slices: int = 3, stream=_readings_stream, sentinel: int = 0) -> None:
    """Feed the messages in event-time order over several runs of one checkpoint, each a micro-batch of its own, then
    the sentinel."""
    src, ckpt = work_path(spark, "messages"), work_path(spark, "ckpt")
    messages = reading_messages(load_readings(spark, sf_dir, keep_event_id=True))
    first, last = messages.agg(F.min(F.unix_micros("timestamp")), F.max(F.unix_micros("timestamp"))).first()
    cut = F.least(F.floor((F.unix_micros("timestamp") - F.lit(first)) * slices / F.lit(max(1, last - first))), F.lit(slices - 1))
    for i in range(slices):
        messages.where(cut == i).write.mode("append").parquet(src)
        start(stream(spark, src), ckpt).awaitTermination()
    add_sentinel(spark, src, sentinel)
    start(stream(spark, src), ckpt).awaitTermination()


_MINUTE = """date_trunc('minute', reading_timestamp)"""


@register("window_totals_minute", with_readings(f"""
SELECT {_MINUTE} + INTERVAL 1 MINUTE AS window_end, count(*) AS readings, CAST(count_if(is_abnormal) AS BIGINT) AS abnormal,
       round(count_if(is_abnormal) / count(*) * 100, 2) AS abnormal_rate_pct FROM {_GOOD} GROUP BY 1"""))
def q_window_totals_minute(spark, sf_dir):
    """T7 over one-minute windows, fed in event-time order over several micro-batches."""
    out = work_path(spark, "out")
    _run_in_order(spark, sf_dir, lambda s, ck: K.start_append(T.window_totals(s, "1 minute"), out, ck))
    return spark.read.parquet(out)


@register("window_statistics_minute", with_readings(f"""
SELECT {_MINUTE} AS period_start, {_MINUTE} + INTERVAL 1 MINUTE AS period_end, count(*) AS total_readings,
       CAST(count_if(is_abnormal) AS BIGINT) AS abnormal_readings, count(DISTINCT patient_id) AS unique_patients,
       round(count_if(is_abnormal) / count(*) * 100, 2) AS abnormal_rate_pct FROM {_GOOD} GROUP BY 1, 2"""))
def q_window_statistics_minute(spark, sf_dir):
    """T4 over one-minute windows, fed in event-time order over several micro-batches."""
    out = work_path(spark, "out")
    _run_in_order(spark, sf_dir, lambda s, ck: K.start_append(T.window_statistics(s, "1 minute"), out, ck))
    return spark.read.parquet(out)


@register("tumbling_metric_alerts_unrounded", with_readings(f"""
SELECT {_DAY}, patient_id, metric_type, count(*) AS abnormal_count, avg(value) AS avg_value, max(value) AS max_value,
       min(value) AS min_value FROM {_GOOD} AND is_abnormal GROUP BY 1, 2, patient_id, metric_type HAVING count(*) >= 2"""))
def q_tumbling_metric_alerts_unrounded(spark, sf_dir):
    """T3 with the values as they are, fed in event-time order over several micro-batches."""
    out = work_path(spark, "out")
    _run_in_order(spark, sf_dir, lambda s, ck: K.start_append(T.tumbling_metric_alerts(s, WINDOW, rounded=False), out, ck))
    return spark.read.parquet(out)


@register("statistics_by_processing_time", with_readings(f"""
SELECT count(*) AS total_readings, CAST(count_if(is_abnormal) AS BIGINT) AS abnormal_readings,
       round(count_if(is_abnormal) / count(*) * 100, 2) AS abnormal_rate_pct FROM {_GOOD}"""))
def q_statistics_by_processing_time(spark, sf_dir):
    """T4 on the time of processing (P3): one window long enough to hold the whole run; its bounds depend on the clock
    and are left out, as is the approximate number of patients."""
    src, out = write_messages(spark, sf_dir), work_path(spark, "out")
    stamped = add_processed_at(readings_from_messages(message_stream(spark, src)))
    K.start_update(T.window_statistics_approx(stamped, "36500 days", "processed_at"), out, work_path(spark, "ckpt"),
                   output_mode="complete").awaitTermination()
    return K.read_last_batch(spark, out).drop("period_start", "period_end", "unique_patients")


@register("stream_batch_progress", with_readings(f"""
SELECT count(*) + count_if(event_id % {BROKEN_EVERY} = 0) AS messages,
       CAST(count_if(event_id % {BROKEN_EVERY} = 0) AS BIGINT) AS malformed,
       CAST(count_if(is_abnormal) AS BIGINT) AS abnormal FROM readings_id"""))
def q_stream_batch_progress(spark, sf_dir):
    """T5 progress: the counts that each micro-batch (three message files) wrote, summed over the batches."""
    src, out = write_messages(spark, sf_dir), work_path(spark, "out")
    start_counted(message_stream(spark, src, max_files_per_trigger=3), out, work_path(spark, "ckpt")).awaitTermination()
    return read_progress(spark, out).agg(*[F.sum(c).alias(c) for c in ("messages", "malformed", "abnormal")])


@register("redelivered_messages", with_readings(f"""
SELECT {_ALL}, (SELECT count(*) FROM readings_id) AS written FROM {_GOOD}"""))
def q_redelivered_messages(spark, sf_dir):
    """T8 with redelivery: the topic comes, then a third of it again, some of it twice; the table holds every reading, and
    no more rows have been written than readings came first."""
    src, table, ckpt = work_path(spark, "messages"), work_path(spark, "table"), work_path(spark, "ckpt")
    messages = reading_messages(load_readings(spark, sf_dir, keep_event_id=True))
    again = messages.where(F.col("offset") % 3 == 0)
    for part in (messages, again, again.unionByName(again)):
        part.write.mode("append").parquet(src)
        K.stream_to_table(message_stream(spark, src), table, ckpt, once_within="1 day").awaitTermination()
    written = K.read_written(spark, table).agg(F.count(F.lit(1))).scalar()
    return K.read_ingested(spark, table).drop("patient_key").withColumn("written", written)


@register("stream_classify_readings", with_readings(f"""
SELECT patient_id, reading_timestamp, metric_type, value, unit, device_id,
       (value < threshold_min OR value > threshold_max) AS is_abnormal, threshold_min, threshold_max,
       CASE WHEN value < threshold_min THEN 'threshold_min' WHEN value > threshold_max THEN 'threshold_max' END AS threshold_violated
FROM {_GOOD}"""))
def q_stream_classify_readings(spark, sf_dir):
    """P14 on a stream: messages without flag and range, joined with the metric table as they come (stream-static)."""
    src, out = work_path(spark, "messages"), work_path(spark, "out")
    none = {c: F.lit(None).cast(S.READING_SCHEMA[c].dataType) for c in ("is_abnormal", "threshold_min", "threshold_max", "unit")}
    reading_messages(load_readings(spark, sf_dir, keep_event_id=True).withColumns(none)).write.parquet(src)
    flagged = classify_readings(readings_from_messages(message_stream(spark, src)), metric_dim(spark))
    K.start_append(flagged, out, work_path(spark, "ckpt")).awaitTermination()
    return spark.read.parquet(out)


# windows that open with a partition's first message and close with the first one a day later
_LIVE = """live AS (
  SELECT CAST(event_id % 10 AS INTEGER) AS "partition", reading_timestamp AS t, is_abnormal, patient_id, metric_type,
         row_number() OVER (PARTITION BY event_id % 10 ORDER BY reading_timestamp, event_id) AS rn FROM readings_id),
openings AS (
  SELECT "partition", t AS opened, CAST(0 AS BIGINT) AS after FROM live WHERE rn = 1
  UNION ALL
  SELECT o."partition", c.t, c.rn FROM openings o JOIN LATERAL (
    SELECT t, rn FROM live l WHERE l."partition" = o."partition" AND l.rn > o.after AND l.t >= o.opened + INTERVAL 1 DAY ORDER BY rn LIMIT 1) c ON true),
closings AS (
  SELECT "partition", opened, after, lead(after) OVER w AS upto, coalesce(lead(opened) OVER w, opened + INTERVAL 1 DAY) AS closed,
         CASE WHEN lead(after) OVER w IS NULL THEN 'timer' ELSE 'message' END AS closed_by
  FROM openings WINDOW w AS (PARTITION BY "partition" ORDER BY after)),
held AS (
  SELECT c."partition", c.opened, c.closed, c.closed_by, l.is_abnormal, l.patient_id, l.metric_type
  FROM closings c JOIN live l ON l."partition" = c."partition" AND l.rn > c.after AND (c.upto IS NULL OR l.rn <= c.upto))"""


def _with_live(body):
    return with_readings(body, _LIVE).replace("WITH ", "WITH RECURSIVE ", 1)


def _live(spark, sf_dir):
    out = work_path(spark, "out")
    _run_in_order(spark, sf_dir, lambda s, ck: K.start_append(W.live_windows(s, 86400, "36500 days"), out, ck),
                  stream=lambda *at: readings_from_messages(message_stream(*at)), sentinel=99)
    return spark.read.parquet(out)


@register("live_window_totals", _with_live("""
SELECT "partition", opened, closed, closed_by, count(*) AS readings, CAST(count_if(is_abnormal) AS BIGINT) AS abnormal,
       round(count_if(is_abnormal) / count(*) * 100, 2) AS abnormal_rate_pct
FROM held GROUP BY "partition", opened, closed, closed_by"""))
def q_live_window_totals(spark, sf_dir):
    """T7 as a consumer closes its windows, over several micro-batches; the sentinel's watermark closes the last ones."""
    return W.live_totals(_live(spark, sf_dir))


@register("live_window_alerts", _with_live("""
SELECT "partition", opened, closed, patient_id, CAST(sum(count(*)) OVER (PARTITION BY "partition", opened, patient_id) AS BIGINT) AS total_abnormal,
       metric_type, count(*) AS metric_count
FROM held WHERE is_abnormal GROUP BY "partition", opened, closed, patient_id, metric_type
QUALIFY sum(count(*)) OVER (PARTITION BY "partition", opened, patient_id) >= 2"""))
def q_live_window_alerts(spark, sf_dir):
    """T6 as a consumer closes its windows: patients with two abnormal readings or more."""
    return W.live_alerts(_live(spark, sf_dir))
