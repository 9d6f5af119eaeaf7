"""Stream sinks (K1, K2, K6), continuous ingest (T8) and the lifecycle helper.

Replays are harmless: every micro-batch writer overwrites its own
``batch_id=<n>`` folder, so a batch re-run after a failure replaces what it
wrote before instead of adding to it.  Batch numbers belong to one checkpoint:
a folder that holds batches of another one is refused (``claim``), since a new
checkpoint counts from 0 again and would replace earlier data.

The reading table (T8) is micro-batch folders plus compacted versions.  Only
what its log names counts: a batch or version is logged after it is written
whole, so half-written folders are never read.
"""

from __future__ import annotations

import os
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import schemas as S
from ..functions.columns import patient_key
from ..operators.upsert import latest_per_key
from ..session import sub_folders
from .sources import MESSAGE_ORDER, dead_letters, readings_from_messages

BATCH_COL = "batch_id"


def _trigger(writer, trigger: dict | None):
    return writer.trigger(**(trigger or {"availableNow": True}))


def start_append(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                 fmt: str = "parquet", name: str | None = None) -> StreamingQuery:
    """K1: each row once (append); a file sink is exactly-once through its log.
    ``trigger`` e.g. {"processingTime": "10 seconds"}; default availableNow."""
    w = df.writeStream.outputMode("append").format(fmt).option("checkpointLocation", checkpoint)
    if name:
        w = w.queryName(name)
    if fmt == "console":
        w = w.option("truncate", False)
    else:
        w = w.option("path", path)
    return _trigger(w, trigger).start()


def open_log(spark: SparkSession, path: str, schema: str) -> DataFrame | None:
    """A small log table; None where nothing has been logged."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_log(spark: SparkSession, path: str, schema: str) -> list:
    log = open_log(spark, path, schema)
    return [] if log is None else log.collect()


def claim(batch: DataFrame, path: str) -> None:
    """Let only one streaming checkpoint write batches below ``path``: its query's id is noted at the first batch."""
    spark = batch.sparkSession
    query = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
    if query is None:  # a batch handed in by hand
        return
    owner = os.path.join(path, "_owner")
    held = read_log(spark, owner, "query string")
    if not held:
        spark.createDataFrame([(query,)], "query string").coalesce(1).write.parquet(owner)
    elif held[0].query != query:
        raise ValueError(f"{path} holds batches of another checkpoint; start from that checkpoint or name another folder")


def batch_folder_writer(path: str, fmt: str = "parquet"):
    """foreachBatch function: write the micro-batch to ``path/batch_id=<n>``."""
    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0 or not getattr(write, "claimed", False):
            claim(batch, path)
            write.claimed = True
        batch.write.mode("overwrite").format(fmt).save(os.path.join(path, f"{BATCH_COL}={batch_id}"))
    return write


def start_update(df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None,
                 output_mode: str = "update", name: str | None = None) -> StreamingQuery:
    """K2: changed aggregates per trigger (update mode), kept per batch; read
    the current result with ``read_keyed_latest``.  Complete mode works too."""
    w = (df.writeStream.outputMode(output_mode).option("checkpointLocation", checkpoint)
         .foreachBatch(batch_folder_writer(path)))
    if name:
        w = w.queryName(name)
    return _trigger(w, trigger).start()


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_keyed_latest(spark: SparkSession, path: str, keys, order=(BATCH_COL,)) -> DataFrame:
    """The newest row per key over all micro-batch folders."""
    return latest_per_key(read_batches(spark, path), keys, order).drop(BATCH_COL)


def read_last_batch(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the newest micro-batch (complete-mode results)."""
    df = read_batches(spark, path)
    newest = df.agg(F.max(BATCH_COL)).scalar()  # of a partition column: Spark reads the folder names alone
    return df.filter(F.col(BATCH_COL) == newest).drop(BATCH_COL)


def parse_once(spark: SparkSession, parsed: DataFrame, path: str, checkpoint: str,
               trigger: dict | None = None) -> tuple[StreamingQuery, DataFrame]:
    """Fan-out for several consumers of one source: a single query writes the
    parsed readings to ``path`` (file sink: exactly-once through its log), and
    the returned stream reads them back (a file source on a sink folder reads
    only committed files).  The source is read and its JSON parsed once instead
    of once per consumer, at the cost of one more trigger of latency.  The
    sink folder exists once the query has started and processed what is
    available; then the consumer stream can be defined."""
    q = start_append(parsed, path, checkpoint, trigger)
    if (trigger or {}).get("availableNow"):
        q.awaitTermination()
    else:
        q.processAllAvailable()
    return q, spark.readStream.schema(parsed.schema).parquet(path)


def route_writer(all_path: str, abnormal_path: str, predicate=None):
    """K6: every reading to sink 1, abnormal ones also to sink 2, from one
    persisted micro-batch (the source is read once for both sinks)."""
    pred = predicate if predicate is not None else (F.col("is_abnormal") == F.lit(True))

    def write(batch: DataFrame, batch_id: int) -> None:
        if batch_id == 0 or not getattr(write, "claimed", False):
            for path in (all_path, abnormal_path):
                claim(batch, path)
            write.claimed = True
        batch.persist()
        try:
            batch.write.mode("overwrite").parquet(os.path.join(all_path, f"{BATCH_COL}={batch_id}"))
            batch.filter(pred).write.mode("overwrite").parquet(os.path.join(abnormal_path, f"{BATCH_COL}={batch_id}"))
        finally:
            batch.unpersist()
    return write


def start_route(readings: DataFrame, all_path: str, abnormal_path: str, checkpoint: str,
                trigger: dict | None = None) -> StreamingQuery:
    w = (readings.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(route_writer(all_path, abnormal_path)))
    return _trigger(w, trigger).start()


# --- T8: the reading table ------------------------------------------------------------------

BATCH_LOG = "batch_id long, folder string"
VERSION_LOG = "upto long, reading_date date, folder string"
TABLE_COLUMNS = [*S.READING_COLUMNS, "patient_key", *MESSAGE_ORDER]


def ingest_writer(table_path: str):
    """T8 micro-batch: parse, split off dead letters, normalise time, add the
    store's patient key (P7), keep the newest message per reading key, write a
    fresh folder, then log it under the batch's number (a batch that is run
    again replaces its entry)."""
    def write(messages: DataFrame, batch_id: int) -> None:
        claim(messages, table_path)
        spark = messages.sparkSession
        messages.persist()
        try:
            good = readings_from_messages(messages).withColumn("patient_key", patient_key())
            folder = os.path.join(table_path, "readings", uuid.uuid4().hex)
            (latest_per_key(good, S.READING_KEY, MESSAGE_ORDER).select(*TABLE_COLUMNS)
             .withColumn("reading_date", F.to_date("reading_timestamp")).write.parquet(folder))
            dead_letters(messages).write.mode("overwrite").parquet(
                os.path.join(table_path, "dead_letters", f"{BATCH_COL}={batch_id}"))
            (spark.createDataFrame([(batch_id, folder)], BATCH_LOG).coalesce(1).write.mode("overwrite")
             .parquet(os.path.join(table_path, "log", f"entry={batch_id}")))
        finally:
            messages.unpersist()
    return write


def first_deliveries(messages: DataFrame, within: str, keys=("partition", "offset")) -> DataFrame:
    """Messages that have not come before, as told by partition and offset; each is remembered for ``within`` after its
    arrival (state, one entry a message).  The watermark runs on the time of arrival, so no message is ever late and
    none is lost; one that comes again later than that is written again, and last write wins makes it harmless."""
    return (messages.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", within)
            .dropDuplicatesWithinWatermark(list(keys)).drop("_arrived"))


def stream_to_table(messages: DataFrame, table_path: str, checkpoint: str,
                    trigger: dict | None = None, once_within: str | None = None) -> StreamingQuery:
    """Continuous ingest of reading messages into the reading table; with ``once_within`` messages that are delivered
    again within that time are not written again (``first_deliveries``)."""
    messages = first_deliveries(messages, once_within) if once_within else messages
    w = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(ingest_writer(table_path))
    return _trigger(w, trigger).start()


def _upto(spark: SparkSession, table_path: str) -> int:
    """The last batch folded into the newest compacted version, -1 without one: one number from the log."""
    versions = open_log(spark, os.path.join(table_path, "versions"), VERSION_LOG)
    last = None if versions is None else versions.agg(F.max("upto")).first()[0]
    return -1 if last is None else last


def _state(spark: SparkSession, table_path: str):
    """What the table consists of just now: the last batch folded, {date: folder} of the newest compacted version, and
    {batch: folder} of the batches after it.  Older entries of the log are left out before anything is collected."""
    upto = _upto(spark, table_path)
    base = {}
    if upto >= 0:
        versions = open_log(spark, os.path.join(table_path, "versions"), VERSION_LOG)
        base = {v.reading_date: v.folder for v in versions.where((F.col("upto") == upto) & F.col("folder").isNotNull()).collect()}
    log = open_log(spark, os.path.join(table_path, "log"), BATCH_LOG)
    pending = [] if log is None else log.where((F.col("entry") > upto) & (F.col("batch_id") > upto)).collect()
    return upto, base, {b.batch_id: b.folder for b in pending}


def _base(spark: SparkSession, dates: dict) -> DataFrame | None:
    """The compacted rows of the given {date: folder}; the dates are partition filters of their folders."""
    by_folder: dict[str, list] = {}
    for day, folder in dates.items():
        by_folder.setdefault(folder, []).append(day)
    out = None
    for folder, days in sorted(by_folder.items()):
        part = spark.read.parquet(folder).where(F.col("reading_date").isin(days)).select(*TABLE_COLUMNS, "reading_date")
        out = part if out is None else out.unionByName(part)
    return out


def _merged(spark: SparkSession, base: dict, batches: dict) -> tuple[DataFrame, set]:
    """The rows of the dates that the batches touch, last write wins, and those dates."""
    pending = spark.read.parquet(*[f for _, f in sorted(batches.items())])
    touched = {r[0] for r in pending.select("reading_date").distinct().collect()}  # a row a day
    old = _base(spark, {d: f for d, f in base.items() if d in touched})
    rows = pending if old is None else pending.unionByName(old)
    return latest_per_key(rows, S.READING_KEY, MESSAGE_ORDER), touched


def read_ingested(spark: SparkSession, table_path: str) -> DataFrame:
    """The reading table written by T8: last write wins per reading key, by
    message time, partition and offset.

    Dates without batches after the newest compaction are a plain scan of the
    compacted files; only the compacted rows of touched dates are shuffled
    with the batches that touch them."""
    _, base, batches = _state(spark, table_path)
    if not batches:
        out = _base(spark, base)
        if out is None:
            raise ValueError(f"{table_path} holds no reading yet")
    else:
        out, touched = _merged(spark, base, batches)
        rest = _base(spark, {d: f for d, f in base.items() if d not in touched})
        out = out if rest is None else out.unionByName(rest.select(*out.columns))
    return out.select(*S.READING_COLUMNS, "patient_key")


def read_written(spark: SparkSession, table_path: str) -> DataFrame:
    """Every row that the micro-batches have written, whatever has become of it since."""
    return spark.read.parquet(os.path.join(table_path, "readings", "*"))


def read_dead_letters(spark: SparkSession, table_path: str) -> DataFrame:
    """Messages that could not be stored, with the reason."""
    return spark.read.parquet(os.path.join(table_path, "dead_letters"))


def compact_ingested(spark: SparkSession, table_path: str) -> int:
    """Periodic batch job: fold the batches logged so far into the table.  Only
    the dates they touch are written anew, to a fresh folder, range-partitioned
    on (date, patient, time) so that a hot date or patient is split over many
    files; other dates keep their files.  The new version is logged last, as
    one small table of dates and folders.  Batches that land meanwhile stay
    pending.  Returns the last batch folded; without new batches nothing is
    written.  Old folders are left to the owner of the table."""
    upto, base, batches = _state(spark, table_path)
    if not batches:
        return upto
    current, touched = _merged(spark, base, batches)
    folder, last = os.path.join(table_path, "compacted", uuid.uuid4().hex), max(batches)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = ("reading_date", "patient_id", "reading_timestamp")
    (current.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
     .write.partitionBy("reading_date").parquet(folder))
    days = {**base, **dict.fromkeys(touched, folder)}
    rows = [(last, day, f) for day, f in sorted(days.items())] or [(last, None, None)]
    (spark.createDataFrame(rows, VERSION_LOG).coalesce(1).write
     .parquet(os.path.join(table_path, "versions", f"entry={last}-{uuid.uuid4().hex}")))
    _fold_log(spark, table_path, upto)
    return last


def _fold_log(spark: SparkSession, table_path: str, upto: int) -> None:
    """Leave out of the log what no reader needs any more: batches folded, and versions that were replaced, before the
    compaction that has just ended began.  A reader that began before it still finds all of its own."""
    for name in ("log", "versions"):
        for folder in sub_folders(spark, os.path.join(table_path, name)):
            number = int(folder.name.removeprefix("entry=").split("-")[0]) if folder.name.startswith("entry=") else None
            if number is not None and number <= upto - (name == "versions"):
                folder.delete()


def run_all(spark: SparkSession, queries: dict[str, StreamingQuery], wait: str = "any",
            timeout_s: float | None = None) -> dict[str, StreamingQuery]:
    """Several queries started from one source, each with its own
    checkpoint and trigger.  ``wait="any"`` returns when the first one ends
    (or fails) and stops the rest — the long-running service; ``wait="all"``
    waits for each (availableNow runs that end on their own).  Re-raises the
    first query failure."""
    try:
        if wait == "all":
            for q in queries.values():
                q.awaitTermination(timeout_s)
        else:
            spark.streams.awaitAnyTermination(timeout_s)
    finally:
        # a query that is stopped in the middle of a batch may report that as a failure of its own; it isn't one
        ended = [q for q in queries.values() if not q.isActive]
        for q in queries.values():
            if q.isActive:
                q.stop()
    for q in ended:
        if q.exception() is not None:
            raise q.exception()
    return queries
