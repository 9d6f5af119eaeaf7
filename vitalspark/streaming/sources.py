"""Stream sources (S1) and the parse front end shared by all stream jobs.

A message has the columns of a Kafka record that the jobs use — ``value``
(JSON bytes), ``timestamp``, ``partition`` and ``offset``.  On a cluster the source is the
Kafka topic; without a broker (tests, replays) it is a folder of message files
with the same columns, read as a file stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions.columns import event_time, parse_reading_time
from ..operators.transforms import malformed_split, parse_json_readings

MESSAGE_FILE_SCHEMA = T.StructType([
    T.StructField("value", T.BinaryType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
])

DEFAULT_WATERMARK = "2 minutes"


def kafka_options(bootstrap: str, topic: str, starting: str = "latest", max_offsets: int | None = None) -> dict[str, str]:
    """Options of the reading topic (``starting`` = latest or earliest; ``max_offsets`` bounds a micro-batch)."""
    options = {"kafka.bootstrap.servers": bootstrap, "subscribe": topic,
               "startingOffsets": starting, "failOnDataLoss": "false"}
    return options | ({"maxOffsetsPerTrigger": str(max_offsets)} if max_offsets else {})


def read_stream(spark: SparkSession, fmt: str, options: dict | None = None, schema=None,
                path: str | None = None) -> DataFrame:
    """A streaming DataFrame from any source format (``kafka`` needs the
    Kafka connector on the classpath; file formats need ``schema``)."""
    r = spark.readStream.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if options:
        r = r.options(**options)
    return r.load(path) if path else r.load()


def message_stream(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Message files as a stream (broker-less stand-in for the Kafka source)."""
    opts = {"maxFilesPerTrigger": str(max_files_per_trigger)} if max_files_per_trigger else None
    return read_stream(spark, "parquet", opts, MESSAGE_FILE_SCHEMA, path)


# What orders the messages of one key: offsets of different partitions don't compare.
MESSAGE_ORDER = ("message_timestamp", "partition", "offset")


def readings_from_messages(messages: DataFrame, keep=("partition", "offset")) -> DataFrame:
    """P1 + P5: JSON body → reading columns, ISO text time → TIMESTAMP_NTZ.
    Malformed messages are left out here (see ``dead_letters``)."""
    good, _ = malformed_split(messages.select("value", "timestamp", *keep))
    return good.withColumn("reading_timestamp", parse_reading_time("reading_timestamp"))


def dead_letters(messages: DataFrame, keep=("partition", "offset")) -> DataFrame:
    _, bad = malformed_split(messages.select("value", "timestamp", *keep))
    return bad


def raw_readings(messages: DataFrame) -> DataFrame:
    """P1 only: every message parsed, reading time left as text (the live feed's view)."""
    return parse_json_readings(messages, S.READING_MESSAGE_SCHEMA, "timestamp")


def with_watermark(readings: DataFrame, delay: str = DEFAULT_WATERMARK, col: str = "reading_timestamp",
                   out: str = "event_time") -> DataFrame:
    """Event time as TIMESTAMP (a watermark refuses text and TIMESTAMP_NTZ)
    and a watermark ``delay`` behind the newest event seen.  Set it before any
    filter so that every row advances event time."""
    src = parse_reading_time(col) if dict(readings.dtypes).get(col) == "string" else F.col(col)
    return readings.withColumn(out, event_time(src)).withWatermark(out, delay)
