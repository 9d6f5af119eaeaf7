"""Spark session defaults and the shared work folder.

Everything that must survive an executor loss (stream checkpoints, written
intermediate tables, lineage cuts) lives below the folder the cluster names in
``spark.checkpoint.dir``.  We read that setting from the session; only when it
is unset (a laptop, a unit test) do we pick a folder of our own.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

# Defaults for a batch job.  Shuffle partitions are sized for the target scale
# by AQE: it starts from ``spark.sql.shuffle.partitions`` and coalesces small
# partitions at runtime, and splits skewed join partitions.
BATCH_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


# Settings for the target cluster (~100 TB of readings, ~1000 executors); set
# through spark-submit --conf or ``build_session(extra=CLUSTER_CONF)``.
CLUSTER_CONF = {
    **BATCH_CONF,
    # ~128 MB input splits; AQE starts wide and coalesces toward ~256 MB shuffle partitions
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 * 1024),
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 * 1024 * 1024),
    # Static broadcast only for sides the planner knows to be small.  Its
    # estimate of a file scan is the (compressed) Parquet size, so that size is
    # scaled by 4 before the 16 MB threshold: at most ~4 MB of Parquet.  The
    # sides we broadcast on purpose are measured in code (BROADCAST_BYTES).
    "spark.sql.autoBroadcastJoinThreshold": str(16 * 1024 * 1024),
    "spark.sql.sources.fileCompressionFactor": "4.0",
    # a selective join side keeps rows of the other one out of the shuffle (document inserts)
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    # large stream state (windows x patients) lives in RocksDB, committed by changelog
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def use_stream_partitions(spark: SparkSession, n: int | None = None) -> int:
    """Set the shuffle partitions a stateful stream starts with.

    A stream query fixes this number in its checkpoint at its first start: it
    is the number of state-store partitions, each one task in every
    micro-batch, and AQE does not coalesce stateful stream shuffles.  The
    batch setting (20,000 in ``CLUSTER_CONF``, coalesced by AQE) would mean
    20,000 state-store tasks per trigger, so a stream job uses the cluster's
    task slots instead (one wave per micro-batch), or ``n``."""
    n = n or spark.sparkContext.defaultParallelism
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "vitalspark", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(BATCH_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder, setting one only if unset."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    current = spark.sparkContext.getCheckpointDir()
    if configured:
        if not current:
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not _is_local(spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir is not set: on a cluster, intermediate tables and stream checkpoints "
                           "need a folder that all machines share")
    # Unset: only happens outside a cluster (tests, a laptop).  The setting is fixed once a session runs; its context
    # remembers the folder.
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="vitalspark-ckpt-"))
    return spark.sparkContext.getCheckpointDir()


def _is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh path below the shared checkpoint folder (never reused)."""
    root = ensure_checkpoint_dir(spark)
    return os.path.join(root, "vitalspark", *parts, uuid.uuid4().hex)


@dataclass(frozen=True)
class Folder:
    """A folder of a store that Hadoop's file systems reach."""
    name: str
    path: str
    _fs: object
    _place: object

    def delete(self) -> None:
        self._fs.delete(self._place, True)


def sub_folders(spark: SparkSession, path: str) -> list[Folder]:
    """The folders directly below ``path``, from one listing; none where it doesn't exist."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(place):
        return []
    found = [s.getPath() for s in fs.listStatus(place) if s.isDirectory()]
    return sorted((Folder(p.getName(), p.toString(), fs, p) for p in found), key=lambda f: f.name)


def materialize(df, label: str):
    """Write ``df`` as a Parquet table below the shared checkpoint folder and
    return a scan of it.  Cuts the lineage: later jobs (and a re-run after an
    executor loss) read the table instead of recomputing its inputs."""
    path = work_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


# A join side is broadcast only when both its row count and its measured size
# are within bounds (the size is the sum of the rows' JSON lengths, close to the
# uncompressed data, and not the Parquet bytes on disk; the bound leaves room for
# the overhead of rows in memory).
BROADCAST_BYTES = 64 * 1024 * 1024


def written_and_counted(df, label: str, measure=None, also=()):
    """``materialize(df)`` with its row count and the measured size in bytes of
    the ``measure`` columns (default: all), both from one job over the written
    table; and the values of the aggregates ``also``.

    For a join side whose size decides the strategy: the side is computed once
    (not once for the sizing and again for the join)."""
    t = materialize(df, label)
    cols = list(measure or t.columns)
    size = F.coalesce(F.sum(F.octet_length(F.to_json(F.struct(*cols)))), F.lit(0))
    rows, nbytes, *more = t.agg(F.count(F.lit(1)), size, *also).first()
    return t, rows, nbytes, *more


def fits_broadcast(rows: int, nbytes: int, max_rows: int, max_bytes: int = BROADCAST_BYTES) -> bool:
    """The proven bound before a broadcast: rows and measured bytes."""
    return rows <= max_rows and nbytes <= max_bytes
