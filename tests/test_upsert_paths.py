"""K5 beyond the broadcast bound: the touched-partition and whole-base anti
joins give the rows of the broadcast path (and of the oracle), and the
touched-partition plan shuffles only the base rows of touched dates."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from harness import compare
from vitalspark.operators.upsert import reading_date, upsert
from vitalspark.plans import catalog
from vitalspark.sources import fixtures as X


@contextlib.contextmanager
def no_static_broadcast(spark):
    """Keep the planner from broadcasting small written tables on its own, so
    the shuffle paths are the ones planned."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("kw", [
    {"broadcast_keys": 0, "part": "date"},                         # shuffle of touched dates only
    {"broadcast_keys": 0, "part": "date", "broadcast_parts": 0},   # too many dates: whole-base shuffle
    {"broadcast_keys": 0},                                         # no partition known: whole-base shuffle
])
def test_large_batch_paths_equal_the_oracle(spark, duck_small, kw):
    kw = {**kw, **({"part": reading_date()} if "part" in kw else {})}
    base, incoming = X.reading_upserts(spark, SF_SMALL)
    with no_static_broadcast(spark):
        problems, _, _ = compare(upsert(base, incoming, **kw), duck_small, catalog.oracle_sql()["upsert_readings"])
    assert not problems


def test_large_batch_shuffles_only_touched_dates(spark):
    r = X.load_readings(spark, SF_SMALL)
    base = r.withColumn("seq", F.lit(0).cast("long"))
    day = F.to_date("reading_timestamp") == F.lit("2024-01-05").cast("date")
    incoming = r.filter(day).withColumn("value", F.col("value") + 1).withColumn("seq", F.lit(1).cast("long"))
    with no_static_broadcast(spark):
        out = upsert(base, incoming, broadcast_keys=0, part=reading_date())
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            out.explain("formatted")
        p = buf.getvalue()
        # untouched dates: broadcast filter only; touched dates: semi join, then the shuffled anti join
        assert "BroadcastHashJoin LeftAnti" in p and "BroadcastHashJoin LeftSemi" in p
        assert "SortMergeJoin LeftAnti" in p
        got = out.groupBy((F.to_date("reading_timestamp") == F.lit("2024-01-05").cast("date")).alias("d")) \
                 .agg(F.sum("value").alias("v")).collect()
    want = base.groupBy((F.to_date("reading_timestamp") == F.lit("2024-01-05").cast("date")).alias("d")) \
               .agg(F.sum("value").alias("v"), F.count(F.lit(1)).alias("n")).collect()
    got, want = {x.d: x.v for x in got}, {x.d: (x.v, x.n) for x in want}
    assert got[False] == pytest.approx(want[False][0])
    assert got[True] == pytest.approx(want[True][0] + want[True][1])  # every reading of that day replaced, +1
