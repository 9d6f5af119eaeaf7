"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame expressions only.

A source's target T over its size S asks every document of it for f = T/S
copies: floor(f) whole ones and a fraction.  The fractions are rounded
dependently: two documents meet, and words are moved at random from one to the
other, keeping their sum and each expectation, until one of them is taken
wholly or not at all.  The other carries its fraction on to the next meeting.
Meetings run inside chunks of at most CHUNK documents of one source; every
chunk leaves at most one document undecided, those meet on the next level, and
so on up a tree.  So a source takes its target to within one document, however
its rows are spread, and no task ever holds more than a chunk.

Randomness is a hash of the seed, the level and the document, so reruns agree.

Defined cases: a null text has size 0 and takes 0; a null source is a source,
the last one; a source without words has target 0; null or repeated ids are
rows like others (ties go by size; with a row number, by the rest of the row);
rows that more than a chunk of others equal are dealt out by their places in the
table.  The number of sources is taken to be
small (a table of names), their targets are computed in one task.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalspark.session import fits_broadcast, materialize, written_and_counted

WEIGHTS = (5, 2, 1)
SHARE = 1.5     # of all words
MOST = 2.0      # copies of a source
CHUNK = 64      # documents that meet in one fold
MOST_SHARED = 500_000   # keys of repeated rows in a broadcast table, whose bytes are measured as well
SEED = 20240


def doc_sizes(docs: DataFrame, row: str | None = None) -> DataFrame:
    """doc_id, source, size; with ``row``, a column that numbers the rows, also row and a hash of the other columns."""
    own = [] if row is None else [F.col(row).alias("row"), F.xxhash64(*[c for c in docs.columns if c != row]).alias("same")]
    return docs.select("doc_id", "source",
                       F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"), *own)


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """source, n_docs, source_size, target.

    Resharing the excess by weight until no source is above its cap fills all
    open sources to one level: target = weight * level, or the cap where that
    is less.  Sources close in order of cap over weight."""
    s = sizes.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("size").alias("source_size"))
    one = Window.partitionBy(F.lit(0))
    rank = F.row_number().over(one.orderBy(F.col("source").isNull(), "source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.pmod(rank - 1, F.lit(len(weights))) + 1)
    s = s.select("*", weight.alias("weight"), (F.col("source_size") * F.lit(most)).alias("cap"),
                 (F.sum("source_size").over(one) * F.lit(share)).alias("total"))
    by_close = one.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), "source")
    before = by_close.rowsBetween(Window.unboundedPreceding, -1)
    after = by_close.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    level = (F.col("total") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("weight").over(after)
    s = s.withColumn("level", level)
    # the level rises while sources close and falls after: the first that stays open has the highest
    final = F.coalesce(F.max(F.when(F.col("cap") >= F.col("weight") * F.col("level"), F.col("level"))).over(one),
                       F.lit(float("inf")))
    s = s.withColumn("final", final)
    return s.select("source", "n_docs", F.coalesce("source_size", F.lit(0)).alias("source_size"),
                    F.least("cap", F.col("weight") * F.col("final")).alias("target"))


def _meet(units: DataFrame, level: int, chunk: int, seed: int) -> DataFrame:
    """One level of the tree: units (source, key, doc_id, size, mass, n, and row if there is one) meet in chunks; rows of
    all units with their mass after it.  n: units of the source on this level."""
    own = ["row"] if "row" in units.columns else []
    chunks = F.ceil(F.col("n") / F.lit(chunk * 0.75)).cast("long")
    units = units.withColumn("chunk", F.pmod(F.xxhash64(F.lit(seed + level), "key"), chunks))
    unit = F.struct("draw", "key", "doc_id", "size", "mass", *own)
    lists = (units.withColumn("draw", F.xxhash64(F.lit(seed), F.lit(level), "chunk", "key"))
             .groupBy("source", "chunk").agg(F.array_sort(F.collect_list(unit)).alias("units")))
    u = f"struct<draw:bigint,key:bigint,doc_id:bigint,size:bigint,mass:double{',row:bigint' if own else ''}>"
    row_a, row_b = (", 'row', s.open.row", ", 'row', x.row") if own else ("", "")
    # open: the unit still undecided, or null; done: the units decided so far
    fold = f"""aggregate(units,
      named_struct('open', cast(null as {u}), 'done', cast(array() as array<{u}>)),
      (s, x) -> if(s.open is null, named_struct('open', x, 'done', s.done),
        transform(array(named_struct(
            'up', least(s.open.size - s.open.mass, x.mass),
            'down', least(s.open.mass, x.size - x.mass),
            'p', pmod(xxhash64({seed}, s.open.draw, x.draw), 9007199254740992L) / 9007199254740992D)), m ->
          transform(array(if(m.p * (m.up + m.down) < m.down, m.up, -m.down)), d ->
            transform(array(named_struct(
                'a', named_struct('draw', s.open.draw, 'key', s.open.key, 'doc_id', s.open.doc_id, 'size', s.open.size,
                    'mass', if(d >= 0 and s.open.size - s.open.mass <= x.mass, double(s.open.size),
                            if(d < 0 and s.open.mass <= x.size - x.mass, 0D, s.open.mass + d)){row_a}),
                'b', named_struct('draw', x.draw, 'key', x.key, 'doc_id', x.doc_id, 'size', x.size,
                    'mass', if(d >= 0 and x.mass <= s.open.size - s.open.mass, 0D,
                            if(d < 0 and x.size - x.mass <= s.open.mass, double(x.size), x.mass - d)){row_b}))), r ->
              named_struct(
                'open', if(r.a.mass > 0 and r.a.mass < r.a.size, r.a, if(r.b.mass > 0 and r.b.mass < r.b.size, r.b, cast(null as {u}))),
                'done', concat(s.done,
                   if(r.a.mass > 0 and r.a.mass < r.a.size, array(r.b),
                   if(r.b.mass > 0 and r.b.mass < r.b.size, array(r.a), array(r.a, r.b)))))
            )[0])[0])[0]),
      s -> if(s.open is null, s.done, concat(s.done, array(s.open))))"""
    return lists.select("source", F.explode(F.expr(fold)).alias("x")).select("source", "x.key", "x.doc_id", "x.size", "x.mass", *[f"x.{c}" for c in own])


def _told_apart(units: DataFrame, chunk: int) -> DataFrame:
    """Units whose key more than a chunk of rows share (repeated rows) with a key of their own each, by their place in
    the written table; all others as they are."""
    many, count, size = written_and_counted(units.groupBy("key").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > chunk)
                                            .select(F.col("key").alias("shared")), "mix-repeated")
    if not count:
        return units.drop("place")
    many = F.broadcast(many) if fits_broadcast(count, size, MOST_SHARED) else many.hint("merge")
    own = F.when(F.col("shared").isNotNull(), F.xxhash64("key", "place")).otherwise(F.col("key"))
    return units.join(many, F.col("key") == F.col("shared"), "left").withColumn("key", own).drop("shared", "place")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST, chunk: int = CHUNK,
        seed: int = SEED, row: str | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target (its source's), copies, taken of every document (doc_id, source, text);
    also row, if ``row`` names a column that numbers the rows.  Chunks are then dealt by all other columns too.

    Each level is written before the next one starts; their number is the logarithm of the largest
    source's documents, to the base CHUNK."""
    own = [] if row is None else ["row"]
    sizes = materialize(doc_sizes(docs, row).withColumn("place", F.monotonically_increasing_id()), "mix-sizes")
    t = materialize(source_targets(sizes, weights, share, most), "mix-targets")
    t = t.withColumn("f", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0))
    # a whole number of copies may come out a rounding error too small
    t = t.withColumn("whole", F.floor(F.col("f") + 1e-12)).withColumn("rest", F.greatest(F.lit(0.0), F.col("f") - F.col("whole")))

    def with_source(rows: DataFrame, table: DataFrame, *columns: str) -> DataFrame:
        side = table.select(F.col("source").alias("t_source"), *columns)
        return rows.join(side, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")

    units = (with_source(sizes, t, "rest", F.col("n_docs").alias("n"))
             .select("source", F.xxhash64("doc_id", "source", "size", *["same" for _ in own]).alias("key"), "doc_id", "size",
                     (F.col("rest") * F.col("size")).alias("mass"), *own, "n", "place"))
    units = _told_apart(units, chunk)
    fractional = (F.col("mass") > 0) & (F.col("mass") < F.col("size"))
    decided = [units.where(~fractional).drop("n")]
    units, level = units.where(fractional), 0
    while True:
        met = materialize(_meet(units, level, chunk, seed), f"mix-level{level}")
        decided.append(met.where(~fractional))
        left = met.where(fractional)
        counts = materialize(left.groupBy("source").agg(F.count(F.lit(1)).alias("n")), "mix-left")
        if counts.where("n > 1").isEmpty():
            break
        units = with_source(left, counts, "n")
        level += 1
    # the last unit of a source is rounded by itself
    draw = F.pmod(F.xxhash64(F.lit(seed), F.lit("last"), "key"), F.lit(1 << 53)) / F.lit(float(1 << 53))
    last = F.when(draw * F.col("size") < F.col("mass"), F.col("size").cast("double")).otherwise(F.lit(0.0))
    decided.append(left.withColumn("mass", last))
    out = with_source(reduce(DataFrame.unionByName, decided), t, "source_size", "target", "whole")
    copies = (F.col("whole") + (F.col("mass") > 0).cast("long")).alias("copies")
    return (out.select("doc_id", "source", "size", "source_size", "target", copies, *own)
            .withColumn("taken", F.col("copies") * F.col("size")))


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mix(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "size", "source_size", "target", "taken")
