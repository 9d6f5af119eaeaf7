"""Nearest neighbours by inner product: a block matrix join of int8 tiles with error bounds.

Vectors are scaled to int8, x = s q + e with the error's length |e| kept.  For
every query block and candidate block one task multiplies the int8 matrices
and gets each product to within |s q||e'| + |e||y|.  A candidate can only be
among a query's K nearest if its upper bound reaches the K-th largest lower
bound; those that can are computed again in double precision from the original
vectors, and each query keeps a heap of K over its blocks.  Nothing is
approximate in the result.

The work is queries times candidates by contract, dealt out as a grid: a cell
has QUERY_BLOCKS blocks of queries and CANDIDATE_BLOCKS of candidates, so a
block travels once for each row or column of the grid and not once for each
block of the other side.  A cell's queries are held, its candidate blocks pass
by them one by one.  Vectors of different lengths never meet.

Defined cases: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do rows with a null id; a candidate with the
query's id is the query itself; of several rows with one query id the smallest
vector is the query; repeated rows of another id count each, ties in score go
to the smaller id; with fewer than K candidates all are returned;
other columns are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vitalspark.session import materialize

K = 20
QUERY_BLOCK = 256
CANDIDATE_BLOCK = 1024
QUERY_BLOCKS, CANDIDATE_BLOCKS = 8, 16      # of a cell


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, dim and embedding of the rows that take part."""
    v = vectors.select("vec_id", "embedding").where("vec_id IS NOT NULL AND embedding IS NOT NULL")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return v.where(finite & F.exists("embedding", lambda x: x != 0)).select("vec_id", F.size("embedding").alias("dim"), "embedding")


def _blocks(vectors: DataFrame, size: int) -> tuple[DataFrame, DataFrame]:
    """(dim, block, ids, matrix): about ``size`` vectors packed into one row; and (dim, blocks), a row a vector length."""
    counts = vectors.groupBy("dim").agg(F.ceil(F.count(F.lit(1)) / size).cast("int").alias("blocks"))
    counts = materialize(counts, "block-counts")

    def pack(group):
        ids = group["vec_id"].to_numpy().astype(np.int64)
        order = np.argsort(ids, kind="stable")
        matrix = group["embedding"].combine_chunks().flatten().to_numpy().reshape(len(ids), -1)[order]
        return pa.table({"dim": group["dim"][:1], "block": group["block"][:1], "ids": pa.array([ids[order].tobytes()], pa.binary()),
                         "matrix": pa.array([matrix.astype(np.float64).tobytes() if matrix.dtype != np.float32 else matrix.tobytes()], pa.binary()),
                         "single": pa.array([matrix.dtype == np.float32])})

    # a row a vector length: broadcast whatever the number of vectors
    # repeated rows are dealt out by their places
    dealt = (vectors.withColumn("place", F.monotonically_increasing_id()).join(F.broadcast(counts), "dim")
             .withColumn("block", F.pmod(F.xxhash64("vec_id", "embedding", "place"), F.col("blocks")).cast("int")).drop("place"))
    return dealt.groupBy("dim", "block").applyInArrow(pack, "dim int, block int, ids binary, matrix binary, single boolean"), counts


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scale, length of the scaled values, length of the error."""
    scale = np.abs(x).max(axis=1) / 127
    # where squares may overflow or vanish there is no finite bound
    safe = (scale > 1e-140) & (scale < 1e140)
    s = np.where(safe, scale, 1.0)
    x = np.where(safe[:, None], x, 0)
    q = np.rint(x / s[:, None]).astype(np.int8)
    back = q * s[:, None]
    return q, s, np.sqrt((back ** 2).sum(axis=1)), np.where(safe, np.sqrt(((x - back) ** 2).sum(axis=1)), np.inf)


def tile(queries, candidates, k: int = K) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, candidate id, score) of each query's k nearest in one pair of blocks."""
    (qid, q), (cid, c) = queries, candidates
    qq, qs, ql, qe = quantise(q)
    cq, cs, cl, ce = quantise(c)
    # float32 holds sums of int8 products exactly below 2^24, double beyond
    kind = np.float32 if q.shape[1] * 127 * 127 < 1 << 24 else np.float64
    about = (qq.astype(kind) @ cq.astype(kind).T).astype(np.float64) * qs[:, None] * cs
    with np.errstate(invalid="ignore", over="ignore"):
        bound = ql[:, None] * ce + qe[:, None] * (cl + ce)
        bound = np.where(np.isnan(bound), np.inf, bound) * (1 + 1e-9) + 1e-9 * np.abs(about) + 1e-300
    low = about - bound
    own = qid[:, None] == cid
    low[own] = -np.inf
    kept = min(k, low.shape[1])
    least = np.partition(low, low.shape[1] - kept, axis=1)[:, low.shape[1] - kept]
    can = (about + bound >= least[:, None]) & ~own
    out = []
    for i in range(len(qid)):
        j = np.flatnonzero(can[i])
        score = (c[j] * q[i]).sum(axis=1)
        if len(j) > k:
            edge = np.partition(score, len(j) - k)[len(j) - k]
            keep = score >= edge
            j, score = j[keep], score[keep]
        order = np.lexsort((cid[j], -score))[:k]
        out.append((np.full(len(order), qid[i]), cid[j][order], score[order]))
    return tuple(np.concatenate([o[n] for o in out]) for n in range(3))


def nearest(queries: DataFrame, candidates: DataFrame, k: int = K, query_block: int = QUERY_BLOCK,
            candidate_block: int = CANDIDATE_BLOCK, query_blocks: int = QUERY_BLOCKS, candidate_blocks: int = CANDIDATE_BLOCKS) -> DataFrame:
    """query_id, rank, vec_id, score of the k candidates with the largest inner product with each query."""
    one = usable(queries).groupBy("vec_id").agg(F.min("embedding").alias("embedding")).select("vec_id", F.size("embedding").alias("dim"), "embedding")
    q, q_counts = _blocks(one, query_block)
    c, c_counts = _blocks(usable(candidates), candidate_block)

    def dealt(blocks: DataFrame, side: int, own: int, counts: DataFrame, other: int) -> DataFrame:
        """Each block once for every row (or column) of the grid that the other side's blocks make."""
        lines = F.sequence(F.lit(0), F.floor((F.col("blocks") - 1) / other).cast("int"))
        placed = blocks.join(F.broadcast(counts), "dim").withColumn("line", F.explode(lines))
        mine = F.floor(F.col("block") / own).cast("int")
        row, column = (mine, F.col("line")) if side == 0 else (F.col("line"), mine)
        return placed.select("dim", row.alias("row"), column.alias("col"), F.lit(side).alias("side"), "block", "ids", "matrix", "single")

    cells = (dealt(q, 0, query_blocks, c_counts, candidate_blocks).unionByName(dealt(c, 1, candidate_blocks, q_counts, query_blocks))
             .repartition("dim", "row", "col").sortWithinPartitions("dim", "row", "col", "side", "block"))

    def run(batches):
        cell, queries, best = None, [], {}      # best: a heap of (score, -vec_id) for each query of the cell

        def found():
            rows = [(query, -v, score) for query, heap in best.items() for score, v in heap]
            for i in range(0, len(rows), 50_000):
                part = list(zip(*rows[i:i + 50_000]))
                yield pa.record_batch([pa.array(part[0], pa.int64()), pa.array(part[1], pa.int64()), pa.array(part[2], pa.float64())],
                                      names=["query_id", "vec_id", "score"])

        for batch in batches:
            for r in range(batch.num_rows):
                here = tuple(batch.column(k)[r].as_py() for k in range(3))
                if here != cell:
                    yield from found()
                    cell, queries, best = here, [], {}
                kind = np.float32 if batch.column(6)[r].as_py() else np.float64
                # bytes of its own: the batch goes
                block = (np.frombuffer(batch.column(4)[r].as_py(), np.int64),
                         np.frombuffer(batch.column(5)[r].as_py(), kind).astype(np.float64).reshape(-1, here[0]))
                if batch.column(3)[r].as_py() == 0:
                    queries.append(block)
                    continue
                for own in queries:
                    for query, vec, score in zip(*(x.tolist() for x in tile(own, block, k))):
                        heap = best.setdefault(query, [])
                        if len(heap) < k:
                            heapq.heappush(heap, (score, -vec))
                        elif (score, -vec) > heap[0]:
                            heapq.heapreplace(heap, (score, -vec))
        yield from found()

    found = (cells.select("dim", "row", "col", "side", "ids", "matrix", "single")
             .mapInArrow(run, "query_id long, vec_id long, score double"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op7_block_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors.where("vec_id % 20 = 0"), vectors)


ORACLE_SQL = """
WITH v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM p
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 20"""
