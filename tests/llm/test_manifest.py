"""Dataset manifest against plain Python: every leaf, root, proof and tampered row."""

import hashlib
import random
import zlib
from itertools import groupby

import pytest
from pyspark.sql import functions as F

from vitalspark.llm import manifest as M

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    """The root, and for each leaf the siblings to its left and right on every level."""
    at, paths = list(range(len(nodes))), [[] for _ in nodes]
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = k // 16 * 16
            paths[i].append((nodes[run:k], nodes[k + 1:run + 16]))
        nodes, at = [H(*nodes[i:i + 16]) for i in range(0, len(nodes), 16)], [k // 16 for k in at]
    return nodes[0], paths


def brute(rows):
    out, tops = [], []
    key = lambda r: (r[1] is not None, (r[1] or "").encode())
    for _, group in groupby(sorted(rows, key=key), key):
        group = sorted(group, key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        sub, paths = tree([leaf(r) for r in group])
        tops.append((sub, group, paths))
    root, upper = tree([t[0] for t in tops])
    for (sub, group, paths), above in zip(tops, upper):
        for row, path in zip(group, paths):
            path = path + above
            shown = row
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0 and row[4] is not None:
                shown = (*row[:4], "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in row[4]))
            folded = leaf(shown)
            for left, right in path:
                folded = H(*left, folded, *right)
            proof = H(*[h for left, right in path for h in left + right])
            out.append((row[0], leaf(row), sub, root, proof, folded, folded == root))
    return sorted(out, key=str)


def run(spark, rows, extra=()):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in extra:
        df = df.withColumn(c, F.lit(1))
    return sorted([tuple(r) for r in M.verify(M.proofs(M.leaves(df, M.tampered()))).collect()], key=str)


def some(n, sources, seed=0):
    rng = random.Random(seed)
    return [(i * 7919 % 1000003, rng.choice(sources), rng.choice(["en", None, "dé"]), rng.choice([None, i]), rng.choice([None, "", f"Text ÄB {i}", "x" * (i % 50)]))
            for i in range(n)]


@pytest.mark.parametrize("n", [1, 2, 15, 16, 17, 256, 257])
def test_sizes_of_one_source(spark, n):
    rows = some(n, ["only"], n)
    assert run(spark, rows) == brute(rows)


def test_hot_source_with_several_rounds(spark):
    rows = some(70000, ["hot"] * 18 + ["b", "", None, "é", "Z"], 3)      # over 65,536 nodes: three rounds of blocks
    rows = [(d, "hot" if i < 66000 else s, *r) for i, (d, s, *r) in enumerate(rows)]
    assert run(spark, rows) == brute(rows)


def test_many_sources(spark):
    rows = some(1200, [f"s{i}" for i in range(700)], 5)
    assert run(spark, rows) == brute(rows)


def test_repeated_rows_null_ids_long_text_and_clashing_columns(spark):
    rows = [(5, "a", "en", 4, "Same")] * 300 + [(None, "a", None, None, None)] * 20 + [(None, None, "X", 1, "Up"), (10, None, "en", 1, "ABC" * 1_000_000)]
    rows += [(i, None, "en", 1, "ABC abc") for i in range(40)]
    extra = ["g", "r", "n", "h", "kids", "load", "place", "range", "row", "leaf", "claimed", "path", "top", "block", "d0", "root"]
    got = run(spark, rows, extra)
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


def test_empty_table(spark):
    assert run(spark, []) == []


def test_a_changed_proof_or_root_is_noticed(spark):
    df = M.proofs(M.leaves(spark.createDataFrame(some(40, ["a", "b"]), SCHEMA)))
    assert M.verify(df).where("NOT verified").count() == 0
    other = df.withColumn("path", F.transform("path", lambda s: F.struct(s["left"].alias("left"), F.concat(s["right"], F.lit("0")).alias("right"))))
    assert M.verify(other).where("verified").count() == 0


def test_shuffles_are_bounded_and_proofs_have_no_join_with_nodes(spark):
    rows = M.leaves(spark.createDataFrame(some(600, ["a", "b"]), SCHEMA))
    nodes, _ = M.ranked(rows, "source", ["doc_id", "leaf", "row"])
    blocks, root = M.roll_up(nodes.select(F.col("source").alias("g"), "r", "n", F.col("leaf").alias("h"), F.lit(0).alias("load")), 600)
    assert max(r.size for r in blocks[0].select(F.size("kids").alias("size")).collect()) <= M.WIDTH
    down = root.select("g", F.lit(0).cast("long").alias("r"), F.array().cast(M.PATH).alias("path"), F.col("h").alias("top"))
    for b in reversed(blocks):
        down = M.unroll(b, down)
    assert "Join" not in down._jdf.queryExecution().executedPlan().toString()
