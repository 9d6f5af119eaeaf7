"""Block search against brute force: ties, copies, odd vectors, bounds."""

import numpy as np
import pytest

from vitalspark.llm import block_search as B


def brute(rows, queries, k):
    ok = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for q, x in ok:
        if q in queries:
            near = sorted(((-(x * y).sum(), i) for i, y in ok if i != q and len(y) == len(x)))[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(near, 1)]
    return sorted(out)


def test_against_brute_force(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(900)]
    rows += [(i, rows[7][1]) for i in range(900, 1200)]                    # a common vector
    rows += [(i, (np.array(rows[7][1]) * (1 + 1e-12 * (i - 1200))).tolist()) for i in range(1200, 1300)]
    rows += [(2000, None), (2001, []), (2002, [0.0] * 8), (2003, [1.0, None] * 4), (2004, [float("nan")] * 8), (2005, [float("inf")] * 8),
             (None, [1.0] * 8), (2006, [1e200] * 8), (2007, [1e-200] * 8), (2008, [1.0, 2.0]), (2020, [3.0, 1.0]), (2040, [-1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS block", "2 AS dim", "3 AS score").repartition(5)
    got = B.nearest(df.where("vec_id % 20 = 0"), df, 20, 16, 200).collect()
    want = brute(rows, set(range(0, 3000, 20)), 20)
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(got)] == [w[:3] for w in want]
    assert [r.score for r in sorted(got)] == pytest.approx([w[3] for w in want], rel=1e-12)


def test_bounds_hold():
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=(50, 64)) * 10 ** rng.uniform(-3, 3, (50, 1)), rng.standard_cauchy(size=(60, 64))
    q, s, length, error = B.quantise(x)
    cq, cs, clength, cerror = B.quantise(y)
    about = (q.astype(float) @ cq.T.astype(float)) * s[:, None] * cs
    bound = length[:, None] * cerror + error[:, None] * (clength + cerror)
    assert (np.abs(x @ y.T - about) <= bound * (1 + 1e-9)).all()


def test_few_candidates_repeated_queries_and_empty(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (0, [1.0, 1.0]), (1, [2.0, 2.0]), (1, [2.0, 2.0])], "vec_id long, embedding array<float>")
    got = sorted(tuple(r) for r in B.nearest(df.where("vec_id = 0"), df).collect())
    assert got == [(0, 1, 1, 4.0), (0, 2, 1, 4.0)]
    assert B.nearest(df.where("false"), df).count() == 0 and B.nearest(df, df.where("false")).count() == 0


@pytest.mark.parametrize("grid", [(1, 1), (2, 3), (50, 50)])
def test_every_grid_gives_the_same(spark, grid):
    rng = np.random.default_rng(5)
    rows = [(i, rng.normal(size=d).tolist()) for i, d in enumerate([4] * 300 + [3] * 40)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = B.nearest(df.where("vec_id % 5 = 0"), df, 7, 10, 16, *grid).collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in sorted(got)] == [w[:3] for w in brute(rows, set(range(0, 400, 5)), 7)]


def test_repeated_rows_are_dealt_into_many_blocks(spark):
    df = spark.createDataFrame([(7, [1.0, 2.0])] * 3000 + [(i, [float(i), 1.0]) for i in range(20, 3020)], "vec_id long, embedding array<double>")
    blocks, _ = B._blocks(B.usable(df), 500)
    assert max(len(r.ids) // 8 for r in blocks.collect()) < 1000
    got = B.nearest(df.where("vec_id = 20"), df, 3).collect()
    assert [(r["rank"], r.vec_id, r.score) for r in sorted(got)] == [(k, 3020 - k, 20.0 * (3020 - k) + 1) for k in (1, 2, 3)]
