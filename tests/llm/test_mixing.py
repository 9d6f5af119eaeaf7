"""Mixing: targets against iterative resharing, taken words near them, whole copies only."""

import pytest

from vitalspark.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, target = share * sum(sizes.values()), set(names), {}
    while open_:
        total = sum(w[s] for s in open_)
        over = {s for s in open_ if left * w[s] / total > most * sizes[s]}
        if not over:
            target.update({s: left * w[s] / total for s in open_})
            break
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
        open_ -= over
    return target


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, source string, text string").selectExpr("*", "1 AS size", "2 AS n", "3 AS mass")


@pytest.mark.parametrize("chunk", [4, 64])
def test_mix(spark, chunk):
    rows = [(i, ["a", "b", "ä", None, "z"][0 if i % 3 == 0 else i % 5], "w " * (i * 7919 % 97)) for i in range(900)]
    rows += [(900, "a", None), (901, "empty", ""), (902, "empty", None), (903, "one", "just three words"), (5, "b", "x y"), (5, "b", "x y")]
    df = docs(spark, rows)
    out = mixing.mix(df.repartition(9), chunk=chunk).collect()
    again = mixing.mix(df.repartition(3), chunk=chunk).collect()
    assert sorted(out, key=str) == sorted(again, key=str)
    assert len(out) == len(rows)
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    for s in sizes:
        mine = [r for r in out if r.source == s]
        largest = max(r.size for r in mine)
        assert all(r.source_size == sizes[s] for r in mine)
        assert all(abs(r.target - want[s]) < 1e-6 * max(1, want[s]) for r in mine)
        assert abs(sum(r.taken for r in mine) - want[s]) <= largest
    f = {s: want[s] / sizes[s] if sizes[s] else 0 for s in sizes}
    for r in out:
        copies = r.taken / r.size if r.size else 0
        assert r.taken <= 2 * r.size and copies == int(copies)
        assert r.size == 0 or abs(copies - f[r.source]) < 1


def test_expectation_is_kept(spark):
    """Short and long documents are taken about as often as the fraction says."""
    rows = [(i, "a" if i < 4000 else "b", "w " * (1 + i % 4)) for i in range(6000)]
    out = [r for r in mixing.mix(docs(spark, rows)).collect() if r.source == "b"]
    want = out[0].target / out[0].source_size
    for size in (1, 2, 3, 4):
        copies = [r.taken / r.size for r in out if r.size == size]
        assert abs(sum(copies) / len(copies) - want) < 0.08


def test_empty(spark):
    assert mixing.mix(docs(spark, [(1, "a", "b")]).where("false")).count() == 0


def test_repeated_rows_do_not_meet_in_one_chunk(spark, monkeypatch):
    """A third of the rows are equal: no chunk holds more than a few times its size, and the target is met."""
    rows = [(None, "a", "three words here")] * 4000 + [(i, "a", "w " * (1 + i % 5)) for i in range(4000)] + [(i, "b", "w") for i in range(4000)]
    largest, meet = [], mixing._meet

    def watched(units, level, chunk, seed):
        chunks = mixing.F.ceil(mixing.F.col("n") / mixing.F.lit(chunk * 0.75)).cast("long")
        dealt = units.withColumn("chunk", mixing.F.pmod(mixing.F.xxhash64(mixing.F.lit(seed + level), "key"), chunks))
        largest.append(max([r["count"] for r in dealt.groupBy("source", "chunk").count().collect()], default=0))
        return meet(units, level, chunk, seed)

    monkeypatch.setattr(mixing, "_meet", watched)
    out = mixing.mix(docs(spark, rows)).collect()
    assert len(out) == 12000 and max(largest) < 3 * mixing.CHUNK
    for s in "ab":
        mine = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= max(r.size for r in mine)


def test_a_very_long_text(spark):
    out = {r.doc_id: r for r in mixing.mix(docs(spark, [(1, "a", "w " * 500_000), (2, "a", "w " * 10), (3, "b", "w " * 30)])).collect()}
    assert out[1].size == 500_000 and all(r.taken % max(r.size, 1) == 0 and r.taken <= 2 * r.size for r in out.values())
