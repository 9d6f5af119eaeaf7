"""Periodic runs against all stretches tried one by one, and the grammar against plain comparison."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vitalspark.llm import periodic_runs as R

SCHEMA = "doc_id long, text string"


def brute_runs(words):
    n, found = len(words), {}
    for p in range(1, n // 4 + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j + p - i >= max(6, 4 * p):
                found.setdefault((i, j + p), p)
            i = j + 1
    return sorted((s, e - s, p) for (s, e), p in found.items())


def brute(doc, text):
    words = re.findall("[^\x20\x09-\x0D]+", text or "")
    n = len(words)
    h = zlib.crc32(str(doc).encode()) if doc is not None else 1
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    dropped = {i for s, k, p in runs for i in range(s + p, s + k)}
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()      # noqa: E731
    return (doc, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            sha("".join(f"{s},{k},{p}\n" for s, k, p in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def periodic_text(rng):
    """Repetitions of repetitions, with noise."""
    out = []
    for _ in range(rng.randrange(1, 6)):
        part = [rng.choice("abc") for _ in range(rng.randrange(1, 7))]
        part = part * rng.randrange(1, 9)
        out += (part + [rng.choice("abcd")] * rng.randrange(0, 3)) * rng.randrange(1, 6)
    return out[:400]


def words_of(rng):
    kind = rng.randrange(3)
    if kind == 0:
        return [rng.choice("ab") for _ in range(rng.randrange(0, 120))]
    return periodic_text(rng) if kind == 1 else [rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(0, 80))] + ["z"] * rng.randrange(12)


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("candidates", [50, R.CANDIDATES])
def test_runs_of_many_rows(seed, candidates):
    rng = random.Random(seed)
    rows = [words_of(rng) for _ in range(60)]
    names = {w: i for i, w in enumerate(sorted({w for r in rows for w in r}))}
    words = np.array([names[w] for r in rows for w in r], np.int64)
    at = np.concatenate([[0], np.cumsum([len(r) for r in rows])])
    first, last, period = R.find_runs(words, at, candidates)
    got = [[] for _ in rows]
    for s, e, p in zip(first.tolist(), last.tolist(), period.tolist()):
        i = int(np.searchsorted(at, s, "right")) - 1
        got[i].append((s - int(at[i]), e - s, p))
    assert got == [brute_runs(r) for r in rows]


@pytest.mark.parametrize("seed", range(4))
def test_grammar_extends_like_plain_comparison(seed):
    rng = random.Random(seed)
    x = [-1, *[ord(c) for _ in range(12) for c in words_of(rng)], -2]
    g = R.Grammar(np.array(x))
    a = np.array([rng.randrange(1, len(x) - 1) for _ in range(500)])
    b = np.array([rng.randrange(1, len(x) - 1) for _ in range(500)])
    a, b = np.minimum(a, b)[a != b], np.maximum(a, b)[a != b]
    for forward, way in ((True, 1), (False, -1)):
        got = g.extend(a, b, forward)
        for i, j, n in zip(a.tolist(), b.tolist(), got.tolist()):
            k = 0
            while 0 <= i + way * k and j + way * k < len(x) and x[i + way * k] == x[j + way * k]:
                k += 1
            assert k == n


def test_grammar_is_shallow_and_linear():
    for x in (np.zeros(100_000, np.int64), np.arange(100_000) % 7, np.random.default_rng(1).integers(0, 2, 100_000)):
        g = R.Grammar(np.concatenate([[-1], x, [-2]]))
        assert len(g.sym) < 10 * len(x)


def test_against_brute_force(spark):
    rng = random.Random(7)
    seps = [" ", "  ", "\n", "\t", " \x0b"]
    rows = [(i, "".join(w + rng.choice(seps) for w in words_of(rng))) for i in range(400)]
    rows += [(None, "a " * 9), (None, None), (3, None), (4, ""), (5, " \n "), (6, "é é é é é é ü"), (7, "x" * 300 + " y"), (8, "A a A a A a A a")]
    rows += [(9, "same words here " * 5)] * 50
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("start", "length", "period", "n_runs", "runs"):
        df = df.withColumn(c, F.lit("x"))
    got = sorted(map(tuple, R.periodic_runs(df.repartition(3), edit=True).collect()), key=str)
    assert got == sorted((brute(*r) for r in rows), key=str)
    assert sum(r[1] > 0 for r in got) > 100


def test_words_that_differ_but_share_a_polynomial_hash(spark):
    x = "a"
    for _ in range(10):
        x += x.translate(str.maketrans("ab", "ba"))
    y = x.translate(str.maketrans("ab", "ba"))
    assert R.run_table(spark.createDataFrame([(1, f"{x} {y} " * 3)], SCHEMA)).first().runs == []
    assert [tuple(r) for r in R.run_table(spark.createDataFrame([(1, f"{x} {y} " * 4)], SCHEMA)).first().runs] == [(0, 8, 2)]


def test_table_and_empty(spark):
    r = R.run_table(spark.createDataFrame([(1, "go  on on on on on on\nnow now")], SCHEMA)).first()
    assert [tuple(x) for x in r.runs] == [(1, 6, 1)] and r.collapsed == "go on now now"
    empty = spark.createDataFrame([], SCHEMA)
    assert R.run_table(empty).count() == 0 and R.periodic_runs(empty, edit=True).count() == 0


def test_very_long_texts(spark):
    words = [str(i) for i in range(90_000)]
    rows = [(1, "la " * 400_000), (2, " ".join(words)), (3, " ".join(words[:9000] * 5)), (4, "a b " * 30_000 + "c " + "a b " * 30_000)]
    got = {r.doc_id: [tuple(x) for x in r.runs] for r in R.run_table(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: [(0, 400_000, 1)], 2: [], 3: [(0, 45_000, 9000)], 4: [(0, 60_000, 2), (60_001, 60_000, 2)]}
