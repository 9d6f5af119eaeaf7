"""Language of texts: forward sums and expected counts against all segmentations, held-out accuracy, defined cases."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from vitalspark.llm import language_id as L
from vitalspark.llm.arrow_text import LOWER, slices

P = pytest.importorskip("public_tokenizers")
SF = "/root/testdata/sf0.01"
PIECES = {bytes([b]): b for b in range(256)} | {p: 256 + i for i, p in enumerate([b" a", b"ab", b"aba", b" ab", b"ba", b"bab", b" b", "é".encode(), b" abab", b"b" * 9])}


def segmentations(unit):
    if not unit:
        yield []
    for k in range(1, len(unit) + 1):
        if unit[:k] in PIECES:
            for rest in segmentations(unit[k:]):
                yield [PIECES[unit[:k]], *rest]


def units_of(text):
    """Units by plain Python."""
    out = []
    for word in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode()):
        word = bytes(b + 32 if 65 <= b <= 90 else b for b in word)
        n = max(1, -(-len(word) // L.UNIT))
        cuts = []
        for k in range(1, n):
            c = k * L.UNIT
            while word[c] & 0xC0 == 0x80:
                c -= 1
            cuts.append(c)
        cuts = [0, *cuts, len(word)]
        parts = [word[a:b] for a, b in zip(cuts, cuts[1:])]
        out += [b" " + parts[0], *parts[1:]]
    return out


def some_text(rng):
    return "".join(rng.choice(["a", "b", "ab", "A", " ", " ", "\n", "é", "日本", "bbbbb", "x" * 30, "𝄞" * 20]) for _ in range(rng.randrange(25)))


def test_units():
    rng = random.Random(1)
    texts = ["", None, " ", "a", *[some_text(rng) for _ in range(200)]]
    for size in (10, 1 << 20):
        got = []
        for s in slices(pa.array(texts), LOWER, size):
            starts, ends, at = L.units(s)
            got += [[s.buf[a:b].tobytes() for a, b in zip(starts[i:j], ends[i:j])] for i, j in zip(at, at[1:])]
        assert got == [units_of(t) for t in texts]
        assert max(len(u) for row in got for u in row) <= L.UNIT + 4


def test_forward_and_expected_against_all_segmentations():
    rng = random.Random(2)
    trie = L.Trie(PIECES)
    weight = np.random.default_rng(3).random((trie.size, 2))
    units = sorted({bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 11))) for _ in range(60)} | {" é".encode(), b" abab", b"b" * 11, b" abaab"})
    data, at = L.flat(pa.array(units, pa.binary()))
    spans = trie.spans(data, at)
    total = L.forward(spans, weight[spans[3]], len(units))[np.arange(len(units)), np.diff(at)]
    share = L.expected(spans, weight[spans[3], 0], np.diff(at))
    for i, u in enumerate(units):
        ways = [[math.prod(weight[p, k] for p in way) for k in (0, 1)] for way in segmentations(u)]
        assert np.allclose(total[i], np.sum(ways, axis=0))
        want = defaultdict(float)
        for way, (w, _) in zip(segmentations(u), ways):
            for p in way:
                want[p] += w / total[i, 0]
        got = defaultdict(float)
        for p, x in zip(spans[3][spans[0] == i].tolist(), share[spans[0] == i].tolist()):
            got[p] += x
        assert all(got[p] == pytest.approx(want[p]) for p in got.keys() | want.keys())


def test_training_and_scores_against_python(spark):
    rng = random.Random(4)
    rows = [(i, some_text(rng) if i % 3 else "".join(rng.choice("ab ") for _ in range(40)), rng.choice(["x", "y", "y", None])) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = L.train(df.repartition(3), PIECES, 2)
    probability = {c: [1 / 266] * 266 for c in "xy"}
    counted = {c: Counter(u for _, t, lang in rows if lang == c for u in units_of(t)) for c in "xy"}

    def sum_ways(unit, p):
        sums = [1.0] + [0.0] * len(unit)
        for j in range(1, len(unit) + 1):
            sums[j] = sum(sums[i] * p[PIECES[unit[i:j]]] for i in range(j) if unit[i:j] in PIECES)
        return sums

    for _ in range(2):
        counts = {c: [0.0] * 266 for c in "xy"}
        for c, p in probability.items():
            for u, n in counted[c].items():
                before, after = sum_ways(u, p), [0.0] * len(u) + [1.0]
                for i in reversed(range(len(u))):
                    after[i] = sum(after[j] * p[PIECES[u[i:j]]] for j in range(i + 1, len(u) + 1) if u[i:j] in PIECES)
                for i in range(len(u)):
                    for j in range(i + 1, len(u) + 1):
                        if u[i:j] in PIECES:
                            k = PIECES[u[i:j]]
                            counts[c][k] += n * before[i] * p[k] * after[j] / before[-1]
        every = [a + b for a, b in zip(counts["x"], counts["y"])]
        for c in "xy":
            probability[c] = [0.999 * counts[c][k] / sum(counts[c]) + 0.001 * (every[k] / sum(every) + 1 / 266) / 2 for k in range(266)]
    assert model.langs == ["x", "y"]
    assert np.allclose(model.probability, np.array([probability["x"], probability["y"]]).T, rtol=1e-2, atol=1e-5)
    got = {r.doc_id: r for r in L.predict(df, model).collect()}
    for i, t, _ in rows:
        if not any(ch.isalpha() for ch in t):
            assert (got[i].lang_pred, got[i].score) == ("und", 0.0)
            continue
        logs = [sum(math.log(sum_ways(u, model.probability[:, k])[-1]) for u in units_of(t)) + math.log(model.prior[k]) for k in (0, 1)]
        assert got[i].lang_pred == "xy"[int(logs[1] > logs[0])]
        assert got[i].score == pytest.approx(1 / (1 + math.exp(-abs(logs[0] - logs[1]))))


def test_held_out_accuracy(spark):
    rows = L.op13_language_id(spark, SF).collect()
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and 0.15 < len(held) / len(rows) < 0.35
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) >= 0.98


def test_defined_cases(spark):
    rows = [(0, "der die das", "de"), (1, "the of and", "en"), (2, None, "en"), (3, "", None), (4, "12 34!", "de"), (None, "the the", "fr"),
            (5, "日本", None), (6, "the of " * 300_000, None), (7, "y" * 500_000, None), (8, "the", "en"), (8, "the", "en"), (9, "Ø", "no"), (10, None, "xx")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("lang_pred", F.lit("?")).withColumn("held_out", F.lit(3))
    learned = df.where("doc_id IS NOT NULL")
    model = L.train(learned, PIECES)
    got = [(r.doc_id, r.lang_pred, r.score) for r in L.predict(df, model).collect()]
    assert model.langs == ["de", "en", "no", "xx"]
    by = {d: (c, x) for d, c, x in got}
    assert len(got) == len(rows) and all(by[d] == ("und", 0.0) for d in (2, 3, 4, 10))
    assert by[0][0] == "de" and by[1][0] == by[6][0] == by[8][0] == "en" and by[9][0] == "no" and all(0 <= x <= 1 for _, _, x in got)
    nothing = L.train(df.where("false"), PIECES)
    assert {(r.lang_pred, r.score) for r in L.predict(df, nothing).collect()} == {("und", 0.0)}
    assert L.predict(df.where("false"), model).count() == 0
    assert [r.held_out for r in L.predict(df.where("doc_id IS NULL"), model).collect()] == [False]


def test_reruns_agree_whatever_the_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 200")
    a, b = (L.train(docs.repartition(n), PIECES).probability for n in (2, 7))
    assert (a == b).all()
