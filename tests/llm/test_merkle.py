"""Merkle fingerprints: edits against plain Python, equality, likeness and located changes."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

import twins
from vitalspark.llm import merkle as M
from vitalspark.llm.arrow_text import slices


def trees(texts, **kw):
    return [f for s in slices(pa.array(texts), **kw) for f in M.Trees(s).strings()]


def some_text(seed, words=200):
    rng = random.Random(seed)
    return " ".join(rng.choice(["alpha", "beta", "gámma", "delta.\n", "eps,", "zeta\n\n", "日本"]) + str(rng.randrange(50)) for _ in range(words))


def test_equality_and_slices():
    texts = ["", None, twins.A, twins.B, f"x {twins.A} y", f"x {twins.B} y", "a", "a ", " a", "a\n", "a\n\nb", "a\nb", "\n", "\n\n", *[some_text(i, i * 9) for i in range(30)], some_text(3, 27)]
    fps = trees(texts)
    assert fps == trees(texts, max_bytes=10)
    for i, x in enumerate(texts):
        for j, y in enumerate(texts):
            assert (fps[i] == fps[j]) == ((x or "") == (y or "")), (x, y)


def test_likeness_and_located_edit():
    text = some_text(1, 400)
    lines = text.split("\n")
    k = len(lines) // 2
    other = "\n".join([*lines[:k], "a new line here", *lines[k + 1:]])
    a, b = trees([text, other])
    assert M.likeness(a, b) > 0.9 and M.likeness(a, trees([some_text(2, 400)])[0]) < 0.5
    assert M.changed_paragraphs(a, b) == ([k], [k]) and M.changed_paragraphs(a, a) == ([], [])


@pytest.mark.parametrize("parts", ["1", "4", "50"])
def test_against_python(spark, parts):
    rng = random.Random(int(parts))
    rows = [(i * 7 % 83, rng.choice([None, "", "x", "日本語テスト", "ab"]) if i % 4 == 0 else some_text(i % 40, rng.randrange(1, 300))) for i in range(83)]
    rows += [(None, "null id")]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS part", "2 AS tail", "3 AS tie").repartition(5)
        got = {r.doc_id: r for r in M.compare_with_next(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    assert len(got) == len(rows)
    for i, (d, t) in enumerate(order):
        t, nxt = t or "", order[(i + 1) % len(order)][1] or ""
        k = len(t) // 3
        e = t[:len(t) - k] + nxt[:k]
        fp, efp, nfp = trees([t, e, nxt])
        r = got[d]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t), hashlib.sha256(e.encode()).hexdigest(), fp, efp), d
        assert r.near_edited == pytest.approx(M.likeness(fp, efp)) and r.near_next == pytest.approx(M.likeness(fp, nfp))


def test_lone_repeated_and_empty(spark):
    df = spark.createDataFrame([(5, "one two three")], "doc_id long, text string")
    r = M.compare_with_next(df).first()
    assert r.edited_sha256 == hashlib.sha256(b"one two tone ").hexdigest() and r.near_next == 1.0
    assert M.compare_with_next(df.where("false")).count() == 0
    twice = spark.createDataFrame([(5, "same text")] * 2 + [(6, "other"), (None, None), (None, None)], "doc_id long, text string")
    assert M.compare_with_next(twice).count() == 5 and M.fingerprints(twice).count() == 5


@pytest.mark.parametrize("alphabet", ["的一是不了人我在有他这中大来上国", "A", "ab", "の😀"])
def test_unspaced_text_has_bounded_leaves(alphabet):
    """3,000 characters without white space: leaves are bounded and an edit of the last third leaves the others."""
    text = "".join(random.Random(4).choices(alphabet, k=3000))
    other = text[:2000] + "".join(random.Random(5).choices(alphabet, k=1000))
    middle = text[:1500] + "!" + text[1501:]
    a, b, c = trees([text, other, middle])
    assert M.likeness(a, b) > 0.5 and M.likeness(a, c) > (0.9 if len(alphabet) > 2 else 0.5)
    for s in slices(pa.array([text, "line " * 5000, twins.A * 20])):
        t = M.Trees(s)
        sizes = (s.ends - s.starts) / np.maximum(np.diff(t.leaf_at), 1)
        assert (sizes <= M.LONGEST).all()


def test_a_very_long_text(spark):
    text = some_text(9, 300_000)
    df = spark.createDataFrame([(2, text), (1, text + "!")], "doc_id long, text string")
    r = {x.doc_id: x for x in M.compare_with_next(df).collect()}
    assert r[2].n_chars == len(text) and r[2].near_next > 0.999 and r[2].near_edited > 0.5
