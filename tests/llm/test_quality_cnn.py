"""Byte-level network: chunk cover, gradients, brute-force score, held-out accuracy, edge rows."""

import pickle

import numpy as np
import pyarrow as pa
import pytest

from vitalspark.llm import quality_cnn as Q
from vitalspark.llm.arrow_text import slices

TEXTS = ["", "a", "x" * 191, "y" * 192, "z" * 193, "é" * 400, "The quick brown fox. " * 40]


def brute(net, text):
    """The score of one text, window by window."""
    b = text.encode()
    logits = []
    start = 0
    while True:
        part = b[start:start + Q.CHUNK + Q.WIDTH - 1] + b"\0" * (Q.CHUNK + Q.WIDTH)
        windows = max(1, min(Q.CHUNK, len(b) - start))
        p = np.max([sum(net.conv[j][part[i + j]] for j in range(Q.WIDTH)) for i in range(windows)], axis=0) + net.bias
        h = np.maximum(np.maximum(p, 0) @ net.hidden + net.hidden_bias, 0)
        logits.append(h @ net.out + net.out_bias[0])
        if start + Q.CHUNK >= len(b):
            break
        start += Q.STRIDE
    x = np.array([np.mean(logits), max(logits), min(logits), 1.0])
    return 1 / (1 + np.exp(-x @ net.combine))


def test_score_is_that_of_all_windows():
    net = Q.Net(np.random.default_rng(3))
    net.combine = np.array([0.4, 0.3, 0.2, 0.1])
    for limit in (10, 1 << 20):
        got = np.concatenate([net.score(s) for s in slices(pa.array(TEXTS), max_bytes=limit)])
        assert np.allclose(got, [brute(net, t) for t in TEXTS], atol=1e-5)


def test_gradients():
    rng = np.random.default_rng(4)
    net = Q.Net(rng)
    for k in Q.Net.NAMES:
        setattr(net, k, getattr(net, k).astype(np.float64))
    s = next(slices(pa.array([bytes(rng.integers(97, 105, 230, dtype=np.uint8)).decode() for _ in range(6)])))
    data, windows, _ = Q.chunks(s)
    label = rng.integers(0, 2, len(data))
    loss = lambda: float(np.mean(np.logaddexp(0, (z := net.head(net.pooled(data, windows)[0])[2])) - label * z))
    grads = net.gradients(data, windows, label, 1.0)
    for k, where in (("bias", 3), ("hidden", (2, 5)), ("out", 4), ("conv", (2, 100, 7)), ("conv", (0, 98, 1))):
        w = getattr(net, k)
        old, eps = w[where], 1e-3
        w[where] = old + eps
        up = loss()
        w[where] = old - eps
        down = loss()
        w[where] = old
        assert abs((up - down) / (2 * eps) - grads[k][where]) < 1e-3, k


@pytest.fixture(scope="module")
def tables(spark):
    return [spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels")]


def test_held_out_accuracy(spark, tables):
    docs, labels = tables
    out = Q.classify(docs.repartition(3), Q.train(docs, labels)).join(labels, "doc_id").where("held_out").collect()
    good = [r for r in out if r.quality == 1]
    bad = [r for r in out if r.quality == 0]
    assert sum(r.predicted for r in good) >= 0.95 * len(good)
    assert sum(1 - r.predicted for r in bad) >= 0.7 * len(bad)


def test_held_out_labels_are_not_read(spark, tables, monkeypatch):
    monkeypatch.setattr(Q, "EPOCHS", 1)
    monkeypatch.setattr(Q, "EPOCH_CHUNKS", 1024)
    docs, labels = tables
    flipped = labels.selectExpr("doc_id", "CASE WHEN crc32(cast(cast(doc_id AS string) AS binary)) % 5 = 0 THEN 1 - quality ELSE quality END AS quality")
    a, b = (pickle.loads(Q.train(docs, x)) for x in (labels, flipped))
    assert all(np.array_equal(getattr(a, k), getattr(b, k)) for k in (*Q.Net.NAMES, "combine"))


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "word " * 50000), (3, "same"), (None, "x")], "doc_id long, text string").selectExpr("*", "1 AS quality", "2D AS score")
    none = spark.createDataFrame([(1, None), (None, 1)], "doc_id long, quality int")
    out = Q.classify(docs, Q.train(docs, none)).collect()
    assert len(out) == 5 and all(r.score == 0.5 and r.predicted == 1 for r in out)
    net = pickle.dumps(Q.Net(np.random.default_rng(1)))
    scores = {(r.doc_id, r.score) for r in Q.classify(docs.where("doc_id < 3"), net).collect()}
    assert len({s for _, s in scores}) == 1
    assert Q.classify(docs.where("false"), net).count() == 0
