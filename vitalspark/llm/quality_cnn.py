"""Quality classifier: a byte-level convolutional network in numpy.

A document's bytes are cut into overlapping chunks that cover all of it.
Learned filters (a weight for each byte value at each of WIDTH places) run over
a chunk, each filter keeps its maximum, a small hidden layer makes a logit of
the maxima, and the mean, largest and smallest chunk logit make the document's
one probability.

Training uses at most SAMPLE labelled documents of each class, those with the
smallest hash of their id, in one task; scoring covers every byte of every
document.  Inputs are the text's bytes alone.

Defined cases: a null text is empty; an empty text is one chunk of padding and
gets a score; a document without label is scored like any other; several
labels of one document count as the smallest; null labels and ids aren't
learned from; with labels of one class or none the score is that class's
share (1/2 without any); other columns are ignored.
"""

from __future__ import annotations

import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalspark.llm.arrow_text import Slice, by_bytes, slices, trimmed

SAMPLE = 3000
CHUNK, STRIDE = 192, 160
WIDTH, FILTERS, HIDDEN = 6, 24, 16
EPOCHS, EPOCH_CHUNKS, BATCH = 10, 24_000, 256
BLOCK = 64
SLICE = 1 << 19     # bytes of text that are scored at once
PART = 2048         # chunks whose bytes are spread out at once
THRESHOLD = 0.3


def _places(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of all chunks, the bytes left of their rows from there on, and where each row's chunks begin."""
    size = s.ends - s.starts
    n = 1 + np.maximum(0, -(-(size - CHUNK) // STRIDE))
    at = np.concatenate([[0], np.cumsum(n)])
    row = np.repeat(np.arange(s.n), n)
    start = s.starts[row] + (np.arange(len(row)) - at[row]) * STRIDE
    return start, s.ends[row] - start, at


def _bytes(buf: np.ndarray, start: np.ndarray, left: np.ndarray) -> np.ndarray:
    """Bytes of the chunks, padded with 0."""
    place = np.arange(CHUNK + WIDTH - 1)
    data = buf[np.minimum(start[:, None] + place, len(buf) - 1)]
    short = np.flatnonzero(left < CHUNK + WIDTH - 1)
    data[short] *= place < left[short, None]
    return data


def chunks(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all chunks, the number of windows that start in each, and where each row's begin."""
    start, left, at = _places(s)
    parts = [_bytes(s.buf, start[i:i + PART], left[i:i + PART]) for i in range(0, len(start), PART)]
    return np.concatenate([np.zeros((0, CHUNK + WIDTH - 1), np.uint8), *parts]), np.clip(left, 1, CHUNK), at


class Net:
    def __init__(self, rng: np.random.Generator):
        f = np.float32
        self.conv = rng.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(f)
        self.conv[:, 0] = 0
        self.bias = np.zeros(FILTERS, f)
        self.hidden = rng.normal(0, FILTERS ** -0.5, (FILTERS, HIDDEN)).astype(f)
        self.hidden_bias = np.zeros(HIDDEN, f)
        self.out = rng.normal(0, HIDDEN ** -0.5, HIDDEN).astype(f)
        self.out_bias = np.zeros(1, f)
        self.combine = np.array([1, 0, 0, 0], np.float64)      # mean, largest, smallest chunk logit, constant

    NAMES = ("conv", "bias", "hidden", "hidden_bias", "out", "out_bias")

    def pooled(self, data: np.ndarray, windows: np.ndarray, where: bool = False):
        """Maxima of the filters over each chunk, and where they stand."""
        best = np.empty((len(data), FILTERS), np.float32)
        place = np.empty((len(data), FILTERS), np.int64) if where else None
        sums = np.empty((BLOCK, CHUNK, FILTERS), np.float32)
        part = np.empty_like(sums)
        for i in range(0, len(data), BLOCK):
            x = data[i:i + BLOCK]
            total, add = sums[:len(x)], part[:len(x)]
            np.take(self.conv[0], x[:, :CHUNK], axis=0, out=total, mode="clip")
            for j in range(1, WIDTH):
                np.take(self.conv[j], x[:, j:j + CHUNK], axis=0, out=add, mode="clip")
                total += add
            for r in np.flatnonzero(windows[i:i + BLOCK] < CHUNK):
                total[r, windows[i + r]:] = -np.inf
            if where:
                place[i:i + len(x)] = total.argmax(axis=1)
                best[i:i + len(x)] = np.take_along_axis(total, place[i:i + len(x), None], axis=1)[:, 0]
            else:
                total.max(axis=1, out=best[i:i + len(x)])
        return best + self.bias, place

    def head(self, pooled: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        a = np.maximum(pooled, 0)
        h = np.maximum(a @ self.hidden + self.hidden_bias, 0)
        return a, h, h @ self.out + self.out_bias[0]

    def gradients(self, data, windows, label, weight) -> dict[str, np.ndarray]:
        p, place = self.pooled(data, windows, where=True)
        a, h, z = self.head(p)
        dz = ((_sigmoid(z) - label) * weight / len(z)).astype(np.float32)
        dh = np.outer(dz, self.out) * (h > 0)
        da = (dh @ self.hidden.T) * (p > 0)
        conv = np.empty_like(self.conv)
        row, f = np.arange(len(data))[:, None], np.arange(FILTERS)
        for j in range(WIDTH):
            value = data[row, place + j].astype(np.int64)
            conv[j] = np.bincount((value * FILTERS + f).ravel(), da.ravel(), 256 * FILTERS).reshape(256, FILTERS)
        conv[:, 0] = 0
        return {"conv": conv, "bias": da.sum(0), "hidden": a.T @ dh, "hidden_bias": dh.sum(0), "out": h.T @ dz, "out_bias": dz.sum(keepdims=True)}

    def features(self, logit: np.ndarray, at: np.ndarray) -> np.ndarray:
        n = np.diff(at)
        first = at[:-1]
        return np.stack([np.add.reduceat(logit.astype(np.float64), first) / n, np.maximum.reduceat(logit, first),
                         np.minimum.reduceat(logit, first), np.ones(len(n))], axis=1)

    def score(self, s: Slice) -> np.ndarray:
        start, left, at = _places(s)
        logit = np.concatenate([self.head(self.pooled(_bytes(s.buf, start[i:i + PART], left[i:i + PART]), np.clip(left[i:i + PART], 1, CHUNK))[0])[2]
                                for i in range(0, len(start), PART)])
        return _sigmoid(self.features(logit, at) @ self.combine)


class Constant:
    """What is left to say when the labels show one class or none."""

    def __init__(self, share: float):
        self.share = share

    def score(self, s: Slice) -> np.ndarray:
        return np.full(s.n, self.share)


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def fit(texts: pa.Array, label: np.ndarray, prior: float, seed: int = 7) -> Net | Constant:
    """Adam over random chunks of the sample, then a logistic fit of the documents' combination, set to the prior."""
    if len(label) == 0 or label.min() == label.max():
        return Constant(float(label.mean()) if len(label) else 0.5)
    rng = np.random.default_rng(seed)
    parts = [chunks(s) for s in slices(texts)]
    data, windows = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    n = np.concatenate([np.diff(p[2]) for p in parts])
    at = np.concatenate([[0], np.cumsum(n)])
    doc = np.repeat(np.arange(len(n)), n)
    # each document counts alike, whatever its length, and each class alike
    share = np.where(label == 1, 0.5 / label.sum(), 0.5 / (1 - label).sum())
    draw = np.cumsum((share / n)[doc])
    net = Net(rng)
    mean = {k: np.zeros_like(getattr(net, k)) for k in Net.NAMES}
    square = {k: np.zeros_like(getattr(net, k)) for k in Net.NAMES}
    steps = EPOCHS * EPOCH_CHUNKS // BATCH
    for t in range(1, steps + 1):
        pick = np.minimum(np.searchsorted(draw, rng.random(BATCH) * draw[-1]), len(doc) - 1)
        rate = 0.01 * min(1, 2 * (1 - (t - 1) / steps))
        for k, g in net.gradients(data[pick], windows[pick], label[doc[pick]], 1.0).items():
            mean[k] += 0.1 * (g - mean[k])
            square[k] += 0.001 * (g * g - square[k])
            w = getattr(net, k)
            w -= (rate * (mean[k] / (1 - 0.9 ** t)) / (np.sqrt(square[k] / (1 - 0.999 ** t)) + 1e-7)).astype(np.float32)
    logit = np.concatenate([net.head(net.pooled(data[i:i + 8192], windows[i:i + 8192])[0])[2] for i in range(0, len(data), 8192)])
    x, w = net.features(logit, at), share
    beta = np.array([0.5, 0, 0.5, 0])
    for _ in range(30):      # Newton steps with a small ridge
        p = _sigmoid(x @ beta)
        g = x.T @ (w * (p - label)) + 1e-3 * beta
        h = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(4)
        beta = beta - np.linalg.solve(h, g)
    beta[3] += np.log(prior / (1 - prior))
    net.combine = beta
    return net


def held_out(column: str = "doc_id"):
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5 == 0


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> bytes:
    """The fitted network (a few hundred KB), learned in one task from ``sample`` documents of each class at most."""
    known = (labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality")))
    known = known.where(~held_out())
    ids = None
    for value in (0, 1):
        one = known.where(F.col("quality") == value).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        ids = one if ids is None else ids.unionByName(one)
    n, good = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("quality"), F.lit(0))).first()
    prior = (good + 1) / (n + 2)

    def learn(batches):
        batches = list(batches)      # bounded by the sample
        if not batches:
            return
        table = pa.Table.from_batches(batches).sort_by([("doc_id", "ascending"), ("text", "ascending")])
        model = fit(table["text"].combine_chunks(), table["quality"].to_numpy(), prior)
        yield pa.record_batch([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id").select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("quality").cast("long").alias("quality"))
    rows = chosen.repartition(1).mapInArrow(trimmed(learn), "model binary").collect()      # one row
    return bytes(rows[0].model) if rows else pickle.dumps(fit(pa.array([], pa.string()), np.zeros(0, np.int64), prior))


def classify(docs: DataFrame, model: bytes, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted of every document, from its whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        net = pickle.loads(shared.value)
        for batch in batches:
            for s in slices(batch.column(1), max_bytes=SLICE):
                yield pa.record_batch([batch.column(0).slice(s.first, s.n).cast(pa.int64()), pa.array(net.score(s), pa.float64())],
                                      names=["doc_id", "score"])

    scored = by_bytes(docs.select("doc_id", "text")).mapInArrow(trimmed(run), "doc_id long, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: bytes, threshold: float = THRESHOLD) -> DataFrame:
    """The documents, with all their columns, whose score reaches the threshold; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    text = docs.columns.index("text")

    def run(batches):
        net = pickle.loads(shared.value)
        for batch in batches:
            scores = [net.score(s) for s in slices(batch.column(text), max_bytes=SLICE)]
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) >= threshold))

    return by_bytes(docs).mapInArrow(trimmed(run), docs.schema)


def op10_quality_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    return classify(docs, train(docs, labels))
