"""Language of a text by unigram pieces, summed over all ways to cut its words into pieces.

The pieces are a fixed public vocabulary of byte strings (a rank file).  A text
is read as units: each word with a space before it, A-Z lower-cased, longer
ones cut at character borders into at most UNIT bytes.  A language gives a
probability to each piece; a unit's probability is the sum over all its
segmentations of the product of their pieces' (forward algorithm), a text's
the product of its units' and the language's share of the documents.

Learning: units are counted per language over all training documents in Spark,
so what follows grows with the different units, not the text.  ROUNDS rounds of
expectation maximisation start from equal piece probabilities; forward and
backward sums give each piece's expected count, taken as whole 1/65536ths, so
their sum doesn't depend on the order.  A language's estimate is mixed with a
share of all languages' and of the uniform distribution, so every text has a
probability in every language.  The driver holds one number a language and
piece: languages are assumed to be few, like the vocabulary.

Defined cases: text without a letter, or null: ``und``, score 0; so is every
text where nothing was learned.  A null lang or doc_id isn't learned from (a
null doc_id isn't held out either); a language whose training texts have no
words has the piece probabilities of all languages together; ties go to the
first language in byte order; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalspark.llm.arrow_text import LOWER, Slice, ragged, slices, span_ids
from vitalspark.llm.bpe import read_ranks
from vitalspark.session import materialize

UNIT = 24                   # most bytes of a unit, without the space before it
ROUNDS = 2
SHARED = 1e-3               # of a language's piece probabilities, half from all languages', half uniform
FIXED = 1 << 16
BATCH_UNITS = 2048
UNKNOWN = "und"
U = np.uint64


class Trie:
    """The vocabulary's byte strings; piece numbers are ranks."""

    def __init__(self, pieces: dict[bytes, int]):
        self.size = max(pieces.values()) + 1
        nodes: dict[tuple[int, int], int] = {}
        ends: dict[int, int] = {}
        for piece, rank in pieces.items():
            if len(piece) > UNIT + 1:
                continue
            at = 0
            for byte in piece:
                at = nodes.setdefault((at, byte), len(nodes) + 1)
            ends[at] = rank
        key = np.array([a << 8 | b for a, b in nodes], np.int64)
        order = np.argsort(key)
        self.key, self.node = key[order], np.fromiter(nodes.values(), np.int64, len(nodes))[order]
        self.root = np.zeros(256, np.int64)             # the first two steps by table: 0 where there is none
        self.second = np.zeros((256, 256), np.int64)
        for (a, byte), node in nodes.items():
            if not a:
                self.root[byte] = node
        top = {int(n): b for b, n in enumerate(self.root) if n}
        for (a, byte), node in nodes.items():
            if a in top:
                self.second[top[a], byte] = node
        self.piece = np.full(len(nodes) + 1, -1, np.int64)
        self.piece[list(ends)] = list(ends.values())

    def spans(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """unit, first byte, end and piece number of every piece that stands in a unit data[at[i]:at[i + 1]]."""
        size = np.diff(at)
        unit = np.repeat(np.arange(len(size)), size)
        place = np.arange(len(data))
        stop = np.repeat(at[1:], size)
        node = np.zeros(len(data), np.int64)
        found = []
        for k in range(UNIT + 1):
            inside = place + k < stop
            unit, place, stop, node = unit[inside], place[inside], stop[inside], node[inside]
            if not len(place):
                break
            if k == 0:
                node = self.root[data]
            elif k == 1:
                node = self.second[data[place], data[place + 1]]
            else:
                key = node << 8 | data[place + k]
                where = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
                node = np.where(self.key[where] == key, self.node[where], 0)
            there = node > 0
            unit, place, stop, node = unit[there], place[there], stop[there], node[there]
            piece = self.piece[node]
            whole = piece >= 0
            found.append((unit[whole], place[whole] - at[unit[whole]], place[whole] - at[unit[whole]] + k + 1, piece[whole]))
        return tuple(np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(4))


def units(s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the units of a slice and where each row's begin in them.  A word's first unit includes the byte
    before it, which is made a space."""
    starts, ends, at = s.words()
    s.buf[starts - 1] = 32
    pieces = np.maximum(1, -(-(ends - starts) // UNIT))
    if len(pieces) and pieces.max() > 1:
        word = np.repeat(np.arange(len(starts)), pieces)
        first = np.concatenate([[0], np.cumsum(pieces)])
        cut = starts[word] + (np.arange(len(word)) - first[word]) * UNIT
        inner = np.arange(len(word)) > first[word]
        for _ in range(3):                                # back to the character's first byte
            cut = np.where(inner & ((s.buf[cut] & 0xC0) == 0x80), cut - 1, cut)
        new_ends = np.where(np.append(inner[1:], False), np.append(cut[1:], 0), ends[word])
        starts, ends, at = np.where(inner, cut, cut - 1), new_ends, first[at]
    else:
        starts = starts - 1
    return starts, ends, at


def forward(spans, weight: np.ndarray, n: int) -> np.ndarray:
    """Sums over all segmentations up to each byte (unit, byte, language); ``weight`` of each span (and language)."""
    unit, start, end, _ = spans
    out = np.zeros((n, UNIT + 4, weight.shape[1]))
    out[:, 0] = 1
    order = np.argsort(end * n + unit, kind="stable")
    unit, start, end = unit[order], start[order], end[order]
    bounds = np.searchsorted(end, np.arange(UNIT + 5))
    for j in range(1, UNIT + 4):
        a, b = bounds[j], bounds[j + 1]
        if a < b:
            own = unit[a:b]
            first = np.flatnonzero(np.diff(own, prepend=-1))
            out[own[first], j] = np.add.reduceat(out[own, start[a:b]] * weight[order[a:b]], first)
    return out


def expected(spans, weight: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The probability that each span is a piece of its unit, over all segmentations."""
    unit, start, end, _ = spans
    n = len(size)
    before = forward(spans, weight[:, None], n)[:, :, 0]
    after = np.zeros((n, UNIT + 4))
    after[np.arange(n), size] = 1
    order = np.argsort(start, kind="stable")
    bounds = np.searchsorted(start[order], np.arange(UNIT + 4))
    for j in reversed(range(UNIT + 3)):
        pick = order[bounds[j]:bounds[j + 1]]
        if len(pick):
            after[:, j] += np.bincount(unit[pick], after[unit[pick], end[pick]] * weight[pick], n)
    return before[unit, start] * weight * after[unit, end] / before[np.arange(n), size][unit]


# ---- learning ------------------------------------------------------------------------------------------------------------

def count_units(docs: DataFrame) -> DataFrame:
    """lang, unit (bytes), n over all (lang, text): counted per slice, then in Spark."""
    def run(batches):
        for batch in batches:
            lang = batch.column(0).dictionary_encode()
            code = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            for s in slices(batch.column(1), LOWER):
                starts, ends, at = units(s)
                number, unit = span_ids(s.buf, starts, ends)
                pair, n = np.unique(np.repeat(code[s.first:s.first + s.n], np.diff(at)) << 32 | number, return_counts=True)
                yield pa.record_batch([lang.dictionary.take(pa.array(pair >> 32)), unit.take(pa.array(pair & 0xFFFFFFFF)).cast(pa.binary()),
                                       pa.array(n, pa.int64())], names=["lang", "unit", "n"])

    return docs.select("lang", "text").mapInArrow(run, "lang string, unit binary, n long").groupBy("lang", "unit").agg(F.sum("n").alias("n"))


def mixed(counts: np.ndarray) -> np.ndarray:
    """Piece probabilities of each language (row) from expected counts."""
    every = counts.sum(axis=0)
    uniform = np.full(counts.shape[1], 1 / counts.shape[1])
    pool = every / every.sum() if every.sum() else uniform
    total = counts.sum(axis=1, keepdims=True)
    own = np.where(total > 0, counts / np.maximum(total, 1), pool)
    return (1 - SHARED) * own + SHARED * (pool + uniform) / 2


class Model:
    KEEP = 200_000          # different units whose probabilities a worker keeps

    def __init__(self, trie: Trie, langs: list[str], prior: np.ndarray, probability: np.ndarray):
        self.trie, self.langs, self.prior, self.probability = trie, langs, prior, np.ascontiguousarray(probability.T)
        self.known: dict[bytes, int] = {}
        self.logs = np.zeros((0, len(langs)))

    def score(self, s: Slice) -> tuple[np.ndarray, np.ndarray]:
        """The number of the likeliest language of each row of a slice read with LOWER, and its probability."""
        starts, ends, at = units(s)
        number, unit = span_ids(s.buf, starts, ends)
        log = self.unit_logs(unit)
        total = np.zeros((s.n, len(self.langs)))
        row = np.repeat(np.arange(s.n), np.diff(at))
        for k in range(len(self.langs)):
            total[:, k] = np.bincount(row, log[number, k], s.n)
        total += np.log(self.prior)
        best = total.argmax(axis=1)
        return best, 1 / np.exp(total - total.max(axis=1, keepdims=True)).sum(axis=1)

    def unit_logs(self, unit: pa.Array) -> np.ndarray:
        """Log probabilities of different units in each language."""
        if len(self.known) > self.KEEP:
            self.known, self.logs = {}, self.logs[:0]
        spelled = unit.to_pylist()
        place = np.fromiter((self.known.get(u, -1) for u in spelled), np.int64, len(spelled))
        new = np.flatnonzero(place < 0)
        if len(new):
            fresh = unit.take(pa.array(new))
            logs = [np.log(self._probability(fresh.slice(i, BATCH_UNITS))) for i in range(0, len(new), BATCH_UNITS)]
            place[new] = len(self.logs) + np.arange(len(new))
            self.known.update(zip([spelled[i] for i in new.tolist()], place[new].tolist()))
            self.logs = np.concatenate([self.logs, *logs])
        return self.logs[place]

    def _probability(self, unit: pa.Array) -> np.ndarray:
        data, at = flat(unit)
        spans = self.trie.spans(data, at)
        return forward(spans, self.probability[spans[3]], len(unit))[np.arange(len(unit)), np.diff(at)]


def flat(unit: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an array of binaries, and where each one's begin."""
    wide = unit.cast(pa.large_binary())
    _, offsets, data = wide.buffers()
    at = np.frombuffer(offsets, np.int64)[wide.offset:wide.offset + len(wide) + 1]
    size = np.diff(at)
    pool = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return ragged(pool, at[:-1], size), np.concatenate([[0], np.cumsum(size)])


def train(docs: DataFrame, pieces: dict[bytes, int], rounds: int = ROUNDS) -> Model:
    """The model of all documents (lang, text) with a language."""
    spark = docs.sparkSession
    docs = docs.where("lang IS NOT NULL")
    trie = Trie(pieces)
    shares = {r.lang: r.n for r in docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}     # a row a language
    langs = sorted(shares, key=str.encode)
    prior = np.array([shares[c] for c in langs], float)
    probability = np.full((len(langs), trie.size), 1 / trie.size)
    if langs:
        counted = materialize(count_units(docs), "language-units")
        for _ in range(rounds):
            probability = mixed(_expected_counts(spark, counted, trie, langs, probability))
    return Model(trie, langs, prior / max(prior.sum(), 1), probability)


def _expected_counts(spark: SparkSession, counted: DataFrame, trie: Trie, langs: list[str], probability: np.ndarray) -> np.ndarray:
    shared = spark.sparkContext.broadcast((trie, langs, probability))       # size: vocabulary x languages

    def run(batches):
        trie, langs, probability = shared.value
        index = {c: i for i, c in enumerate(langs)}
        total: dict[int, int] = {}
        for batch in batches:
            for i in range(0, batch.num_rows, BATCH_UNITS):
                part = batch.slice(i, BATCH_UNITS)
                lang = np.array([index[c] for c in part.column(0).to_pylist()], np.int64)
                data, at = flat(part.column(1))
                spans = trie.spans(data, at)
                share = expected(spans, probability[lang[spans[0]], spans[3]], np.diff(at))
                whole = np.rint(share * part.column(2).to_numpy()[spans[0]] * FIXED).astype(np.int64)
                cell, inverse = np.unique(lang[spans[0]] * trie.size + spans[3], return_inverse=True)
                sums = np.zeros(len(cell), np.int64)
                np.add.at(sums, inverse, whole)
                for c, n in zip(cell.tolist(), sums.tolist()):
                    total[c] = total.get(c, 0) + n
        yield pa.record_batch([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["cell", "n"])

    rows = counted.select("lang", "unit", "n").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toPandas()
    counts = np.zeros(len(langs) * trie.size)
    counts[rows.cell.to_numpy(np.int64)] = rows.n.to_numpy(np.int64) / FIXED
    return counts.reshape(len(langs), trie.size)


# ---- prediction ----------------------------------------------------------------------------------------------------------

def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every whole text; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)    # size: vocabulary x languages
    docs = docs.select("doc_id", held_out().alias("held_out"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"))

    def run(batches):
        model = shared.value
        names = np.array([*model.langs, UNKNOWN], object)
        for batch in batches:
            letters = batch.column(3).to_numpy(zero_copy_only=False).astype(bool) & bool(model.langs)
            for s in slices(batch.column(2), LOWER):
                known = letters[s.first:s.first + s.n]
                best, score = model.score(s) if model.langs else (np.zeros(s.n, np.int64), np.zeros(s.n))
                yield pa.record_batch([batch.column(0).slice(s.first, s.n).cast(pa.int64()), batch.column(1).slice(s.first, s.n),
                                       pa.array(names[np.where(known, best, len(model.langs))].tolist(), pa.string()),
                                       pa.array(np.where(known, score, 0.0), pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def held_out() -> Column:
    """Whether the remainder of crc32(doc_id as text) by 4 is 2; false for a null id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learned = docs.where(F.col("doc_id").isNotNull() & ~held_out()).select("lang", "text")
    return predict(docs, train(learned, read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))))
