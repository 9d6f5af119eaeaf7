"""Interpolated modified Kneser-Ney model of order 2 or 3: counted in Spark, stored as sorted arrays, memory-mapped for scoring.

Words are counted by hash; a word's id is the rank of its hash, so ids need no
dictionary but the sorted hashes.  Bigrams are (context id, word id) in one
64-bit number; a trigram is its last two words' bigram and the word before.
Both are counted by tasks first, then dealt out, words by hash range and
n-grams by a hash of the last context word; one that starts a large part of all
bigrams is split by its words.  So no task depends on how common a word or pair
is, and a bigram's trigrams stand in its own bucket.  Every bucket becomes files
of sorted arrays in the shared folder, which workers map into memory:

* words: hash, count, continuation count (different contexts seen before the
  word), and of the word as a context: bigrams seen, once, twice, their sum
* bigrams: key, count (one byte; larger ones apart)
* trigrams: place of the bigram in its bucket and the word before, count
* two words as a context: sum, trigrams seen, once, twice (one byte each;
  contexts with larger sums apart); a context seen once is not stored, its
  bigram says that it was seen

Order 2 counts bigrams as they occur.  Order 3 counts trigrams so; a bigram's
count is then the number of different words before it, but bigrams of a row's
start, which has nothing before it, count as they occur.  A row's first word
has one word of context, the start, in either order.

p(w|gh) = max(c(ghw) - D3(c), 0) / c(gh) + g(gh) p(w|h),
p(w|h) = max(c(hw) - D(c), 0) / c(h) + g(h) p(w), with g the discounted mass, c(h) the sum of c(hw),
p(w) = max(a(w) - E(a), 0) / A + g / (V + 1), a the continuation counts; discounts
follow from counts of counts.  The V + 1 also counts one unknown word, so the
probabilities after any context add up to 1.

Defined cases: a null or empty text is the end token alone; a null id has no
remainder, so its row is learned from and not held out; repeated rows count
each time; without any training text every token has probability 1; other
columns are ignored.  Counts and all tables cover every training document.
"""

from __future__ import annotations

import os
import tempfile
import uuid

import numpy as np
import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalspark.llm.arrow_text import LOWER, Slice, mix64, row_sums, slices
from vitalspark.session import materialize, work_path

U = np.uint64
START, END = mix64(np.array([0x5EED0001, 0x5EED0002], U))
WINDOW = 1 << 22            # tokens that a task counts at once
SLICE = 4 << 20
ORDER = 3                   # of the query's model
NONE = (1 << 32) - 1        # before a row's start


# ---- files in the shared folder --------------------------------------------------------------------------------------

def _place(uri: str):
    if "://" not in uri:
        uri = uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


def write_array(folder: str, x: np.ndarray) -> str:
    """Write the array under a new name, so a repeated task never touches a file that is in use."""
    place, path = _place(folder)
    place.create_dir(path, recursive=True)
    name = uuid.uuid4().hex
    with place.open_output_stream(f"{path}/{name}") as out:
        out.write(np.ascontiguousarray(x).data if len(x) else b"")
    return f"{folder}/{name}"


def map_array(uri: str, kind) -> np.ndarray:
    """The array, mapped into memory; from a remote store it is copied first, to a file without a name."""
    place, path = _place(uri)
    if isinstance(place, fs.LocalFileSystem):
        return np.memmap(path, kind, "r") if os.path.getsize(path) else np.zeros(0, kind)
    with tempfile.TemporaryFile() as local, place.open_input_stream(path) as source:
        while part := source.read(1 << 22):
            local.write(part)
        local.flush()
        return np.memmap(local, kind, "r") if local.tell() else np.zeros(0, kind)


# ---- tokens ----------------------------------------------------------------------------------------------------------

def tokens(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words with an END after each row's, and the rows' offsets."""
    starts, ends, at = s.words()
    return np.insert(s.hashes(starts, ends), at[1:], END), at + np.arange(s.n + 1)


def contexts(x: np.ndarray, at: np.ndarray, start) -> np.ndarray:
    """What stands before each token."""
    out = np.empty_like(x)
    out[1:] = x[:-1]
    out[at[:-1]] = start
    return out


def pack(x: np.ndarray) -> bytes:
    """Whole numbers for the shuffle: differences where they ascend, byte by byte of all numbers (columns one after the
    other), compressed."""
    flat = np.ascontiguousarray(x.T).reshape(-1)
    rises = x.ndim == 1 and bool((flat[1:] >= flat[:-1]).all())
    if rises and len(flat):
        flat = np.diff(flat, prepend=flat[:1] * 0)
    return bytes([rises]) + zstandard.ZstdCompressor(level=3).compress(flat.view(np.uint8).reshape(-1, x.dtype.itemsize).T.tobytes())


def unpack(data: bytes, kind, width: int = 1) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), np.uint8)
    kind = np.dtype(kind)
    flat = np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).reshape(-1).view(kind)
    if data[0]:
        flat = np.cumsum(flat, dtype=kind)
    return flat.reshape(width, -1).T if width > 1 else flat


def _blobs(bucket: np.ndarray, *columns: np.ndarray) -> list:
    """(bucket, packed columns) for each bucket that occurs."""
    order = np.argsort(bucket, kind="stable")
    bucket, columns = bucket[order], [c[order] for c in columns]
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(bucket) else np.zeros(0, np.int64)
    ends = np.append(first[1:], len(bucket))
    return [pa.array(bucket[first].astype(np.int32))] + [
        pa.array([pack(c[a:b]) for a, b in zip(first, ends)], pa.binary()) for c in columns]


def _joined(column, kind, width: int = 1) -> np.ndarray:
    return np.concatenate([unpack(x.as_buffer().to_pybytes(), kind, width) for x in column])


def _summed(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(n, first) if len(first) else n


def _range(h: np.ndarray, parts: int) -> np.ndarray:
    return ((h >> U(32)) * U(parts)) >> U(32)


# ---- counting --------------------------------------------------------------------------------------------------------

def count_words(docs: DataFrame, folder: str, parts: int) -> list[tuple]:
    """(bucket, words, file of hashes, file of counts), sorted; hash ranges ascend with the bucket."""
    def local(batches):
        held, n = [], 0

        def out():
            key, count = np.unique(np.concatenate(held), return_counts=True)
            return pa.record_batch(_blobs(_range(key, parts), key, count.astype(np.int64)), names=["bucket", "keys", "counts"])

        for batch in batches:
            for s in slices(batch.column(0), LOWER):
                x, _ = tokens(s)
                held += [x, np.full(s.n, START)]
                n += len(x) + s.n
                if n > WINDOW:
                    yield out()
                    held, n = [], 0
        if held:
            yield out()

    def merge(group):
        key, n = _summed(_joined(group["keys"], U), _joined(group["counts"], np.int64))
        return pa.table({"bucket": group["bucket"][:1], "n": pa.array([len(key)], pa.int64()),
                         "hashes": [write_array(folder, key)], "counts": [write_array(folder, n)]})

    out = (docs.select("text").mapInArrow(local, "bucket int, keys binary, counts binary")
           .groupBy("bucket").applyInArrow(merge, "bucket int, n long, hashes string, counts string"))
    return sorted(tuple(r) for r in materialize(out, "kn-words").collect())     # one row a bucket


class Words:
    """Ids of word hashes: ranks over all buckets; unknown words get ``size``."""

    def __init__(self, files: list[tuple], parts: int):
        self.parts = parts
        self.files = {b: (n, hashes) for b, n, hashes, _ in files}
        self.base = np.zeros(parts + 1, np.int64)
        for b, (n, _) in self.files.items():
            self.base[b + 1] = n
        self.base = np.cumsum(self.base)
        self.size = int(self.base[-1])
        self.maps: dict[int, np.ndarray] = {}

    def ids(self, h: np.ndarray) -> np.ndarray:
        key, inverse = np.unique(h, return_inverse=True)
        out = np.full(len(key), self.size, np.int64)
        bucket = _range(key, self.parts).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]])) if len(key) else []
        for a, b in zip(first, np.append(first[1:], len(key)) if len(key) else []):
            where = int(bucket[a])
            if where not in self.files:
                continue
            if where not in self.maps:
                self.maps[where] = map_array(self.files[where][1], U)
            table = self.maps[where]
            at = np.minimum(np.searchsorted(table, key[a:b]), len(table) - 1)
            out[a:b] = np.where(table[at] == key[a:b], at + self.base[where], self.size)
        return out[inverse]

    def bucket(self, ids: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.base, ids, "right") - 1


def _pair_bucket(key: np.ndarray, hot: np.ndarray, parts: int) -> np.ndarray:
    context = key >> U(32)
    mixed = mix64(context)
    if len(hot):
        at = np.minimum(np.searchsorted(hot, context), len(hot) - 1)
        split = hot[at] == context
        mixed[split] = mix64(key[split])
    return _range(mixed, parts)


def _counted(pair: np.ndarray, before: np.ndarray, n: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each different (pair, before), sorted, with its sum of n; in order 2 ``before`` is 0."""
    by = np.lexsort((before, pair)) if order > 2 else np.argsort(pair, kind="stable")
    pair, before, n = pair[by], before[by], n[by]
    first = np.flatnonzero(np.concatenate([[True], (pair[1:] != pair[:-1]) | (before[1:] != before[:-1])])) if len(pair) else np.zeros(0, np.int64)
    return pair[first], before[first], np.add.reduceat(n, first) if len(first) else n


def _of_counts(n: np.ndarray) -> list[int]:
    return [int((n == k).sum()) for k in (1, 2, 3, 4)] + [len(n)]


def _write_counts(folder: str, key: np.ndarray, n: np.ndarray) -> list[str]:
    big = n >= 255
    return [write_array(folder, x) for x in (key, np.minimum(n, 255).astype(np.uint8), key[big], n[big])]


def _context_sums(context: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each different context: the sum of n, how many n, how many are 1, how many 2."""
    order = np.argsort(context, kind="stable")
    return _row_sums(context[order], np.stack([n, np.ones(len(n)), n == 1, n == 2], axis=1).astype(np.int64)[order])


def _row_sums(key: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the rows of each key, from sorted keys."""
    first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    return key[first], np.add.reduceat(rows, first, axis=0) if len(first) else rows


def _is_hot(word: np.ndarray, hot: np.ndarray) -> np.ndarray:
    return np.isin(word, hot) if len(hot) else np.zeros(len(word), bool)


def count_grams(docs: DataFrame, folder: str, parts: int, shared, order: int) -> tuple[list, list, list, dict]:
    """Files of n-grams (bucket, key file, count file, key file and count file of the large counts, of bigrams and in order 3 of
    trigrams), word files (bucket, continuation, seen, once, twice, sum), context files (bucket, keys, sums) and counts of counts
    (``pairs``, ``words``, ``triples``: how many occur 1, 2, 3, 4 times, and how many there are)."""
    def local(batches):
        words, hot = _opened(shared)
        held, n = [], 0

        def out():
            pair, before = (np.concatenate(x) for x in zip(*held))
            pair, before, count = _counted(pair, before, np.ones(len(pair), np.int64), order)
            return pa.record_batch(_blobs(_pair_bucket(pair, hot, parts), pair, before, count), names=["bucket", "keys", "before", "counts"])

        start = int(words.ids(np.array([START], U))[0])
        for batch in batches:
            for s in slices(batch.column(0), LOWER, SLICE):
                x, at = tokens(s)
                ids = words.ids(x)
                last = contexts(ids, at, start)
                before = contexts(last, at, NONE) if order > 2 else np.zeros(len(ids))
                held.append(((last.astype(U) << U(32)) | ids.astype(U), before.astype(np.uint32)))
                n += len(x)
                if n > WINDOW:
                    yield out()
                    held, n = [], 0
        if held:
            yield out()

    def merge(group):
        """Writes the bucket's n-grams; hands on, by buckets, what they say of words and contexts."""
        words, hot = _opened(shared)
        pair, before, n = _counted(_joined(group["keys"], U), _joined(group["before"], np.uint32), _joined(group["counts"], np.int64), order)
        stats, triples, said = [], [], []
        key, count = pair, n
        if order > 2:
            started = before == NONE
            key, count = _summed(pair, np.where(started, n, 1))
            place = np.searchsorted(key, pair).astype(U)
            pair, before, n, place = (x[~started] for x in (pair, before, n, place))
            triples = _write_counts(folder, (place << U(32)) | before.astype(U), n)
            context, sums = _context_sums((before.astype(U) << U(32)) | (pair >> U(32)), n)
            # the contexts of a word that is split stand in several buckets
            kept = (sums[:, 0] > 1) | _is_hot(context & U(0xFFFFFFFF), hot)
            context, sums = context[kept], sums[kept]
            bucket, id_blob, row_blob = _blobs(_range(mix64(context), parts), context, sums)
            none = pa.nulls(len(bucket), pa.binary())
            said.append(pa.record_batch([bucket, none, none, id_blob, row_blob, pa.nulls(len(bucket), pa.list_(pa.string())),
                                         pa.nulls(len(bucket), pa.list_(pa.int64()))], names=names))
        files = _write_counts(folder, key, count) + triples
        stats = _of_counts(count) + _of_counts(n if order > 2 else n[:0])
        word, preceded = _summed(key & U(0xFFFFFFFF), np.ones(len(key), np.int64))
        context, sums = _context_sums(key >> U(32), count)
        rows = np.zeros((len(word) + len(context), 5), np.int64)
        rows[:len(word), 0], rows[len(word):, 1:] = preceded, sums[:, [1, 2, 3, 0]]
        ids = np.concatenate([word, context]).astype(np.int64)
        bucket, id_blob, row_blob = _blobs(words.bucket(ids), ids, rows)
        none = pa.nulls(len(bucket), pa.binary())
        said.append(pa.record_batch([bucket, id_blob, row_blob, none, none, pa.nulls(len(bucket), pa.list_(pa.string())),
                                     pa.nulls(len(bucket), pa.list_(pa.int64()))], names=names))
        own = pa.record_batch([group["bucket"][:1].combine_chunks(), *[pa.nulls(1, pa.binary())] * 4, pa.array([files], pa.list_(pa.string())),
                               pa.array([stats], pa.list_(pa.int64()))], names=names)
        return pa.Table.from_batches([own, *said])

    def merge_said(group):
        words, _ = _opened(shared)
        here = group["bucket"][0].as_py()
        passed, rest, pairs = (group.filter(group[c].is_valid()) for c in ("files", "ids", "contexts"))
        out = [("pairs", here, f, s) for f, s in zip(passed["files"].to_pylist(), passed["stats"].to_pylist())]
        if len(rest):
            size = int(words.base[here + 1] - words.base[here])
            at = _joined(rest["ids"], np.int64) - words.base[here]
            rows = _joined(rest["rows"], np.int64, 5)
            total = np.stack([np.bincount(at, rows[:, k], size).astype(np.int64) for k in range(5)], axis=1)
            a = total[:, 0]
            kind = "u4" if total.max(initial=0) < 1 << 32 else "i8"
            out.append(("words", here, [*[write_array(folder, total[:, k].astype(kind)) for k in range(5)], kind], _of_counts(a[a > 0])))
        if len(pairs):
            key, rows = _joined(pairs["contexts"], U), _joined(pairs["sums"], np.int64, 4)
            by = np.argsort(key, kind="stable")
            key, rows = _row_sums(key[by], rows[by])
            key, rows = key[rows[:, 0] > 1], rows[rows[:, 0] > 1]
            big = rows[:, 0] >= 255     # the sum is the largest of a row
            out.append(("contexts", here, [write_array(folder, x) for x in (key, np.minimum(rows, 255).astype(np.uint8), key[big], rows[big])], []))
        cols = list(zip(*out))
        return pa.table([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.list_(pa.string())),
                         pa.array(cols[3], pa.list_(pa.int64()))], names=["kind", "bucket", "files", "stats"])

    names = ["bucket", "ids", "rows", "contexts", "sums", "files", "stats"]
    out = (docs.select("text").mapInArrow(local, "bucket int, keys binary, before binary, counts binary")
           .groupBy("bucket").applyInArrow(merge, "bucket int, ids binary, rows binary, contexts binary, sums binary, files array<string>, stats array<long>")
           .groupBy("bucket").applyInArrow(merge_said, "kind string, bucket int, files array<string>, stats array<long>"))
    rows = materialize(out, "kn-pairs").collect()      # three rows a bucket
    files = {k: sorted((r.bucket, *r.files) for r in rows if r.kind == k) for k in ("pairs", "words", "contexts")}
    stats = {k: np.sum([r.stats for r in rows if r.kind == k] or [[0] * 10], axis=0).tolist() for k in ("pairs", "words")}
    stats = {"pairs": stats["pairs"][:5], "triples": stats["pairs"][5:], "words": stats["words"][:5]}
    return files["pairs"], files["words"], files["contexts"], stats


_open: dict[str, tuple] = {}


def _opened(shared) -> tuple[Words, np.ndarray]:
    name, files, parts, hot = shared.value
    if name not in _open:
        _open.clear()
        _open[name] = (Words(files, parts), hot)
    return _open[name]


# ---- the model -------------------------------------------------------------------------------------------------------

def discounts(t: list[int]) -> np.ndarray:
    """Discounts of counts 0, 1, 2 and 3 or more, from how many n-grams occur 1, 2, 3 and 4 times."""
    if min(t[:3]) == 0:
        return np.array([0, 0.5, 0.75, 0.75])
    y = t[0] / (t[0] + 2 * t[1])
    d = [k - (k + 1) * y * t[k] / t[k - 1] for k in (1, 2, 3)]
    return np.array([0, *(min(max(x, 0.05), k - 0.05) for k, x in enumerate(d, 1))])


class Model:
    """What a worker needs to score: the mapped arrays and a few numbers."""

    def __init__(self, spec: dict):
        self.words = Words(spec["word_files"], spec["parts"])
        self.parts, self.hot, self.spec = spec["parts"], spec["hot"], spec
        self.order = spec["order"]
        self.pairs = {b: files for b, *files in spec["pair_files"]}
        self.contexts = {b: files for b, *files in spec["context_files"]}
        self.maps: dict = {}
        self.vocabulary = max(0, self.words.size - 1)         # the start token is no word
        self.tokens = spec["tokens"]
        self.d, self.e, self.f = (discounts(spec["stats"][k]) for k in ("pairs", "words", "triples"))
        self.types = spec["stats"]["pairs"][4]
        t = spec["stats"]["words"]
        held = self.e[1] * t[0] + self.e[2] * t[1] + self.e[3] * (t[4] - t[0] - t[1])
        self.unseen = (held / self.types if self.types else 1.0) / (self.vocabulary + 1)
        self.start = int(self.words.ids(np.array([START], U))[0])

    def _word_columns(self, ids: np.ndarray) -> np.ndarray:
        """count, continuation, seen, once, twice, sum of each id; zeros for unknown words."""
        out = np.zeros((len(ids), 6), np.int64)
        bucket = self.words.bucket(ids)
        for b in np.unique(bucket[ids < self.words.size]):
            if ("w", b) not in self.maps:
                count = next(c for k, _, _, c in self.spec["word_files"] if k == b)
                rest = next((files for k, *files in self.spec["word_stats"] if k == b), None)
                first = map_array(count, np.int64)
                self.maps["w", b] = [first] + ([map_array(f, rest[-1]) for f in rest[:-1]] if rest else [np.zeros(len(first), np.int64)] * 5)
            mine = np.flatnonzero((bucket == b) & (ids < self.words.size))
            at = ids[mine] - self.words.base[b]
            for k, column in enumerate(self.maps["w", b]):
                out[mine, k] = column[at]
        return out

    def _bucket_arrays(self, b: int) -> list[np.ndarray]:
        if b not in self.maps:
            self.maps[b] = [map_array(f, kind) for f, kind in zip(self.pairs[b], (U, np.uint8, U, np.int64) * 2)]
        return self.maps[b]

    @staticmethod
    def _by_bucket(bucket: np.ndarray):
        """(bucket, its rows) of each bucket."""
        order = np.argsort(bucket, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], bucket[order][1:] != bucket[order][:-1]])) if len(bucket) else np.zeros(0, np.int64)
        for a, z in zip(first, np.append(first[1:], len(bucket))):
            yield int(bucket[order[a]]), order[a:z]

    @staticmethod
    def _counts(key: np.ndarray, table, small, big_key, big) -> tuple[np.ndarray, np.ndarray]:
        """Places and counts of the keys; 0 for those not in the table."""
        if not len(table):
            return np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        at = np.minimum(np.searchsorted(table, key), len(table) - 1)
        n = np.where(table[at] == key, small[at], 0).astype(np.int64)
        large = np.flatnonzero(n == 255)
        n[large] = big[np.searchsorted(big_key, key[large])] if len(large) else n[large]
        return at, n

    def _pair_counts(self, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Buckets, places and counts of sorted, different keys."""
        bucket = _pair_bucket(key, self.hot, self.parts).astype(np.int64)
        at, n = np.zeros(len(key), np.int64), np.zeros(len(key), np.int64)
        for b, mine in self._by_bucket(bucket):
            if b in self.pairs:
                at[mine], n[mine] = self._counts(key[mine], *self._bucket_arrays(b)[:4])
        return bucket, at, n

    def _triple_counts(self, bucket: np.ndarray, at: np.ndarray, before: np.ndarray) -> np.ndarray:
        """Counts of the trigrams of bigrams at these places."""
        n = np.zeros(len(bucket), np.int64)
        for b, mine in self._by_bucket(bucket):
            n[mine] = self._counts((at[mine].astype(U) << U(32)) | before[mine].astype(U), *self._bucket_arrays(b)[4:])[1]
        return n

    def _context_sums(self, key: np.ndarray) -> np.ndarray:
        """sum, seen, once, twice of different contexts of two words that were seen."""
        out = np.tile(np.array([1, 1, 1, 0], np.int64), (len(key), 1))
        for b, mine in self._by_bucket(_range(mix64(key), self.parts).astype(np.int64)):
            if b not in self.contexts:
                continue
            if ("c", b) not in self.maps:
                self.maps["c", b] = [map_array(f, kind) for f, kind in zip(self.contexts[b], (U, np.uint8, U, np.int64))]
            table, small, big_key, big = self.maps["c", b]
            if len(table):
                place = np.minimum(np.searchsorted(table, key[mine]), len(table) - 1)
                hit = np.flatnonzero(table[place] == key[mine])
                rows = small.reshape(-1, 4)[place[hit]].astype(np.int64)
                large = np.flatnonzero(rows[:, 0] == 255)
                if len(large):
                    rows[large] = big.reshape(-1, 4)[np.searchsorted(big_key, key[mine[hit[large]]])]
                out[mine[hit]] = rows
        return out

    def score(self, s: Slice) -> dict[str, np.ndarray]:
        """n_tokens, n_known, base_score and score of each row."""
        x, at = tokens(s)
        ids = self.words.ids(x)
        different, inverse = np.unique(ids, return_inverse=True)
        about = self._word_columns(different)
        count, before = about[:, 0], about[:, 1]
        lower = (before - self.e[np.minimum(before, 3)]).clip(0) / self.types + self.unseen if self.types else np.full(len(before), self.unseen)
        base = np.log10((count + 1) / (self.tokens + self.vocabulary + 1))
        seen, once, twice, followed = about[:, 2], about[:, 3], about[:, 4], about[:, 5]
        with np.errstate(divide="ignore", invalid="ignore"):
            back = (self.d[1] * once + self.d[2] * twice + self.d[3] * (seen - once - twice)) / followed
        back = np.where(seen > 0, back, 1.0)
        # the row's start is a context like a word
        head = self._word_columns(np.array([self.start]))[0]
        starts = max(1, int(head[5]))
        head_back = (self.d[1] * head[3] + self.d[2] * head[4] + self.d[3] * (head[2] - head[3] - head[4])) / starts if head[2] else 1.0
        context = contexts(ids, at, self.start)
        first = np.zeros(len(ids), bool)
        first[at[:-1]] = True
        place = contexts(inverse, at, 0)
        total = np.where(first, starts, np.maximum(followed, 1)[place])
        weight = np.where(first, head_back, back[place])
        key, where = np.unique((context.astype(U) << U(32)) | ids.astype(U), return_inverse=True)
        bucket, found, n = self._pair_counts(key)
        n = n[where]
        p = (n - self.d[np.minimum(n, 3)]).clip(0) / total + weight * lower[inverse]
        if self.order > 2:
            before = contexts(context, at, NONE)
            # a context of two words was seen if the bigram that they are was
            own = np.flatnonzero(contexts(n > 0, at, False))
            both, which = np.unique((before[own].astype(U) << U(32)) | context[own].astype(U), return_inverse=True)
            total, seen, once, twice = self._context_sums(both).T
            weight = (self.f[1] * once + self.f[2] * twice + self.f[3] * (seen - once - twice)) / total
            count3 = np.zeros(len(own), np.int64)
            known = np.flatnonzero(n[own] > 0)
            triple, to = np.unique((where[own[known]].astype(U) << U(32)) | before[own[known]].astype(U), return_inverse=True)
            pair = (triple >> U(32)).astype(np.int64)
            count3[known] = self._triple_counts(bucket[pair], found[pair], triple & U(0xFFFFFFFF))[to]
            p[own] = (count3 - self.f[np.minimum(count3, 3)]).clip(0) / total[which] + weight[which] * p[own]
        return {"n_tokens": np.diff(at), "n_known": row_sums((count > 0)[inverse].astype(np.int64), at),
                "base_score": np.add.reduceat(base[inverse], at[:-1]), "score": np.add.reduceat(np.log10(p), at[:-1])}


def train(docs: DataFrame, order: int = 2) -> dict:
    """Count the texts of ``docs`` for a model of order 2 or 3; the model's description: file names (a few a bucket) and totals."""
    if order not in (2, 3):
        raise ValueError("the order is 2 or 3")
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = work_path(spark, "kn-arrays")
    word_files = count_words(docs, folder, parts)
    if sum(n for _, n, _, _ in word_files) >= NONE:
        raise ValueError("2^32 - 1 different words or more")
    words = Words(word_files, parts)
    # contexts that hold more than a bucket's share are split; there are fewer than 4 * parts of them
    rows = [(b, n, counts) for b, n, _, counts in word_files]
    if rows:
        def totals(batches):
            for batch in batches:
                for counts in batch.column(2).to_pylist():
                    yield pa.record_batch([pa.array([int(map_array(counts, np.int64).sum())])], names=["n"])

        tasks = spark.createDataFrame(rows, "bucket int, n long, counts string").repartition(min(len(rows), parts))
        total = int(tasks.mapInArrow(totals, "n long").agg(F.sum("n")).first()[0])
        least = max(1, total // (4 * parts))
        base = words.base

        def hot_words(batches):
            for batch in batches:
                for b, counts in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
                    n = map_array(counts, np.int64)
                    yield pa.record_batch([pa.array(np.flatnonzero(n > least) + base[b])], names=["id"])

        hot = np.sort(np.array([r.id for r in tasks.mapInArrow(hot_words, "id long").collect()], np.int64)).astype(U)
    else:
        total, hot = 0, np.zeros(0, U)
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, word_files, parts, hot))
    pair_files, word_stats, context_files, stats = count_grams(docs, folder, parts, shared, order)
    spec = {"name": uuid.uuid4().hex, "parts": parts, "word_files": word_files, "hot": hot, "order": order, "pair_files": pair_files,
            "word_stats": word_stats, "context_files": context_files, "stats": stats, "tokens": 0}
    if rows:
        model = Model(spec)
        spec["tokens"] = total - int(model._word_columns(np.array([model.start]))[0][0])     # starts are no tokens
    return spec


_models: dict[str, Model] = {}


def score(docs: DataFrame, spec: dict) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of each whole text (log10)."""
    shared = docs.sparkSession.sparkContext.broadcast(spec)

    def run(batches):
        spec = shared.value
        if spec["name"] not in _models:
            _models.clear()
            _models[spec["name"]] = Model(spec)
        model = _models[spec["name"]]
        for batch in batches:
            for s in slices(batch.column(1), LOWER, SLICE):
                r = model.score(s)
                yield pa.record_batch([batch.column(0).slice(s.first, s.n).cast(pa.int64()), pa.array(r["n_tokens"], pa.int64()),
                                       pa.array(r["n_known"], pa.int64()), pa.array(np.full(s.n, model.tokens), pa.int64()),
                                       pa.array(r["base_score"], pa.float64()), pa.array(r["score"], pa.float64())],
                                      names=["doc_id", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def held_out(column: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")) % 7 == 2, F.lit(False))


def op5_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = score(docs, train(docs.where(~held_out()), ORDER))
    return out.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")
