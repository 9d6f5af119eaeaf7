"""Periodic runs of words: the longest stretches of a text that repeat a period at least four times.

The words of a slice of documents are compressed into a run-length grammar by
recompression: block rounds replace each maximal block of one symbol by a
symbol of its own, pair rounds split the symbols into left and right ones and
replace every left one followed by a right one.  Equal stretches are parsed
alike but for their borders, so a comparison of two places climbs to symbols
that stand for long stretches and comes down where they differ: the grammar
tells how far two places agree, to the right or to the left, without a suffix
array.

A run of length >= 4p holds a point i of the grid 0, 2p, 4p, ... with i + 2p
still inside, so for all periods together n log n points are candidates.  Points
whose words differ from those p later (three words are looked at) can't be in a
run; for the others the grammar gives the exact ends.  A stretch found for
several periods has the smallest of them.

Defined cases: a null text has no words; a null doc_id is not edited; equal
rows are documents of their own; other columns are ignored; memory follows a
slice of texts or one longer text, candidates are taken CANDIDATES at a time.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vitalspark.llm.arrow_text import mix64, ragged, slices, span_ids

LEAST, TIMES = 6, 4         # a run has at least LEAST words and TIMES periods
CANDIDATES = 1 << 20
U = np.uint64


def _named(key: np.ndarray) -> tuple[np.ndarray, int]:
    names, sym = np.unique(key, return_inverse=True)
    return sym.astype(np.int64), len(names)


class Grammar:
    """A run-length grammar of a sequence whose first and last symbol occur nowhere else.

    The nodes of all levels stand in flat arrays: ``sym`` (equal on one level only for equal stretches), ``parent``,
    ``child`` (the first one), ``first`` and ``last`` (of their parent's children) and how many nodes of the same
    block follow (``right``) and come before (``left``), themselves included."""

    def __init__(self, sequence: np.ndarray):
        sym, used = _named(sequence)
        parts: dict[str, list] = {k: [] for k in ("sym", "parent", "child", "first", "last", "right", "left")}
        base, child, blocks, salt = 0, np.full(len(sym), -1), True, 1
        while True:
            n = len(sym)
            if used == n:       # nothing occurs twice: no two places agree on this level
                new = np.ones(n, bool)
                self._add(parts, sym, np.full(n, -1), child, new, np.ones(n, np.int64), np.ones(n, np.int64))
                break
            new = np.ones(n, bool)
            right = left = np.ones(n, np.int64)
            if blocks:
                new[1:] = sym[1:] != sym[:-1]
                start = np.flatnonzero(new)
                size = np.diff(np.append(start, n))
                place = np.arange(n) - np.repeat(start, size)
                left, right = place + 1, np.repeat(size, size) - place
                key = sym[start] << 32 | size
            else:
                side = (mix64(np.arange(used).astype(U) + U(salt * 0x9E3779B97F4A7C15 % (1 << 64))) & U(1)).astype(bool)[sym]
                lr, rl = ~side[:-1] & side[1:], side[:-1] & ~side[1:]
                new[1:] = ~(lr if lr.sum() >= rl.sum() else rl)
                start = np.flatnonzero(new)
                size = np.diff(np.append(start, n))
                key = (sym[start] + 1) << 32 | np.where(size == 2, sym[np.minimum(start + 1, n - 1)] + 1, 0)
                salt += 1
            self._add(parts, sym, base + n + np.cumsum(new) - 1, child, new, right, left)
            child = base + start
            base += n
            sym, used = _named(key)
            blocks = not blocks
        for k, v in parts.items():
            setattr(self, k, np.concatenate(v))

    @staticmethod
    def _add(parts, sym, parent, child, new, right, left):
        small = np.int32 if len(sym) < 1 << 26 else np.int64
        for k, v in (("sym", sym), ("parent", parent), ("child", child), ("right", right), ("left", left)):
            parts[k].append(v.astype(small))
        parts["first"].append(new)
        parts["last"].append(np.append(new[1:], True))

    def extend(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """How many symbols agree from places a and b on (a included), to the right or to the left."""
        edge, block = (self.first, self.right) if forward else (self.last, self.left)
        way = 1 if forward else -1
        a, b, origin = a.astype(np.int64), b.astype(np.int64), a
        out = np.zeros(len(a), np.int64)
        at, climbing = np.arange(len(a)), np.ones(len(a), bool)
        while len(at):
            same = self.sym[a] == self.sym[b]
            up_a, up_b = self.parent[a], self.parent[b]
            both = same & edge[a] & edge[b] & (up_a >= 0)
            climb = climbing & both & (self.sym[up_a] == self.sym[up_b])
            climbing &= same & ~(both & ~climb)
            step = np.where(same & ~climb, way * np.minimum(block[a], block[b]), 0)
            down = ~same
            low_a, low_b = (self.child[a], self.child[b]) if forward else (self._last_child(a), self._last_child(b))
            done = down & (self.child[a] < 0)
            out[at[done]] = np.abs(a[done] - origin[at[done]])
            a = np.where(climb, up_a, np.where(down, low_a, a + step))
            b = np.where(climb, up_b, np.where(down, low_b, b + step))
            if done.any():
                go = ~done
                a, b, at, climbing = a[go], b[go], at[go], climbing[go]
        return out

    def _last_child(self, node: np.ndarray) -> np.ndarray:
        """The node before the next node's first child; the last node of a level has the rest of the level below."""
        following = np.minimum(node + 1, len(self.child) - 1)
        child = self.child[node]
        size = np.where((self.child[following] > child) & (following > node), self.child[following] - child, 1)
        # the following node stands a level higher where ``node`` is its level's last, which occurs once and is never met
        return child + size - 1


def edited_words(doc_id, n: int) -> tuple[int, int] | None:
    """Where a document's words begin to repeat and with what period, or None."""
    if doc_id is None or not n:
        return None
    h = zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    return a, 1 + (n - a) // (3 + g % 8)


def find_runs(words: np.ndarray, at: np.ndarray, candidates: int = CANDIDATES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end (places in ``words``) and period of all runs of the rows words[at[i]:at[i + 1]], by row, start, period."""
    n = np.diff(at)
    most = np.where(n >= LEAST, n // TIMES, 0)
    row = np.repeat(np.arange(len(n)), most)
    period = ragged(np.arange(1, int(most.max(initial=0)) + 1), np.zeros(len(n), np.int64), most)
    found = []
    points = n[row] // (2 * period)
    total = np.concatenate([[0], np.cumsum(points)])
    grammar = where = None
    covered: dict[str, np.ndarray] = {}
    lo = 0
    while lo < len(row):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + candidates, "right")) - 1)
        p = np.repeat(period[lo:hi], points[lo:hi])
        k = np.arange(len(p)) - np.repeat(total[lo:hi] - total[lo], points[lo:hi])
        i = np.repeat(at[row[lo:hi]], points[lo:hi]) + 2 * p * k
        keep = words[i] == words[i + p]
        i, p = i[keep], p[keep]
        keep = (words[i + p - 1] == words[i + 2 * p - 1]) & (words[i + p // 2] == words[i + p // 2 + p])
        i, p = i[keep], p[keep]
        if covered:         # the points of a run that is known, for a multiple of its period, give that run again
            again = (covered["end"][i] >= i + 2 * p) & (p % covered["period"][i] == 0)
            i, p = i[~again], p[~again]
        if len(i):
            if grammar is None:
                grammar, where = _grammar_of(words, at)
            a = where[i]
            end = i + p + grammar.extend(a, a + p, True)
            start = i - grammar.extend(a - 1, a + p - 1, False)
            ok = end - start >= np.maximum(LEAST, TIMES * p)
            found.append(_smallest(start[ok], end[ok], p[ok]))
            if hi < len(row):
                if not covered:
                    covered = {"end": np.zeros(len(words), np.int64), "period": np.ones(len(words), np.int64)}
                for s, e, q in sorted(zip(*map(np.ndarray.tolist, found[-1])), key=lambda r: r[1]):
                    covered["end"][s:e], covered["period"][s:e] = e, q
        lo = hi
    if not found:
        return (np.zeros(0, np.int64),) * 3
    start, end, p = _smallest(*(np.concatenate([f[k] for f in found]) for k in range(3)))
    order = np.lexsort((p, start))
    return start[order], end[order], p[order]


def _smallest(start, end, period):
    order = np.lexsort((period, end, start))
    start, end, period = start[order], end[order], period[order]
    new = np.ones(len(start), bool)
    new[1:] = (start[1:] != start[:-1]) | (end[1:] != end[:-1])
    return start[new], end[new], period[new]


def _grammar_of(words: np.ndarray, at: np.ndarray) -> tuple[Grammar, np.ndarray]:
    """The grammar of all rows with a symbol of its own before, between and after them, and each word's place in it."""
    n = np.diff(at)
    place = np.arange(len(words)) + 1 + np.repeat(np.arange(len(n)), n)
    sequence = np.empty(len(words) + len(n) + 1, np.int64)
    own = np.ones(len(sequence), bool)
    own[place] = False
    sequence[place] = words
    sequence[own] = int(words.max(initial=0)) + 1 + np.arange(len(n) + 1)
    return Grammar(sequence), place


def periodic_runs(docs: DataFrame, edit: bool = False) -> DataFrame:
    """doc_id, n_runs, the strongest run (start, length, period, exponent_milli), runs_sha256 and collapsed_sha256 of
    every whole text; with ``edit`` of the text in which every tenth document repeats itself (``edited_words``)."""
    return _map(docs, edit, False)


def run_table(docs: DataFrame) -> DataFrame:
    """doc_id, runs (array of start, length, period, by start) and collapsed: the text's words without those that only
    repeat a run's first period, joined by spaces."""
    return _map(docs, False, True)


DIGESTS = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
TABLE = "doc_id long, runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _map(docs: DataFrame, edit: bool, full: bool) -> DataFrame:
    def run(batches):
        for batch in batches:
            for s in slices(batch.column(1)):
                yield _slice(s, batch.column(0).slice(s.first, s.n).cast(pa.int64()), edit, full)

    return docs.select("doc_id", "text").mapInArrow(run, TABLE if full else DIGESTS)


def _slice(s, ids: pa.Array, edit: bool, full: bool) -> pa.RecordBatch:
    starts, ends, at = s.words()
    word = np.arange(len(starts))
    if edit:
        for i, doc in enumerate(ids.to_pylist()):
            a, b = int(at[i]), int(at[i + 1])
            change = edited_words(doc, b - a)
            if change:
                word[a + change[0]:b] = a + change[0] + np.arange(b - a - change[0]) % change[1]
    words, _ = span_ids(s.buf, starts, ends)
    words = words[word]
    first, last, period = find_runs(words, at)
    # words of a run after its first period are dropped
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, first + period, 1)
    np.add.at(depth, last, -1)
    kept = np.cumsum(depth[:-1]) == 0
    source = word[kept]
    size = ends[source] - starts[source] + 1
    s.buf[ends] = 32                            # each word comes with the space after it
    text = ragged(s.buf, starts[source], size).tobytes()
    cut = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(kept)])[at]].tolist()
    collapsed = [text[a:max(a, b - 1)] for a, b in zip(cut, cut[1:])]
    run_at = np.searchsorted(first, at).tolist()
    row = np.searchsorted(at, first, "right") - 1
    begin = (first - at[row]).tolist()
    length, period = (last - first).tolist(), period.tolist()
    runs = [list(zip(begin[a:b], length[a:b], period[a:b])) for a, b in zip(run_at, run_at[1:])]
    if full:
        table = [[{"start": b, "length": n, "period": p} for b, n, p in r] for r in runs]
        kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
        return pa.record_batch([ids, pa.array(table, kind), pa.array(collapsed, pa.binary()).cast(pa.string())], names=["doc_id", "runs", "collapsed"])
    best = [strongest(r) for r in runs]
    columns = [pa.array([b[k] if b else None for b in best], pa.int64()) for k in range(3)]
    milli = pa.array([1000 * b[1] // b[2] if b else None for b in best], pa.int64())
    sha = [hashlib.sha256("".join(f"{b},{n},{p}\n" for b, n, p in r).encode()).hexdigest() for r in runs]
    return pa.record_batch([ids, pa.array([len(r) for r in runs], pa.int64()), *columns, milli, pa.array(sha, pa.string()),
                            pa.array([hashlib.sha256(t).hexdigest() for t in collapsed], pa.string())],
                           names=["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"])


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period; of equal ones the first, then the one with the smallest period."""
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2] or (r[1] * best[2] == best[1] * r[2] and (r[0], r[2]) < (best[0], best[2])):
            best = r
    return best


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs(spark.read.parquet(f"{sf_dir}/documents.parquet"), edit=True)
