"""Document fingerprints: Merkle trees over sections, paragraphs and short runs of words.

A paragraph is a line, a section ends after a blank line or after a paragraph
that its own hash picks (one in 8), and a paragraph's leaves end after words
that their hash picks (one in 4) and, inside words of more than LONG_WORD bytes
(text without spaces), at characters that the WINDOW bytes before them pick (one
in CHARACTERS), so all borders depend on the text around them alone and an edit
leaves the others in place.  Only a leaf that would still hold more than
LONGEST bytes is cut by length.  A leaf holds every byte up to the next one.  A node's hash is that of its children's in order; the root is a
128-bit digest of the sections', so equal roots mean equal texts, and where two
trees differ only the differing branches need to be followed down.

A fingerprint is one string: root, then per section ``/hash``, per paragraph
``,hash.`` and its leaves' hashes, 8 hex digits each.  ``likeness`` is the share
of leaves (as a multiset) that two fingerprints have in common, of the longer
one's.

Defined cases: a null text is empty; the empty text's tree has no leaf, it is
wholly like another empty one and unlike all others; rows of one doc_id stand
in order of a hash of their text; null ids come after all others; a lone
document is its own next; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalspark.llm.arrow_text import Slice, mix64, ragged, slices

LEAF_WORDS = 4
SECTION_PARAGRAPHS = 8
LONG_WORD, WINDOW, CHARACTERS = 64, 24, 16
LONGEST = 512
U = np.uint64
_B = U(0x9E3779B97F4A7C15)


def _parents(child: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Hashes of runs of children that begin at ``first``: of their values and places in the run."""
    size = np.diff(np.append(first, len(child)))
    place = np.arange(len(child)) - np.repeat(first, size)
    value = mix64(child + (place.astype(U) + U(1)) * _B)
    return mix64(np.add.reduceat(value, first) + size.astype(U)) if len(first) else np.zeros(0, U)


def _inner_cuts(s: Slice, starts: np.ndarray, ends: np.ndarray, cumulative: np.ndarray) -> np.ndarray:
    """Places in long words where a leaf begins: characters that the bytes before them pick."""
    long = ends - starts > LONG_WORD
    at = ragged(np.arange(len(s.buf)), starts[long] + WINDOW, ends[long] - starts[long] - WINDOW)
    at = at[(s.buf[at] & 0xC0) != 0x80]
    return at[s.hashes(at - WINDOW, at, cumulative) % U(CHARACTERS) == 0] if len(at) else at


def _bounded(s: Slice, leaf: np.ndarray) -> np.ndarray:
    """The leaves' starts with more of them where a leaf has more than LONGEST bytes, at characters."""
    if not len(leaf):
        return leaf
    size = np.minimum(np.append(leaf[1:], 1 << 62), s.ends[np.searchsorted(s.starts, leaf, "right") - 1]) - leaf
    more = np.maximum(0, (size - 1) // LONGEST)
    if not more.any():
        return leaf
    place = np.arange(int(more.sum())) - np.repeat(np.cumsum(more) - more, more) + 1
    cut = np.repeat(leaf, more) + place * LONGEST
    for _ in range(3):
        cut = np.where((s.buf[cut] & 0xC0) == 0x80, cut - 1, cut)
    return np.union1d(leaf, cut)


class Trees:
    """The trees of a slice's rows: flat hashes by level, and where each node's children begin."""

    def __init__(self, s: Slice):
        self.n = s.n
        cumulative = s.cumulative()
        starts, ends, at = s.words()
        chosen = (s.hashes(starts, ends, cumulative) & U(LEAF_WORDS - 1)) == 0
        # a leaf begins with a row, after each line break, and with the word after a chosen one
        row_first = s.starts[s.ends > s.starts]
        line_first = np.flatnonzero(s.buf == 10) + 1
        line_first = line_first[~np.isin(line_first, s.ends)]
        after = np.flatnonzero(chosen[:-1]) + 1 if len(chosen) else np.zeros(0, np.int64)
        after = after[~np.isin(after, at[:-1])]
        para = np.union1d(row_first, line_first)
        leaf = np.union1d(para, np.concatenate([starts[after], _inner_cuts(s, starts, ends, cumulative)]))
        leaf = _bounded(s, leaf)
        row = np.searchsorted(s.starts, leaf, "right") - 1
        # rows without text share their place with none: an empty row's start is its own separator
        end = np.minimum(np.append(leaf[1:], 1 << 62), s.ends[row]) if len(leaf) else leaf
        self.leaf = s.hashes(leaf, end, cumulative) if len(leaf) else np.zeros(0, U)
        self.leaf_at = np.append(np.searchsorted(row, np.arange(s.n)), len(leaf))
        self.para_first = np.searchsorted(leaf, para)
        self.para = _parents(self.leaf, self.para_first)
        para_row = row[self.para_first] if len(leaf) else np.zeros(0, np.int64)
        blank = (s.buf[para] == 10) if len(para) else np.zeros(0, bool)
        closes = blank | (self.para % U(SECTION_PARAGRAPHS) == 0)
        new = np.ones(len(para), bool)
        new[1:] = closes[:-1] | (para_row[1:] != para_row[:-1])
        self.section_first = np.flatnonzero(new)
        self.section = _parents(self.para, self.section_first)
        section_row = para_row[self.section_first]
        self.section_at = np.append(np.searchsorted(section_row, np.arange(s.n)), len(self.section))
        self.para_end = np.append(self.section_first[1:], len(para))
        self.leaf_end = np.append(self.para_first[1:], len(leaf))
        self.short = (self.leaf >> U(32)).astype(np.uint32)

    def strings(self) -> list[str]:
        leaf = self.short.astype(">u4").tobytes().hex()
        para = (self.para >> U(32)).astype(">u4").tobytes().hex()
        section = (self.section >> U(32)).astype(">u4").tobytes().hex()
        para = [f",{para[8 * i:8 * i + 8]}.{leaf[8 * a:8 * b]}" for i, (a, b) in enumerate(zip(self.para_first.tolist(), self.leaf_end.tolist()))]
        section = [f"/{section[8 * i:8 * i + 8]}{''.join(para[a:b])}" for i, (a, b) in enumerate(zip(self.section_first.tolist(), self.para_end.tolist()))]
        return [hashlib.blake2b(self.section[a:b].tobytes(), digest_size=16).hexdigest() + "".join(section[a:b])
                for a, b in zip(self.section_at[:-1].tolist(), self.section_at[1:].tolist())]

    def leaves(self, i: int) -> np.ndarray:
        return self.short[self.leaf_at[i]:self.leaf_at[i + 1]]


def likenesses(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Share of common leaves of each pair a[i], b[i]."""
    n = np.array([[len(x), len(y)] for x, y in zip(a, b)]).reshape(-1, 2)
    key = np.concatenate([np.repeat(np.arange(len(a)), n[:, k]).astype(U) << U(32) | np.concatenate([*side, np.zeros(0, np.uint32)]).astype(U)
                          for k, side in enumerate((a, b))])
    node, inverse = np.unique(key, return_inverse=True)
    cut = int(n[:, 0].sum())
    both = np.minimum(np.bincount(inverse[:cut], minlength=len(node)), np.bincount(inverse[cut:], minlength=len(node)))
    shared = np.bincount((node >> U(32)).astype(np.int64), both, len(a))
    most = n.max(axis=1, initial=0)
    return np.where(most > 0, shared / np.maximum(most, 1), 1.0)


# ---- fingerprints as strings -------------------------------------------------------------------------------------------

def parse(fingerprint: str) -> list[tuple[str, list[tuple[str, list[str]]]]]:
    """Sections as (hash, paragraphs), paragraphs as (hash, leaf hashes)."""
    out = []
    for section in fingerprint.split("/")[1:]:
        head, *paragraphs = section.split(",")
        out.append((head, [(p[:8], [p[i:i + 8] for i in range(9, len(p), 8)]) for p in paragraphs]))
    return out


def likeness(a: str, b: str) -> float:
    """Share of common leaves of two fingerprints."""
    if a[:32] == b[:32]:
        return 1.0
    x, y = (Counter(leaf for _, ps in parse(f) for _, leaves in ps for leaf in leaves) for f in (a, b))
    most = max(x.total(), y.total())
    return (x & y).total() / most if most else 1.0


def changed_paragraphs(a: str, b: str) -> tuple[list[int], list[int]]:
    """Numbers of the paragraphs of each text that the other doesn't have, found by following only sections that differ."""
    if a[:32] == b[:32]:
        return [], []
    trees = [parse(a), parse(b)]
    out = []
    for own, other in (trees, trees[::-1]):
        sections = Counter(h for h, _ in other)
        open_, n = [], 0
        for h, paragraphs in own:
            if sections[h] > 0:
                sections[h] -= 1
            else:
                open_ += [(n + i, p) for i, (p, _) in enumerate(paragraphs)]
            n += len(paragraphs)
        left = Counter(h for h, _ in own)
        theirs: Counter = Counter()
        for h, paragraphs in other:
            if left[h] > 0:
                left[h] -= 1
            else:
                theirs.update(p for p, _ in paragraphs)
        mine = []
        for i, p in open_:
            if theirs[p] > 0:
                theirs[p] -= 1
            else:
                mine.append(i)
        out.append(mine)
    return out[0], out[1]


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id and fingerprint of every whole text; no shuffle."""
    def run(batches):
        for batch in batches:
            for s in slices(batch.column(1)):
                yield pa.record_batch([batch.column(0).slice(s.first, s.n).cast(pa.int64()), pa.array(Trees(s).strings(), pa.string())],
                                      names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, fingerprint string")


# ---- each document beside the next ---------------------------------------------------------------------------------------

def with_next(docs: DataFrame) -> DataFrame:
    """(part, tail, doc_id, text) in partitions sorted so that each row's next document follows it in the same part.

    Documents are dealt out by ranges of doc_id; the first of each range also goes to the end of the range before it
    (``tail``).  Only the ranges' borders come to the driver, two numbers a partition."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = docs.agg(F.percentile_approx("doc_id", [i / parts for i in range(1, parts)] or [0.5], max(10_000, 10 * parts))).first()[0] or []
    cuts = np.unique(np.array(cuts, np.int64))

    @F.pandas_udf("int")
    def part_of(doc_id: pd.Series) -> pd.Series:
        known = doc_id.notna()
        out = np.searchsorted(cuts, doc_id.fillna(0).to_numpy().astype(np.int64), "right") + 1
        return pd.Series(np.where(known, out, 0).astype(np.int32))

    keyed = docs.select("doc_id", "text").withColumn("part", part_of(F.col("doc_id")))
    heads = {r.part: r.head for r in docs.select("doc_id").withColumn("part", part_of(F.col("doc_id"))).groupBy("part")
             .agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads, reverse=True)
    before = {part: order[i - 1] for i, part in enumerate(order)}       # the first range follows the last one
    heads_table = spark.createDataFrame([(p, h, before[p]) for p, h in heads.items()], "h_part int, h_doc long, h_before int")
    head = F.broadcast(heads_table)      # a row a partition
    marked = keyed.join(head, (F.col("part") == F.col("h_part")) & F.col("doc_id").eqNullSafe(F.col("h_doc")), "left")
    places = F.array(F.struct(F.col("part"), F.lit(0).alias("tail")), F.struct(F.col("h_before").alias("part"), F.lit(1).alias("tail")))
    dealt = marked.select("doc_id", "text", F.explode(places).alias("p")).where("p.part IS NOT NULL")
    return (dealt.select("p.part", "p.tail", "doc_id", "text", F.xxhash64("text").alias("tie"))
            .repartition(parts, "part").sortWithinPartitions("part", "tail", F.col("doc_id").desc_nulls_last(), "tie")
            .select("part", "tail", "doc_id", "text"))


def edited(text: bytes, following: bytes) -> tuple[int, bytes]:
    """Code points of the text, and the text with its last third (rounded down) replaced by as many of the next one's."""
    lead = np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)
    n = len(lead)
    k = n // 3
    if not k:
        return n, text
    other = np.flatnonzero((np.frombuffer(following[:4 * k + 4], np.uint8) & 0xC0) != 0x80)
    end = int(other[k]) if len(other) > k else len(following)
    return n, text[:lead[n - k]] + following[:end]


def compare_with_next(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def out(rows: list[tuple]):
        """rows: (part, tail, doc_id, text), each but the last with its next one behind it."""
        own = [i for i in range(len(rows) - 1) if not rows[i][1] and rows[i + 1][0] == rows[i][0]]
        texts = [r[3] for r in rows]
        trees, place = [], []
        changed = [edited(texts[i], texts[i + 1]) for i in own]
        column = pa.array(texts + [t for _, t in changed], pa.binary()).view(pa.string())
        for s in slices(column):
            t = Trees(s)
            trees += t.strings()
            place += [t.leaves(i) for i in range(s.n)]
        new = range(len(texts), len(texts) + len(own))
        return pa.record_batch([
            pa.array([rows[i][2] for i in own], pa.int64()), pa.array([n for n, _ in changed], pa.int64()),
            pa.array([hashlib.sha256(t).hexdigest() for _, t in changed], pa.string()),
            pa.array([trees[i] for i in own], pa.string()), pa.array([trees[i] for i in new], pa.string()),
            pa.array(likenesses([place[i] for i in own], [place[i] for i in new]), pa.float64()),
            pa.array(likenesses([place[i] for i in own], [place[i + 1] for i in own]), pa.float64())], names=names)

    def run(batches):
        rows, held = [], 0
        for batch in batches:
            text = batch.column(3).fill_null("")
            for part, tail, doc, t in zip(*(batch.column(k).to_pylist() for k in range(3)), (x.as_buffer().to_pybytes() for x in text)):
                rows.append((part, tail, doc, t))
                held += len(t)
                if held > 2 << 20 and len(rows) > 1:
                    yield out(rows)
                    rows, held = rows[-1:], len(t)
        if len(rows) > 1:
            yield out(rows)

    return with_next(docs).mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
                                           "near_edited double, near_next double")


def op1_merkle_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compare_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
