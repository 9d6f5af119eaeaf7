"""N-gram Jaccard self-join by universe partition and pigeonhole, verified exactly.

A document's set is its distinct word shingles (hashed to 64 bits).  Two sets
with a Jaccard similarity of at least 3/4 differ in at most min(|r|, |s|) / 3
shingles (their symmetric difference).  That drives the candidate search:

* Size bands.  Bands double; a set also visits the band below if a partner may
  be there.  So each pair that can link meets in some band.
* Universe partition.  Within a band every shingle belongs to one of m segments
  by its hash.  A set's part in a segment is one signature.  One differing
  shingle spoils one segment, so of a set with N non-empty segments at least
  N - H signatures stand in its partner, H = size / 3.
* Cost-based allocation.  Signatures have one global order: those made of
  shingles that many sets share last (by the rarest of them, counted over the
  whole corpus), among the others segments with more shingles first.  By the prefix lemma linked sets share one of the
  first H + 1 signatures of each, so only these are indexed.  A set with fewer
  than H + 1 non-empty segments (hash accident) indexes all, and is dealt out
  again by another hash, for partners in the same situation.
* One-deletion neighbourhoods.  For H = 1 (three to five shingles) one segment
  with all one-deletion variants is cheaper than two segments of its halves:
  the set and the set without each one of its shingles are indexed.

Sets that share a signature form a group.  Its smallest member is paired with
each other one, pairs are verified, links joined to components; then members of
different components of one group are compared, by sizes and parity bitmaps (the
bits in which two bitmaps differ bound the difference from below), then exactly.
Where there are many such pairs, in families of near copies, a forest of the
likeliest links within random blocks goes first, a few times over: no more pairs
than members, which join most of them, so few are left for the comparison of all.
Groups whose members all link need no more than the first step.
That is enough for components; all links come from comparing all pairs of a
group, dealt into blocks, pairs of blocks being Spark groups of their own.

Equal sets are one class before all that.  Counts of shingles only set the order
in which signatures are chosen; any order gives the same links.

Defined cases: a null or empty text, or one of white space, has an empty set
and links with nothing; with fewer words than a shingle the word sequence is
the one shingle; equal sets link; a repeated doc_id is one document whose rows
share a component if their sets do (its smallest row's set otherwise counts as
another document with that id); null ids form one id; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitalspark.llm.arrow_text import LOWER, Slice, by_bytes, mix64, slices, trimmed
from vitalspark.llm.components import components
from vitalspark.session import materialize

WORDS = 5
SHARED_FROM = 4             # a shingle that so many sets (as counted) have is shared
SHARED_KEPT = 1 << 20       # at most so many of the most shared shingles are told apart by the order
COUNT_WINDOW = 1 << 20      # shingles a task counts at once
FLUSH = 1 << 18             # index entries a task holds before it hands them on
LEAST_BITS = 512            # of a parity bitmap; it has at least two bits a shingle
BLOCK = 1024                # members of a group that are compared with those of another block
LISTED = 16                 # groups of each member by which pairs that meet in several groups are told
FEW = 256                   # pairs of different components for each member of a family that are tried at once
FORESTS = 4                 # rounds at most in which a family with more of them is joined by forests first
TILE = 256                  # documents of a block that are verified against those of another
FILTER_BITS = 1 << 25       # of the filter for the texts to verify
FIRST_BAND = 6
SLICE = 1 << 19             # bytes of text at once
U = np.uint64
_STEP = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], U)


def shingles(s: Slice, k: int = WORDS) -> list[np.ndarray]:
    """The sorted set of shingle hashes of each row."""
    starts, ends, at = s.words()
    w = s.hashes(starts, ends)
    m = max(0, len(w) - k + 1)
    h = np.zeros(m, U)
    for j in range(k):
        h += mix64(w[j:j + m] + U(j)) * _STEP[j % 5]
    h = mix64(h)
    out = []
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= k:
            x = np.sort(h[a:b - k + 1])
            out.append(x[np.concatenate([[True], x[1:] != x[:-1]])])
        elif b > a:
            out.append(_sequence(w[a:b]))
        else:
            out.append(np.zeros(0, U))
    return out


def _sequence(w: np.ndarray) -> np.ndarray:
    x = np.full(1, len(w), U)
    for v in w:
        x = mix64(x * _STEP[1] + v)
    return x


def bands(n: int) -> list[tuple[int, int, int]]:
    """(band, segments, H) of each band that a set of n shingles visits; band -1 is the one-deletion band."""
    out = []
    if 3 <= n <= FIRST_BAND:
        out.append((-1, 1, 1))
    if n >= FIRST_BAND:
        j = (n // FIRST_BAND).bit_length() - 1
        for b in (j, j - 1):
            low = FIRST_BAND << b if b >= 0 else 0
            if b >= 0 and 3 * n <= 4 * (2 * low - 1):      # else too long for any partner in that band
                out.append((b, low + low // 10 + 1, min(n, 2 * low - 1) // 3))
    return out


Shared = tuple[np.ndarray, np.ndarray]      # sorted shingle hashes and their ranks
NOTHING_SHARED: Shared = (np.zeros(0, U), np.zeros(0, U))


def signatures(sets: list[np.ndarray], shared: Shared = NOTHING_SHARED, seed: int = 0, only=None) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each band, over all sets that visit it: (row, key, need) of every non-empty segment, with need = H + 1 of the
    row.  A key names the signature (56 bits) and orders it: those of shared shingles last, then larger segments first.
    ``only`` gives the bands of each set in place of ``bands``."""
    out = []
    groups: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for r, x in enumerate(sets):
        for band, m, h in bands(len(x)) if only is None else only[r]:
            groups.setdefault((band, m), []).append((r, h))
    for (band, m), members in groups.items():
        rows = np.array([r for r, _ in members])
        tokens = np.concatenate([sets[r] for r in rows])
        size = np.array([len(sets[r]) for r in rows])
        row = np.repeat(np.arange(len(rows)), size)
        need = np.array([h + 1 for _, h in members])
        value = mix64(tokens + U(seed + 1) * _STEP[2:3])
        salt = U((band + 2) * 64 + seed) * _STEP[3:4]
        if band < 0:
            total = np.add.reduceat(value, np.cumsum(size) - size)
            whole = mix64(total + salt + size.astype(U))
            without = mix64(total[row] - value + salt + (size[row] - 1).astype(U))
            r = np.concatenate([np.arange(len(rows)), row])
            out.append((rows[r], np.concatenate([whole, without]) >> U(8), np.full(len(r), 1 << 30)))
            continue
        rank = np.zeros(len(tokens), U)
        if len(shared[0]):
            at = np.minimum(np.searchsorted(shared[0], tokens), len(shared[0]) - 1)
            rank = np.where(shared[0][at] == tokens, shared[1][at], U(0))
        place = tokens
        if seed:
            place = mix64(tokens ^ (U(seed) * _STEP[4:5]))
            order = np.lexsort((place, row))
            place, value, rank = place[order], value[order], rank[order]
        segment = ((place >> U(32)) * U(m)) >> U(32)      # grows with the hash, so a segment's shingles are neighbours
        first = np.flatnonzero(np.concatenate([[True], (segment[1:] != segment[:-1]) | (row[1:] != row[:-1])]))
        count = np.diff(np.append(first, len(segment)))
        sig = mix64(np.add.reduceat(value, first) + salt + segment[first] * _STEP[0] + count.astype(U) * _STEP[1])
        least = np.minimum.reduceat(rank, first)
        key = (np.where(least > 0, least + U(15), (15 - np.minimum(count, 15)).astype(U)) << U(56)) | (sig >> U(8))
        r = row[first]
        out.append((rows[r], key, need[r]))
        short = np.flatnonzero(np.bincount(r, minlength=len(rows)) < need)
        if len(short) and seed < 16:
            kept = [[(band, m, int(need[i]) - 1)] for i in short]
            out += [(rows[short][a], b, c) for a, b, c in signatures([sets[rows[i]] for i in short], shared, seed + 1, kept)]
    return out


def parity_bitmaps(sets: list[np.ndarray]) -> list[bytes]:
    """A bitmap of each set in which every shingle flips one bit, with a power of two of bits, at least two a
    shingle.  The bits in which two differ (the longer folded onto the shorter) are no more than the sets' difference."""
    n = np.array([len(x) for x in sets])
    bits = np.maximum(LEAST_BITS, 1 << np.ceil(np.log2(np.maximum(2 * n, 1))).astype(np.int64))
    start = np.cumsum(bits) - bits
    at = np.repeat(start, n) + (np.concatenate([*sets, np.zeros(0, U)]) & (np.repeat(bits, n) - 1).astype(U)).astype(np.int64)
    packed = np.packbits((np.bincount(at, minlength=int(bits.sum())) & 1).astype(np.uint8), bitorder="little").tobytes()
    return [packed[a // 8:(a + b) // 8] for a, b in zip(start.tolist(), bits.tolist())]


def fold(matrix: np.ndarray, words: int) -> np.ndarray:
    """Bitmaps (rows of 64-bit words) folded to so many words."""
    while matrix.shape[1] > words:
        half = matrix.shape[1] // 2
        matrix = matrix[:, :half] ^ matrix[:, half:]
    return matrix


def may_link(a: np.ndarray, na: int, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Whether sizes and bitmaps allow a similarity of 3/4 of set a with each of b: the difference is at most 1/7 of the
    sizes' sum."""
    return np.isfinite(apart(a, na, b, nb))


def apart(a: np.ndarray, na: int, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """The bits in which the bitmap of set a and each of b differ, as a share of the sizes' sum; infinite where they can't
    link."""
    words = min(a.shape[-1], b.shape[1])
    away = np.bitwise_count(fold(b, words) ^ fold(a.reshape(1, -1), words)).sum(axis=1)
    return np.where((7 * away <= na + nb) & (4 * np.minimum(na, nb) >= 3 * np.maximum(na, nb)), away / (na + nb), np.inf)


class _Seen:
    """The first row of each set of a task."""

    def __init__(self):
        self.digests: set[bytes] = set()

    def new(self, digest: bytes) -> bool:
        if digest in self.digests:
            return False
        self.digests.add(digest)
        return True


def _digest(x: np.ndarray) -> bytes:
    return hashlib.blake2b(x.tobytes(), digest_size=16).digest()


def profiles(docs: DataFrame, k: int = WORDS) -> DataFrame:
    """One row a document: doc_id, n, digest, bits; and rows with n = -1 that hold shingles found more than once by a
    task among different sets, with their counts (tokens, counts: packed)."""
    def run(batches):
        seen, held, n_held = _Seen(), [], 0

        def counted():
            x = np.concatenate(held)
            held.clear()
            x.sort()
            again = x[1:] == x[:-1]
            if len(x) > 2:
                again[1:] &= x[2:] != x[:-2]      # the second of each run
            token = x[1:][again]
            n = np.searchsorted(x, token, "right") - np.searchsorted(x, token, "left")
            return pa.record_batch([pa.array([None], pa.int64()), pa.array([-1], pa.int32()), pa.array([None], pa.binary()),
                                    pa.array([None], pa.binary()), pa.array([token.tobytes()], pa.binary()),
                                    pa.array([n.astype(np.int64).tobytes()], pa.binary())], names=names)

        for batch in batches:
            for s in slices(batch.column(1), LOWER, SLICE):
                sets = shingles(s, k)
                digests = [_digest(x) if len(x) else None for x in sets]
                none = pa.nulls(s.n, pa.binary())
                yield pa.record_batch([batch.column(0).slice(s.first, s.n).cast(pa.int64()), pa.array([len(x) for x in sets], pa.int32()),
                                       pa.array(digests, pa.binary()), pa.array(parity_bitmaps(sets), pa.binary()), none, none], names=names)
                fresh = [x for x, d in zip(sets, digests) if d and seen.new(d)]
                held += fresh
                n_held += sum(map(len, fresh))
                if n_held > COUNT_WINDOW:
                    yield counted()
                    n_held = 0
        if held:
            yield counted()

    names = ["doc_id", "n", "digest", "bits", "tokens", "counts"]
    return by_bytes(docs.select("doc_id", "text")).mapInArrow(trimmed(run), "doc_id long, n int, digest binary, bits binary, tokens binary, counts binary")


def shared_shingles(profile: DataFrame, most: int = SHARED_KEPT) -> Shared:
    """The shingles that the most sets share, sorted, and their ranks; at most ``most``."""
    def unpack(batches):
        for batch in batches:
            for token, n in zip(batch.column(0), batch.column(1)):
                yield pa.record_batch([pa.array(np.frombuffer(token.as_buffer(), np.int64)), pa.array(np.frombuffer(n.as_buffer(), np.int64))],
                                      names=["token", "n"])

    counts = materialize(profile.where("n = -1").select("tokens", "counts").mapInArrow(unpack, "token long, n long")
                         .groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= SHARED_FROM)
                         .withColumn("rank", (F.floor(F.log2("n") * 4)).cast("int")), "shared-shingles")
    room, least = most, None
    for rank, n in sorted((tuple(r) for r in counts.groupBy("rank").count().collect()), reverse=True):     # at most 256 ranks
        if n > room:
            break
        room, least = room - n, rank
    if least is None:
        return NOTHING_SHARED
    got = counts.where(F.col("rank") >= least).select("token", "rank").toPandas()
    token = got["token"].to_numpy(np.int64).view(U)
    order = np.argsort(token)
    return token[order], np.clip(got["rank"].to_numpy(np.int64)[order], 1, 239).astype(U)


def groups(docs: DataFrame, shared: Shared, k: int = WORDS) -> DataFrame:
    """members: the sorted doc_ids of each list of two or more different documents that share an indexed signature."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 2 * parts
    table = spark.sparkContext.broadcast(shared)      # size: SHARED_KEPT shingles at most

    def index(batches):
        seen, keys, ids, held = _Seen(), [], [], 0

        def flush():
            key, doc = np.concatenate(keys), np.concatenate(ids)
            bucket = ((key & U(0xFFFFFFFF)) * U(buckets)) >> U(32)
            order = np.argsort(bucket, kind="stable")
            key, doc, bucket = key[order], doc[order], bucket[order]
            first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
            ends = np.append(first[1:], len(key))
            return pa.record_batch([pa.array(bucket[first].astype(np.int32)),
                                    pa.array([key[a:b].tobytes() for a, b in zip(first, ends)], pa.binary()),
                                    pa.array([doc[a:b].tobytes() for a, b in zip(first, ends)], pa.binary())], names=["bucket", "keys", "docs"])

        for batch in batches:
            for s in slices(batch.column(1), LOWER, SLICE):
                doc = batch.column(0).slice(s.first, s.n).cast(pa.int64()).fill_null(NULL_ID).to_numpy()
                sets = shingles(s, k)
                fresh = [i for i, x in enumerate(sets) if len(x) > 2 and seen.new(_digest(x))]
                doc = doc[fresh]
                for row, key, need in signatures([sets[i] for i in fresh], table.value):
                    order = np.argsort(row, kind="stable")
                    row, key, need = row[order], key[order], need[order]
                    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(row)]):
                        n = int(need[a])
                        x = key[a:b] if n >= b - a else np.partition(key[a:b], n - 1)[:n]
                        keys.append(x)
                        ids.append(np.full(len(x), doc[row[a]], np.int64))
                        held += len(x)
                if held > FLUSH:
                    yield flush()
                    keys, ids, held = [], [], 0
        if keys:
            yield flush()

    def collide(batches):
        keys, docs = [], []
        for batch in batches:
            keys += [np.frombuffer(x.as_buffer(), U) for x in batch.column(1)]
            docs += [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column(2)]
        if not keys:
            return
        key, doc = np.concatenate(keys), np.concatenate(docs)
        del keys, docs
        order = np.argsort(key, kind="stable")
        key, doc = key[order], doc[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.append(first, len(key)))
        two = first[size == 2]
        pairs = np.unique(np.sort(np.stack([doc[two], doc[two + 1]], axis=1), axis=1), axis=0)
        pairs = pairs[pairs[:, 0] != pairs[:, 1]]
        if len(pairs):
            yield pa.record_batch([pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(pairs) + 1, 2, dtype=np.int32)), pa.array(pairs.ravel()))], names=["members"])
        lists = {np.unique(doc[a:a + n]).tobytes() for a, n in zip(first[size > 2].tolist(), size[size > 2].tolist())}
        done = [np.frombuffer(x, np.int64) for x in lists if len(x) > 8]
        for i in range(0, len(done), 1000):
            part = done[i:i + 1000]
            at = np.cumsum([0] + [len(x) for x in part]).astype(np.int32)
            yield pa.record_batch([pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(part)))], names=["members"])

    return (by_bytes(docs.select("doc_id", "text")).mapInArrow(trimmed(index), "bucket int, keys binary, docs binary")
            .repartition(parts, "bucket").mapInArrow(trimmed(collide), "members array<long>"))


NULL_ID = -(1 << 63)


def _filter_places(ids: np.ndarray) -> np.ndarray:
    """Four bits of the filter for each id."""
    return np.stack([(mix64(ids.view(U) + U(j + 1) * _STEP[:1]) % U(FILTER_BITS)).astype(np.int64) for j in range(4)])


def id_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size over the column ``id``: bytes with eight bits each."""
    def words(batches):
        for batch in batches:
            at = _filter_places(batch.column(0).to_numpy().astype(np.int64)).ravel()
            yield pa.record_batch([pa.array(at >> 6), pa.array(np.int64(1) << (at & 63))], names=["word", "bits"])

    got = ids.mapInArrow(words, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()   # FILTER_BITS / 64 rows at most
    out = np.zeros(FILTER_BITS // 64, np.int64)
    out[got["word"].to_numpy(np.int64)] = got["bits"].to_numpy(np.int64)
    return out.view(np.uint8)


def verify(pairs: DataFrame, docs: DataFrame, k: int = WORDS) -> DataFrame:
    """The pairs (a, b) whose sets have 100 * intersection >= 75 * union, from the texts; the pairs are written, different
    and a < b.  A filter keeps the texts of other documents out of the shuffle."""
    spark = docs.sparkSession
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    shared = spark.sparkContext.broadcast(id_filter(ids))      # size: FILTER_BITS

    def chosen(batches):
        bits = shared.value
        for batch in batches:
            at = _filter_places(batch.column(0).to_numpy().astype(np.int64))
            yield batch.filter(pa.array(((bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=0)))

    texts = materialize(docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), "text").where("text IS NOT NULL")
                        .mapInArrow(trimmed(chosen), "id long, text string"), "set-texts")
    # documents with the same smallest partner stand in few blocks, so a tile (two blocks) holds many pairs and each text
    # goes to few tiles
    near = (pairs.select(F.explode(F.array("a", "b")).alias("node"), "a").groupBy("node").agg(F.min("a").alias("component")))
    blocks = (near.join(near.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / TILE).alias("blocks")), "component")
              .select("node", F.xxhash64("component", F.pmod(F.xxhash64("node"), F.col("blocks"))).alias("block")))
    tiled = pairs.select("a", "b")
    for side in ("a", "b"):
        tiled = tiled.join(blocks.select(F.col("node").alias(side), F.col("block").alias(f"{side}_block")), side)
    tiled = materialize(tiled.select(F.xxhash64("a_block", "b_block").alias("tile"), "a", "b"), "set-tiles")
    held = tiled.select("tile", F.explode(F.array("a", "b")).alias("id")).distinct().join(texts, "id").select(F.col("tile").alias("of"), "id", "text")

    def test(pair, text):
        sets = {}
        ids = text["id"].combine_chunks()
        for s in slices(text["text"], LOWER):
            for i, x in enumerate(shingles(s, k)):
                sets.setdefault(ids[s.first + i].as_py(), []).append(x)
        keep = [any(_similar(x, y) for x in sets.get(a, ()) for y in sets.get(b, ()))
                for a, b in zip(pair["a"].to_pylist(), pair["b"].to_pylist())]
        return pair.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return tiled.groupBy("tile").cogroup(held.groupBy("of")).applyInArrow(test, "a long, b long").distinct()


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    """100 * intersection >= 75 * union, of sorted sets."""
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return 100 * both >= 75 * (len(x) + len(y) - both)


def pass_bitmaps(pairs: DataFrame) -> DataFrame:
    """The pairs (a, b, a_n, b_n, a_bits, b_bits) that may link."""
    def run(batches):
        for batch in batches:
            a, b, na, nb = (batch.column(i).to_numpy() for i in range(4))
            keep = [may_link(np.frombuffer(x.as_buffer(), U), int(na[i]), np.frombuffer(y.as_buffer(), U).reshape(1, -1), nb[i:i + 1].astype(np.int64))[0]
                    for i, (x, y) in enumerate(zip(batch.column(4), batch.column(5)))]
            yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.select("a", "b", "a_n", "b_n", "a_bits", "b_bits").mapInArrow(run, "a long, b long")


def across(members: DataFrame) -> DataFrame:
    """(a, b) of members (gid, id, n, bits, component, block, of, listed) of one group, in different components and blocks,
    that may link.  A pair that meets in several groups is left to the least of them where both members list that one
    or another one before this (``of``), so a family of near copies hands on its pairs about once, not once a group."""
    def run(group):
        order = np.argsort(group["n"].to_numpy(), kind="stable")
        group = group.take(pa.array(order)).combine_chunks()
        ids, comp, n = group["id"].to_numpy(), group["component"].to_numpy(), group["n"].to_numpy().astype(np.int64)
        block = group["block"].to_numpy()
        bits = [np.frombuffer(x.as_buffer(), U) for x in group["bits"]]
        width = np.array([len(x) for x in bits])      # grows with n
        earlier = _earlier(group["listed"].combine_chunks(), group["of"][0].as_py())
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for w in np.unique(width):
            own = np.flatnonzero(width == w)
            # partners are at most a third longer, so their bitmaps are as long or twice as long
            mine = np.stack([bits[i] for i in own])
            next_ = np.flatnonzero(width == 2 * w)
            reach = np.concatenate([own, next_])
            table = np.concatenate([mine, fold(np.stack([bits[i] for i in next_]), w)]) if len(next_) else mine
            last = np.searchsorted(n[reach], 4 * n[own] // 3, "right")
            for i in range(len(own)):
                if last[i] <= i + 1:
                    continue
                j = np.arange(i + 1, last[i])
                j = j[(comp[reach[j]] != comp[own[i]]) & (block[reach[j]] != block[own[i]])]
                if len(j):
                    away = np.bitwise_count(table[j] ^ mine[i]).sum(axis=1)
                    j = reach[j[7 * away <= n[own[i]] + n[reach[j]]]]
                    j = j[~(earlier[j] & earlier[own[i]]).any(axis=1)]
                    a.append(np.minimum(ids[j], ids[own[i]]))
                    b.append(np.maximum(ids[j], ids[own[i]]))
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return members.groupBy("gid").applyInArrow(run, "a long, b long")


def _earlier(listed: pa.Array, of: int) -> np.ndarray:
    """A bitmap of each list: the groups before ``of`` that stand in two lists or more."""
    group, size = listed.flatten().to_numpy(), listed.value_lengths().to_numpy()
    row = np.repeat(np.arange(len(size)), size)[group < of]
    _, at, count = np.unique(group[group < of], return_inverse=True, return_counts=True)
    place = np.cumsum(count > 1) - 1
    row, at = row[count[at] > 1], place[at[count[at] > 1]]
    out = np.zeros((len(size), -(-int((count > 1).sum()) // 8)), np.uint8)
    np.bitwise_or.at(out, (row, at >> 3), (1 << (at & 7)).astype(np.uint8))
    return out


def in_blocks(members: DataFrame) -> DataFrame:
    """Members (gid, id, n, bits, component) dealt into blocks by a hash, as groups for ``across``: one for each pair of
    blocks, in which members of different blocks are compared, and one for each block, in which all are.  So a task
    compares two blocks, however large the group is.  Each member lists the least LISTED groups that it is in (rows of
    one id that differ, each its own), so its rows don't grow with their number."""
    sizes = members.groupBy("gid").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    lists = members.groupBy("id", "n", "bits").agg(F.slice(F.sort_array(F.collect_set("gid")), 1, LISTED).alias("listed"))
    dealt = members.join(lists, ["id", "n", "bits"]).join(sizes, "gid").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return dealt.select(F.xxhash64("gid", F.least("block", "other"), F.greatest("block", "other")).alias("gid"), "id", "n", "bits", "component",
                        F.when(F.col("block") == F.col("other"), F.col("id")).otherwise(F.col("block")).alias("block"),
                        F.col("gid").alias("of"), "listed")


def forests(members: DataFrame, turn: int) -> DataFrame:
    """(a, b) of members (gid, id, n, bits, component) that may link: in each block of a group a forest of least distances
    by the bitmaps that joins the components as far as they reach each other.  A member stands in one of its groups and
    in one block of that, both drawn anew each turn, so there are no more pairs than members and a block bounds a task."""
    def run(group):
        group = group.take(pa.array(np.argsort(pc.binary_length(group["bits"]).to_numpy(), kind="stable"))).combine_chunks()
        ids, comp, n = group["id"].to_numpy(), group["component"].to_numpy(), group["n"].to_numpy().astype(np.int64)
        bits = [np.frombuffer(x.as_buffer(), U) for x in group["bits"]]
        width = np.array([len(x) for x in bits])
        spans = [(w, *np.searchsorted(width, [w, w + 1])) for w in np.unique(width)]
        tables = {w: np.stack(bits[x:y]) for w, x, y in spans}
        least, via, left = np.full(len(ids), np.inf), np.full(len(ids), -1), np.ones(len(ids), bool)
        a, b = [], []
        while left.any():
            rest = np.flatnonzero(left)
            i = rest[np.argmin(least[rest])]
            if via[i] >= 0:
                a.append(min(ids[i], ids[via[i]]))
                b.append(max(ids[i], ids[via[i]]))
            own = rest[comp[rest] == comp[i]]
            left[own] = False
            for j in own:
                for w, x, y in spans:
                    if w <= 2 * width[j] <= 4 * w:      # others are too long or too short
                        away = apart(bits[j], n[j], tables[w], n[x:y])
                        nearer = np.flatnonzero(away < least[x:y]) + x
                        least[nearer], via[nearer] = away[nearer - x], j
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    drawn = materialize(members.groupBy("id", "n", "bits", "component").agg(F.min(F.xxhash64("gid", F.lit(turn))).alias("gid")), "set-drawn")
    sizes = drawn.groupBy("gid").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    dealt = drawn.join(sizes, "gid").withColumn("gid", F.xxhash64("gid", F.pmod(F.xxhash64("id", F.lit(turn)), "blocks")))
    return dealt.select("gid", "id", "n", "bits", "component").groupBy("gid").applyInArrow(run, "a long, b long").distinct()


def jaccard_join(docs: DataFrame, k: int = WORDS, complete: bool = True) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, links, classes): doc_id, n_shingles, component_id of every document; the links between
    different sets (a < b: class ids, smallest doc_id of equal sets); doc_id and class_id.

    All links if ``complete``.  Otherwise those that only repeat a component (both ends joined by other links of one
    group) may be absent; documents and classes are the same."""
    profile = materialize(profiles(docs, k), "set-profiles")
    shared = shared_shingles(profile)
    rows = profile.where("n >= 0").select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("id"), "n", "digest", "bits")
    # written, so that the join with a digest of very many rows can be split
    firsts = materialize(rows.where("n > 0").groupBy("digest").agg(F.min("id").alias("class_id"), F.count(F.lit(1)).alias("rows"))
                         .where("rows > 1").select("digest", "class_id"), "set-copies")
    # empty sets are classes of their own and stay out of the join
    of_sets = rows.where("n > 0").join(firsts, "digest", "left").select("id", "n", "bits", F.coalesce("class_id", "id").alias("class_id"))
    classes = materialize(of_sets.unionByName(rows.where("n = 0").select("id", "n", "bits", F.col("id").alias("class_id"))), "set-classes")
    members = classes.select("id", "n", "bits", "class_id").where("n > 2")
    found = materialize(groups(docs, shared, k).distinct(), "set-groups")

    def described(pairs: DataFrame) -> DataFrame:
        """Pairs of classes, once each, that may link."""
        for side in ("a", "b"):
            own = members.select(F.col("id").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in ("n", "class_id", "bits")])
            pairs = pairs.join(own, side)
        pairs = pairs.where((F.col("a_class_id") != F.col("b_class_id")) & (4 * F.least("a_n", "b_n") >= 3 * F.greatest("a_n", "b_n")))
        pairs = pairs.drop("a", "b").withColumnsRenamed({"a_class_id": "a", "b_class_id": "b"})
        return pass_bitmaps(pairs).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()

    large = found.where(F.size("members") > 2).select(F.xxhash64("members").alias("gid"), F.explode("members").alias("id"))
    if complete:
        two = found.where(F.size("members") == 2).select(F.element_at("members", 1).alias("a"), F.element_at("members", 2).alias("b"))
        placed = materialize(large.join(members, "id").select("gid", F.col("class_id").alias("id"), "n", "bits", F.col("class_id").alias("component"))
                             .distinct(), "set-members")
        tried = materialize(described(two).unionByName(across(in_blocks(placed))).distinct(), "set-pairs")
        links = materialize(verify(tried, docs, k), "set-links")
    else:
        star = found.select(F.element_at("members", 1).alias("a"), F.explode(F.slice("members", 2, F.size("members"))).alias("b")).distinct()
        tried = materialize(described(star), "set-pairs")
        links = materialize(verify(tried, docs, k), "set-links")
        known, few = links, False
        for turn in range(FORESTS + 1):
            # two rounds tell apart what is worth comparing, forests have longer chains; the components of all links come last
            near = materialize(components(known, rounds=None if turn else 2, ready=True), "set-components")
            placed = materialize(large.join(members, "id").join(near, F.col("class_id") == F.col("node"), "left")
                                 .select("gid", F.col("class_id").alias("id"), "n", "bits", F.coalesce("component", "class_id").alias("component"))
                                 .distinct(), "set-placed")
            parts = placed.groupBy("gid", "component").agg(F.count(F.lit(1)).alias("c")).groupBy("gid")
            mixed = materialize(parts.agg(F.sum("c").alias("size"), F.sum(F.col("c") * F.col("c")).alias("within"), F.count(F.lit(1)).alias("parts"))
                                .where("parts > 1"), "set-mixed")
            pairs = (F.col("size") * F.col("size") - F.col("within")) / 2      # of different components
            # many pairs are left in large groups: families of near copies
            families = mixed.where(pairs > FEW * F.col("size")).select("gid")
            if turn == FORESTS or few or families.isEmpty():
                break
            more = materialize(forests(placed.join(families, "gid"), turn).join(tried, ["a", "b"], "left_anti"), "set-forests")
            new = materialize(verify(more, docs, k), "set-links")
            tried = tried.unionByName(more)
            if new.isEmpty():
                break       # the components, and so what is left to compare, stay as they are
            links = links.unionByName(new)
            few = 2 * new.count() < more.count()       # what is left to join is mostly like enough by its bitmaps alone
            known = links.unionByName(near.where("component < node").select(F.col("component").alias("a"), F.col("node").alias("b")))
        more = materialize(across(in_blocks(placed.join(mixed.select("gid"), "gid"))).distinct().join(tried, ["a", "b"], "left_anti"), "set-across")
        if not more.isEmpty():
            links = links.unionByName(materialize(verify(more, docs, k), "set-links"))
    # what is known of the components shortens the chains
    known = links if complete else links.unionByName(near.where("component < node").select(F.col("component").alias("a"), F.col("node").alias("b")))
    linked = materialize(components(known, ready=True), "set-components")
    out = (classes.join(linked, F.col("class_id") == F.col("node"), "left")
           .select(_id("id").alias("doc_id"), F.col("n").cast("long").alias("n_shingles"), _id(F.coalesce("component", "class_id")).alias("component_id")))
    return out, links, classes.select(_id("id").alias("doc_id"), _id("class_id").alias("class_id"))


def _id(column):
    column = F.col(column) if isinstance(column, str) else column
    return F.when(column != NULL_ID, column)


def op9_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(spark.read.parquet(f"{sf_dir}/documents.parquet"), complete=False)[0]


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [array_to_string(words, ' ')]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 75 * (x.n + y.n - common)),
reach AS (SELECT doc_id, doc_id AS r FROM w UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)"""
