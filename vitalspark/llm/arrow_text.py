"""Whole texts of an Arrow string column as flat numpy arrays: slices, words, pieces and their hashes.

A slice holds consecutive rows of at most SLICE_BYTES bytes of text, or one
longer row, so the memory of a task follows the slice and the longest single
text, not the batch.  Nulls are empty texts.
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

SLICE_BYTES = 2 << 20
LONG = 64       # bytes; a polynomial modulo 2^64 is safe for shorter spans only (see ``Slice.hashes``)

U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    x = (x ^ (x >> U(33))) * U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> U(33))) * U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U(33))


_BYTE_VALUE = mix64(np.arange(1, 257, dtype=U) * U(0x2545F4914F6CDD1D))
_powers: dict[str, np.ndarray] = {}


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, SLICE_BYTES + (SLICE_BYTES >> 2))
        have = np.full(size, base, U)
        have[0] = 1
        _powers[name] = have = np.cumprod(have, dtype=U)
    return have[:n]


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def by_bytes(texts: DataFrame, limit: str = "4m") -> DataFrame:
    """``texts``, whose batches go to Python with so many bytes at most, or one longer row, whatever the number of rows.
    A setting of the session; one that is there already stays."""
    conf = texts.sparkSession.conf
    if BATCH_BYTES not in conf.getAll:
        conf.set(BATCH_BYTES, limit)
    return texts


kept: list = []     # what tasks of this worker keep for later ones: objects with forget()


def trim(forget: bool = True) -> None:
    """Give memory back that tasks of this worker have left: freed blocks, and what they keep for later tasks."""
    if forget:
        _powers.clear()
        for x in kept:
            x.forget()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass        # another C library


def trimmed(run):
    """``run`` (batches to batches) with memory given back before and after."""
    def wrapped(batches):
        trim()
        yield from run(batches)
        trim()
    return wrapped


class Slice:
    """Rows [first, first + n) of a batch as one byte buffer with a space before, between and after them."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray, fold: np.ndarray):
        self.first, self.n = first, len(offsets) - 1
        lengths = np.diff(offsets)
        self.starts = offsets[:-1] - offsets[0] + np.arange(self.n) + 1
        self.ends = self.starts + lengths
        total = int(offsets[-1] - offsets[0]) + self.n + 1
        text = np.ones(total, bool)
        text[0] = False
        text[self.ends] = False
        self.buf = np.full(total, 32, np.uint8)
        self.buf[text] = fold[data[offsets[0]:offsets[-1]]]

    def cumulative(self) -> np.ndarray:
        return np.cumsum(_BYTE_VALUE[self.buf] * _power("base", _BASE, len(self.buf)), dtype=U)

    def hashes(self, starts: np.ndarray, ends: np.ndarray, cumulative: np.ndarray | None = None) -> np.ndarray:
        """64-bit hashes of byte spans: equal bytes give equal hashes, wherever they stand.  starts > 0.

        A polynomial modulo 2^64 loses a bit or more with each doubling of a Thue-Morse word, so two such words of 1,024
        letters share it whatever its base: spans over LONG bytes get a digest instead."""
        c = self.cumulative() if cumulative is None else cumulative
        h = (c[ends - 1] - c[starts - 1]) * _power("inverse", _INVERSE, len(self.buf))[starts]
        h = mix64(h + (ends - starts).astype(U) * U(0xD6E8FEB86659FD93))
        for i in np.flatnonzero(ends - starts > LONG).tolist():
            h[i] = int.from_bytes(hashlib.blake2b(self.buf[starts[i]:ends[i]], digest_size=8).digest(), "little")
        return h

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words (runs without white space), and where each row's words begin in them."""
        space = IS_SPACE[self.buf]
        edge = np.flatnonzero(space[1:] != space[:-1]) + 1
        starts, ends = edge[0::2], edge[1::2]
        return starts, ends, np.append(np.searchsorted(starts, self.starts), len(starts))

    def text(self, i: int) -> bytes:
        return self.buf[self.starts[i]:self.ends[i]].tobytes()


def slices(column: pa.Array, fold: np.ndarray = SAME, max_bytes: int = SLICE_BYTES) -> Iterator[Slice]:
    """fold: what each byte is replaced by (LOWER lower-cases A-Z)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("") if column.null_count else column
    n = len(column)
    if not n:
        return
    _, offs, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(offs, kind)[column.offset:column.offset + n + 1].astype(np.int64)
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + max_bytes, "right")) - 1)
        yield Slice(first, bytes_, offsets[first:last + 1], fold)
        first = last


def ragged(pool: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """pool[starts[i] : starts[i] + lengths[i]] of all i, one after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return pool[np.repeat(starts - (ends - lengths), lengths) + np.arange(total)]


def spans(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The byte spans as an Arrow array of binaries."""
    size = ends - starts
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(at), pa.py_buffer(ragged(buf, starts, size))])


def span_ids(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """A number for each span, the same for equal bytes and no others, and the different spans in order of their numbers."""
    coded = spans(buf, starts, ends).dictionary_encode()
    return coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary


def row_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of values[offsets[i]:offsets[i + 1]]."""
    c = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return c[offsets[1:]] - c[offsets[:-1]]


# What decides where texts can be cut, as bits of each byte.
_OTHER_SPACE, _MAYBE_SPACE, _HIGH, _LETTER, _PUNCT = 1, 2, 4, 8, 16
_CLASS = np.zeros(256, np.uint8)
_CLASS[[9, 10, 11, 12, 13]] |= _OTHER_SPACE
# ASCII white space and separators, and first bytes of Unicode white space: no piece may begin after them
_CLASS[[32, 9, 10, 11, 12, 13, 28, 29, 30, 31, 0xC2, 0xE1, 0xE2, 0xE3]] |= _MAYBE_SPACE
_CLASS[128:] |= _HIGH
_CLASS[65:91] |= _LETTER
_CLASS[97:123] |= _LETTER
for _a, _b in ((33, 48), (58, 65), (91, 97), (123, 127)):
    _CLASS[_a:_b] |= _PUNCT


ENCODE_BYTES = 2 * SLICE_BYTES      # of the slices that are encoded: more text has relatively fewer different pieces


class PieceEncoder:
    """Token ids of whole texts by a byte-level tokenizer of the tokenizers library that splits with the pattern
    ``'s|...| ?letters| ?numbers| ?others|white space`` and encodes each match separately.

    A match never runs on over (a) a space followed by a character that isn't
    white space, (b) a single other ASCII white space followed by such a
    character, (c) an ASCII letter followed by ASCII punctuation, (d) either end
    of an added token's string.  Texts are cut there and each different piece
    (compared by its bytes) is encoded once; its ids are kept while all that is
    kept has at most KEEP_BYTES.  The ids are those of the whole text.  Short
    pieces that begin at a cut (a) are handed over as one text, which costs the
    library less than a list."""

    KEEP_BYTES = 96 << 20   # unless told otherwise
    ENTRY = 200             # bytes, about, that a kept piece takes besides its own and its ids'
    AT_ONCE = 1 << 14

    def __init__(self, tokenizer, keep_bytes: int = KEEP_BYTES):
        self.tokenizer, self.keep_bytes = tokenizer, keep_bytes
        added = tokenizer.get_added_tokens_decoder() if not tokenizer.encode_special_tokens else {}
        if any(t.lstrip or t.rstrip or t.single_word for t in added.values()):
            raise ValueError("added tokens that take in or look at the text around them")
        self.added = [t.content.encode() for t in added.values()]
        # an added token with a space could come about where two pieces meet
        self.joins = tokenizer.normalizer is None and not any(b" " in token for token in self.added)
        # each character of a byte-level token stands for a byte
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        self.length = np.zeros(max(vocabulary.values()) + 1, np.int64)
        for token, i in vocabulary.items():
            self.length[i] = len(token.encode()) if i in added else len(token)
        self.forget()
        kept.append(self)

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.at = np.zeros(0, np.int64)      # place of each known piece's ids in the pool
        self.count = np.zeros(0, np.int64)
        self.used = np.zeros(0, np.int32)    # slices that had the piece
        self.pool = np.zeros(0, np.int32)
        self.kept = 0

    def _shrink(self) -> None:
        """Keep the pieces that several slices had, if they leave room for others."""
        keep = np.flatnonzero(self.used > 1)
        if len(keep) * 2 > len(self.known):
            return self.forget()
        spelled = list(self.known)           # in order of their places
        self.pool = ragged(self.pool, self.at[keep], self.count[keep])
        self.count = self.count[keep]
        self.at = np.cumsum(self.count) - self.count
        self.used = np.ones(len(keep), np.int32)
        self.known = {spelled[k]: i for i, k in enumerate(keep.tolist())}
        self.kept = len(self.known) * self.ENTRY + 4 * len(self.pool)

    def encode(self, s: Slice) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the slice's rows and where each row's begin (n + 1 offsets)."""
        first = self._cuts(s)
        starts = np.flatnonzero(first)
        row = np.searchsorted(s.starts, starts, "right") - 1
        # pieces stand one after the other in the text without the bytes between rows
        inside = np.ones(len(s.buf), bool)
        inside[s.ends] = False
        inside[0] = False
        at = np.append(starts - row - 1, len(s.buf) - s.n - 1)
        coded = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(s.buf[inside])]).dictionary_encode()
        number = coded.indices.to_numpy(zero_copy_only=False)
        place = self._places(coded.dictionary)[number]
        count = self.count[place]
        ids = ragged(self.pool, self.at[place], count)
        offsets = np.append(np.searchsorted(starts, s.starts), len(starts))
        return ids, np.concatenate([np.zeros(1, np.int64), np.cumsum(count)])[offsets]

    def _cuts(self, s: Slice) -> np.ndarray:
        """Whether a piece begins at each byte."""
        buf, kind = s.buf, _CLASS[s.buf]
        before, here, after = kind[:-2], kind[1:-1], kind[2:]
        cut = (buf[1:-1] == 32) & ((after & _MAYBE_SPACE) == 0)
        single = (before & _OTHER_SPACE) > here & _MAYBE_SPACE
        single[:1] = False
        single[1:] &= (kind[:-3] & (_MAYBE_SPACE | _HIGH)) == 0
        cut |= single
        cut |= ((before & _LETTER) << 1) & here > 0
        first = np.zeros(len(buf), bool)
        first[1:-1] = cut
        first[s.ends] = False
        # the byte after a row's end is the separator or the next row's start
        first[s.starts[s.ends > s.starts]] = True
        if self.added:
            text = buf.tobytes()
            for token in self.added:
                i = text.find(token)
                while i >= 0:
                    end = i + len(token)
                    first[i + 1:end] = False
                    first[i] = True
                    # white space before the token runs to the end of its own stretch of text
                    if i >= 2 and buf[i - 1] == 32 and kind[i - 2] & (_MAYBE_SPACE | _HIGH) and i - 1 not in s.starts:
                        first[i - 1] = False
                    if end not in s.ends:
                        first[end] = True
                    i = text.find(token, end)
        return first

    def _sizes(self, pieces: pa.LargeBinaryArray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces' bytes; whether each is short and begins at a cut (a): one after the other, such are cut where they meet."""
        if not len(pieces):
            return np.zeros(0, np.int64), np.zeros(0, bool)
        at = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset:pieces.offset + len(pieces) + 1]
        buf, size = np.frombuffer(pieces.buffers()[2], np.uint8), np.diff(at)
        second = _CLASS[buf[np.minimum(at[:-1] + 1, len(buf) - 1)]]
        return size, (size > 1) & (size <= LONG) & (buf[at[:-1]] == 32) & (second & _MAYBE_SPACE == 0) & self.joins

    def _places(self, different: pa.LargeBinaryArray) -> np.ndarray:
        """The places of different pieces in ``at`` and ``count``."""
        if self.kept > self.keep_bytes:
            self._shrink()
        pieces = different.to_numpy(zero_copy_only=False).tolist()
        place = np.fromiter(map(self.known.get, pieces, repeat(-1)), np.int64, len(pieces))
        size, joins = self._sizes(different)
        new = np.flatnonzero(place < 0)
        alone, joined = (new[joins[new] == x].tolist() for x in (False, True))
        new, counts, ids = alone + joined, [], []
        for some in (alone, joined):
            for i in range(0, len(some), self.AT_ONCE):
                part = [pieces[k] for k in some[i:i + self.AT_ONCE]]
                if some is joined:
                    got = self.tokenizer.encode_batch_fast([b"".join(part).decode("utf-8", "replace")], add_special_tokens=False)[0].ids
                else:
                    got = self.tokenizer.encode_batch_fast([[p.decode("utf-8", "replace") for p in part]], is_pretokenized=True, add_special_tokens=False)[0].ids
                got = np.array(got, np.int32)
                # the pieces' ids follow each other, and as many bytes as a piece has are its own
                ends = np.searchsorted(np.cumsum(self.length[got]), np.cumsum(size[some[i:i + self.AT_ONCE]])) + 1
                counts.append(np.diff(ends, prepend=0))
                ids.append(got)
        if new:
            count = np.concatenate(counts)
            place[new] = len(self.at) + np.arange(len(new))
            self.at = np.concatenate([self.at, len(self.pool) + np.cumsum(count) - count])
            self.count = np.concatenate([self.count, count])
            self.used = np.concatenate([self.used, np.zeros(len(new), np.int32)])
            self.pool = np.concatenate([self.pool, *ids])
            self.known.update(zip([pieces[k] for k in new], place[new].tolist()))
            self.kept = len(self.known) * self.ENTRY + 4 * len(self.pool)
        self.used[place] += 1
        return place
