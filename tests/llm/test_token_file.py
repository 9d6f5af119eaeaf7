"""Huffman token file: optimal lengths, exact round trip, and the whole file against the library."""

import random
import zlib

import numpy as np
import pytest

P = pytest.importorskip("public_tokenizers")

import pyarrow as pa  # noqa: E402
import twins  # noqa: E402
from vitalspark.llm import token_file as T  # noqa: E402
from vitalspark.llm.arrow_text import PieceEncoder, slices  # noqa: E402
from vitalspark.session import work_path  # noqa: E402

PATH = P.path("byte_bpe_50k.json")


def huffman_cost(counts):
    import heapq
    h = [c for c in counts if c]
    heapq.heapify(h)
    cost = 0
    while len(h) > 1:
        a = heapq.heappop(h) + heapq.heappop(h)
        cost += a
        heapq.heappush(h, a)
    return cost


@pytest.mark.parametrize("n", [1, 2, 3, 50, 3000])
def test_code(n):
    rng = np.random.default_rng(n)
    counts = (rng.pareto(0.8, n) * 10).astype(np.int64) + 1
    if n > 3:
        counts[rng.random(n) < 0.2] = 0
    for limit in (12, 18):
        bits = T.code_lengths(counts, limit)
        assert (bits > 0).sum() == (counts > 0).sum() and bits.max() <= limit
        if n > 1:
            assert sum(2.0 ** -float(b) for b in bits if b) == 1
    if n > 1 and T.code_lengths(counts, 30).max() <= 18:
        assert (T.code_lengths(counts, 18) * counts).sum() == huffman_cost(counts.tolist())
    bits = T.code_lengths(counts)
    ids = rng.choice(np.flatnonzero(counts), 10_000)
    for size in (0, 1, 255, 256, 257, 10_000):
        payload, marks = T.encode_bits(ids[:size], T.code_words(bits), bits)
        assert len(payload) == -(-int(bits[ids[:size]].sum()) // 8)
        assert T.Decoder(bits).decode(payload, marks, size).tolist() == ids[:size].tolist()


def test_limit_is_best_possible():
    """Fibonacci counts need deep codes; the limited one must cost least among all codes of that depth."""
    counts = np.array([1, 1, 2, 3, 5, 8, 13, 21])
    bits = T.code_lengths(counts, 4)
    from itertools import combinations_with_replacement
    best = min(sum(c * b for c, b in zip(sorted(counts, reverse=True), ls))
               for ls in combinations_with_replacement(range(1, 5), 8) if sum(2.0 ** -b for b in ls) <= 1)
    assert (bits * counts).sum() == best


TEXTS = [None, "", "one two", "one two", "é 日本 <|endoftext|> \n\n x", "<|endoftext|>", twins.A, twins.B, "long " * 50_000, "x" * 100_000] + [" ".join(random.Random(i).choices(["a", "bc", "def.", "\n", "10"], k=i * 37)) for i in range(40)]


def test_file(spark):
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(PATH)
    rows = [(i * 3 % 53 + (i > 3) * 100, t) for i, t in enumerate(TEXTS)] + [(None, "null id")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS part").repartition(5)
    tokens = T.tokenize(df, PATH)
    path = work_path(spark, "token-file-test")
    T.write_token_file(tokens, "<u2", path, 4)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in T.read_token_file(spark, path).collect())
    ids = {d: np.array([*tk.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for d, t in rows}
    start, want = 0, []
    for d in sorted(ids, key=lambda d: (d is not None, d or 0)):
        want.append((start, d, len(ids[d]), zlib.crc32(ids[d].tobytes())))
        start += len(ids[d])
    assert got == want


@pytest.mark.parametrize("switch", [False, True])
@pytest.mark.parametrize("room", [None, 3000])
def test_added_tokens_and_kept_pieces(switch, room):
    """As the library encodes whole texts, with its default switch and the other one; also where few pieces are kept."""
    from tokenizers import Tokenizer
    tk = Tokenizer.from_file(PATH)
    tk.encode_special_tokens = switch
    encoder = PieceEncoder(tk)
    if room:
        encoder.keep_bytes = room
    rng = random.Random(room or 0)
    parts = ["<|endoftext|>", "<|endoftext|>", "<|endoftext", "|>", "a", " ", "  ", "\n", "\t", "\u00a0", "é", "日", "'s", ".", "12", "word"]
    texts = [twins.A, twins.B, "", *["".join(rng.choices(parts, k=rng.randrange(1, 9))) for _ in range(3000)], twins.B, twins.A]
    for s in slices(pa.array(texts), max_bytes=4000):
        ids, at = encoder.encode(s)
        for i in range(s.n):
            assert ids[at[i]:at[i + 1]].tolist() == tk.encode(texts[s.first + i], add_special_tokens=False).ids, repr(texts[s.first + i])


@pytest.mark.parametrize("added", [None, "word <x"])
def test_short_pieces_are_one_text(added):
    """Pieces that begin with a space and no white space are handed over as one text, as lists cost more; the ids are those
    of whole texts, also where pieces put together would spell an added token."""
    from tokenizers import AddedToken, Tokenizer
    tk = Tokenizer.from_file(PATH)
    if added:
        tk.add_special_tokens([AddedToken(added, normalized=False)])
    lists = []

    class Watched:
        def __getattr__(self, name):
            return getattr(tk, name)

        def encode_batch_fast(self, given, **how):
            lists.extend(x for x in given if isinstance(x, list))
            return tk.encode_batch_fast(given, **how)

    encoder, rng = PieceEncoder(Watched()), random.Random(5)
    parts = [" word", " <x>", " 12", " \u00e9t\u00e9", "  ", " \u00a0", "\n", " ", ".", "'s", " word <x", "x" * 70, " " + "y" * 70]
    texts = [" word", "", " <x> <x", "a", *["".join(rng.choices(parts, k=rng.randrange(1, 9))) for _ in range(2000)]]
    for s in slices(pa.array(texts), max_bytes=3000):
        ids, at = encoder.encode(s)
        for i in range(s.n):
            assert ids[at[i]:at[i + 1]].tolist() == tk.encode(texts[s.first + i], add_special_tokens=False).ids, repr(texts[s.first + i])
    assert (" 12" in {p for x in lists for p in x}) == bool(added)


def test_empty(spark):
    path = work_path(spark, "token-file-empty")
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string").where("false")
    T.write_token_file(T.tokenize(df, PATH), "<u2", path, 3)
    assert T.read_token_file(spark, path).count() == 0


def test_texts_come_by_bytes(spark):
    from vitalspark.llm import arrow_text as A
    before = spark.conf.getAll.get(A.BATCH_BYTES)
    spark.conf.unset(A.BATCH_BYTES)
    try:
        df = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
        assert {r.doc_id: r.n_tokens for r in T.tokenize(df, PATH).where("n_tokens IS NOT NULL").collect()}[2] == 1
        assert spark.conf.getAll.get(A.BATCH_BYTES) == T.BATCH
    finally:
        spark.conf.unset(A.BATCH_BYTES)
        if before is not None:
            spark.conf.set(A.BATCH_BYTES, before)
