"""Byte-level BPE against the tiktoken library, and exact decoding."""

import hashlib
import itertools
import random

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

import twins  # noqa: E402
from vitalspark.llm import bpe  # noqa: E402
from vitalspark.llm.arrow_text import slices  # noqa: E402

PATH = P.path("byte_bpe_multi_50k.tiktoken")
TEXTS = [None, "", "a", "The end.\n\n The  next\t\tone 's it's", "é  x 日本語 😀😀 naïve", "<|endoftext|> </s>", "word " * 30000,
         "x" * 5000, " \n \r\n", "a\x00b\x1cc", "same", "same", twins.A, twins.B]


@pytest.fixture(scope="module")
def theirs():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})


@pytest.fixture(scope="module")
def ours():
    return bpe._worker(bpe.tokenizer_json(bpe.read_ranks(PATH), P.PATTERN), PATH)


def frame(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").selectExpr("*", "7 AS ids", "'z' AS lang").repartition(3)


def test_against_tiktoken(spark, theirs):
    rows = {r.doc_id: r for r in bpe.encode(frame(spark), PATH, P.PATTERN).collect()}
    digests = {r.doc_id: r for r in bpe.encode(frame(spark), PATH, P.PATTERN, digest=True).collect()}
    for i, t in enumerate(TEXTS):
        want = theirs.encode_ordinary(t or "")
        assert rows[i].ids == want and rows[i].n_tokens == len(want)
        assert digests[i].ids_sha256 == hashlib.sha256(",".join(map(str, want)).encode()).hexdigest()
        assert digests[i].decoded_sha256 == hashlib.sha256((t or "").encode()).hexdigest()


def test_decoding_and_offsets(spark):
    enc = bpe.encode(frame(spark), PATH, P.PATTERN, offsets=True)
    back = {r.doc_id: r.text for r in bpe.decode(enc, PATH).collect()}
    assert back == {i: t or "" for i, t in enumerate(TEXTS)}
    table = bpe.ByteTable(bpe.read_ranks(PATH))
    for r in enc.collect():
        text = TEXTS[r.doc_id] or ""
        for k, (i, a, b) in enumerate(zip(r.ids, r.char_start, r.char_end)):
            if k < 500:
                assert table.decode(np.array([i])) in text[a:b].encode()
        assert not r.ids or (r.char_start[0], r.char_end[-1]) == (0, len(text))


def test_split_characters(ours):
    _, table = ours
    ranks = bpe.read_ranks(PATH)
    ids = [ranks[bytes([b])] for b in "a😀é".encode()]
    assert "".join(table.decode_parts([[i] for i in ids])) == "a😀é"
    assert "".join(table.decode_parts([ids[:3]])) == "a�"
    start, end = table.offsets(np.array(ids))
    assert start.tolist() == [0, 1, 1, 1, 1, 2, 2] and end.tolist() == [1, 2, 2, 2, 2, 3, 3]


def test_cutting_and_merge_order(ours, theirs):
    """Short texts over characters that decide the splits, and periodic ones whose merges tie."""
    encoder, _ = ours
    rng = random.Random(3)
    texts = ["".join(x) for k in (1, 2, 3, 4) for x in itertools.product(" \n\ta.'s  é", repeat=k)]
    texts += ["".join(rng.choice(al) for _ in range(rng.randrange(60))) for al in ("a", "ab", "=-", " ", "e ", "0", "の", "ha") for _ in range(200)]
    for s in slices(pa.array(texts)):
        ids, at = encoder.encode(s)
        for i in range(s.n):
            assert ids[at[i]:at[i + 1]].tolist() == theirs.encode_ordinary(texts[s.first + i]), texts[s.first + i]


def test_empty(spark):
    assert bpe.encode(frame(spark).where("false"), PATH, P.PATTERN, digest=True).count() == 0


def test_memory_comes_back_after_each_slice(spark, monkeypatch):
    """What a slice has freed is given back before the next one, not when the task ends."""
    runs, back = [], []

    class Texts:
        def mapInArrow(self, run, schema):
            runs.append(run)

    monkeypatch.setattr(bpe, "by_bytes", lambda docs: Texts())
    monkeypatch.setattr(bpe, "trim", lambda forget=True: back.append(forget))
    monkeypatch.setattr(bpe, "SLICE", 40)
    texts = ["some words of a text " * 2, "more of them " * 4, None, "x" * 50]
    bpe.encode(spark.createDataFrame([(1, "a")], "doc_id long, text string"), PATH, P.PATTERN, digest=True)
    batch = pa.record_batch([pa.array(range(4), pa.int64()), pa.array(texts)], names=["doc_id", "text"])
    out = runs[0](iter([batch, batch]))
    next(out)
    back.clear()
    for _ in out:
        assert back.pop() is False
    assert back
