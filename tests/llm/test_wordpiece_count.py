"""Word-piece counts against plain greedy longest match."""

import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")

import twins  # noqa: E402
from vitalspark.llm import wordpiece_count as W  # noqa: E402
from vitalspark.llm.arrow_text import slices  # noqa: E402


def greedy(word, begin, go_on):
    """Pieces of a word, 0 if it can't be cut up."""
    longest = max(map(len, begin | go_on), default=0)
    at, n, pieces = 0, 0, begin
    while at < len(word):
        for size in range(min(longest, len(word) - at), 0, -1):
            if word[at:at + size] in pieces:
                break
        else:
            return 0
        at, n, pieces = at + size, n + 1, go_on
    return n


@pytest.mark.parametrize("seed", range(6))
def test_small_vocabularies(seed):
    rng = random.Random(seed)
    words = [bytes(x) for k in range(1, 5) for x in itertools.product(b"abc", repeat=k)]
    begin, go_on = set(rng.sample(words, 12)), set(rng.sample(words, 15))
    every = [bytes(x) for k in range(1, 8) for x in itertools.product(b"abcd" if k < 6 else b"abc", repeat=k)]
    a = W.Automaton(begin, go_on)
    buf = np.frombuffer(b" " + b" ".join(every), np.uint8)
    ends = np.cumsum([len(w) + 1 for w in every])
    got = a.counts(buf, ends - [len(w) for w in every], ends)
    want = [greedy(w, begin, go_on) for w in every]
    assert got.tolist() == want and [a.count(w) for w in every] == want


TEXTS = [None, "", " \n", "The quick brown fox", "antidisestablishmentarianism  naïve 日本語 😀😀", "x" * 3000 + " end", "same", "same",
         " ".join("".join(random.Random(i).choices("abcdefghijklmnop'.,éß", k=i % 19 + 1)) for i in range(3000))]


def test_documents(spark):
    begin, go_on = W.vocabulary(P.path("byte_bpe_50k.tiktoken"))
    a = W.Automaton(begin, go_on)
    df = spark.createDataFrame([*enumerate(TEXTS), (None, "no id")], "doc_id long, text string").selectExpr("*", "1 AS n_words").repartition(3)
    got = {r.doc_id: tuple(r)[1:] for r in W.count_tokens(df, a).collect()}
    for i, t in [*enumerate(TEXTS), (None, "no id")]:
        n = [greedy(w.encode(), begin, go_on) for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")]
        assert got[i] == (len(n), sum(max(1, x) for x in n), n.count(0)), i
    assert W.count_tokens(df.where("false"), a).count() == 0


def test_slices_do_not_matter():
    a = W.Automaton({b"a", b"ab"}, {b"a", b"b"})
    texts = ["ab aba", None, "", "c ab", "b"]
    whole = [np.concatenate(x).tolist() for x in zip(*[W.count_slice(a, s) for s in slices(pa.array(texts))])]
    assert whole == [np.concatenate(x).tolist() for x in zip(*[W.count_slice(a, s) for s in slices(pa.array(texts), max_bytes=1)])]
    assert whole == [[2, 0, 0, 2, 1], [3, 0, 0, 2, 1], [0, 0, 0, 1, 1]]


def test_words_that_a_polynomial_hash_takes_for_one():
    a = W.Automaton({b"a", b"b", b"ab", twins.A.encode()}, {b"a", b"b", b"ab"})
    for s in slices(pa.array([f"{twins.A} {twins.B}", twins.B])):
        words, tokens, _ = W.count_slice(a, s)
        n = greedy(twins.B.encode(), {b"a", b"b", b"ab"}, {b"a", b"b", b"ab"})
        assert words.tolist() == [2, 1]
        assert tokens.tolist() == [1 + n, n]
