"""Kneser-Ney model against dictionaries, and that probabilities add up."""

import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

import twins
from vitalspark.llm import kneser_ney as K


class Brute:
    def __init__(self, texts):
        self.c, self.pairs, self.after = Counter(), Counter(), Counter()
        for t in texts:
            w = [*self.words(t), "</s>"]
            self.c.update(w)
            self.pairs.update(zip(["<s>", *w], w))
        for (h, _), n in self.pairs.items():
            self.after[h] += n
        self.a = Counter(w for _, w in self.pairs)
        t = lambda values: [sum(v == k for v in values) for k in (1, 2, 3, 4)]
        self.d, self.e = K.discounts(t(self.pairs.values())), K.discounts(t(self.a.values()))
        self.n, self.v, self.types = sum(self.c.values()), len(self.c), len(self.pairs)
        self.held = defaultdict(float)
        for (h, _), n in self.pairs.items():
            self.held[h] += self.d[min(n, 3)]
        self.unseen = (sum(self.e[min(a, 3)] for a in self.a.values()) / self.types if self.types else 1) / (self.v + 1)

    @staticmethod
    def words(t):
        t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for c in "\t\n\x0b\x0c\r":
            t = t.replace(c, " ")
        return [w for w in t.split(" ") if w]

    def p(self, h, w):
        low = max(self.a[w] - self.e[min(self.a[w], 3)], 0) / self.types + self.unseen if self.types else self.unseen
        if not self.after[h]:
            return low
        n = self.pairs[h, w]
        return max(n - self.d[min(n, 3)], 0) / self.after[h] + self.held[h] / self.after[h] * low

    def row(self, t):
        w = [*self.words(t), "</s>"]
        return (len(w), sum(self.c[x] > 0 for x in w), self.n, sum(math.log10((self.c[x] + 1) / (self.n + self.v + 1)) for x in w),
                sum(math.log10(self.p(h, x)) for h, x in zip(["<s>", *w], w)))


def corpus():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(300)]
    rows = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(300)], k=rng.randrange(0, 120))) for _ in range(300)]
    rows += [None, "", " \n", "THE the The", "É é\x0bx", "hot " * 5000, "hot pair " * 400, "hot pair"] + ["same text"] * 3
    return list(enumerate(rows))


@pytest.mark.parametrize("window", [1 << 22, 500])
def test_against_dictionaries(spark, monkeypatch, window):
    monkeypatch.setattr(K, "WINDOW", window)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS files").repartition(4)
    out = K.score(df, K.train(df.where(~K.held_out()))).collect()
    brute = Brute([t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2])
    assert len(out) == len(rows)
    for r in out:
        want = brute.row(rows[r.doc_id][1])
        got = (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
        assert got[:3] == want[:3] and got[3:] == pytest.approx(want[3:], rel=1e-9), rows[r.doc_id]


def test_probabilities_add_up():
    brute = Brute([t for _, t in corpus()])
    for h in ["<s>", "w0", "w7", "hot", "never seen"]:
        assert sum(brute.p(h, w) for w in [*brute.c, "unknown"]) == pytest.approx(1)


def test_held_out_text_is_better_known_than_by_single_words(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    out = K.score(docs, K.train(docs.where(~K.held_out()))).join(docs.select("doc_id", K.held_out().alias("held")), "doc_id").where("held")
    r = out.selectExpr("sum(score) AS s", "sum(base_score) AS b").first()
    assert r.s > r.b


def test_large_counts_and_empty_training(spark):
    df = spark.createDataFrame([(1, "a b " * 300), (2, "a b c"), (None, "a")], "doc_id long, text string")
    brute = Brute(["a b " * 300, "a b c", "a"])
    for r in K.score(df, K.train(df)).where("doc_id IS NOT NULL").collect():
        assert r.score == pytest.approx(brute.row({1: "a b " * 300, 2: "a b c"}[r.doc_id])[4])
    none = K.score(df, K.train(df.where("false"))).collect()
    assert all(r.score == 0 and r.base_score == 0 and r.n_known == 0 for r in none)
    assert K.score(df.where("false"), K.train(df)).count() == 0


class Brute3(Brute):
    """Order 3: bigrams count the different words before them, those of the start as they occur."""

    def __init__(self, texts):
        super().__init__(texts)
        self.triples, self.after3, self.held3 = Counter(), Counter(), defaultdict(float)
        for t in texts:
            w = ["<s>", *self.words(t), "</s>"]
            self.triples.update(zip(w, w[1:], w[2:]))
        self.pairs = Counter({p: n for p, n in self.pairs.items() if p[0] == "<s>"})
        self.pairs.update((h, w) for _, h, w in self.triples)
        t = lambda values: [sum(v == k for v in values) for k in (1, 2, 3, 4)]
        self.d, self.f = K.discounts(t(self.pairs.values())), K.discounts(t(self.triples.values()))
        self.after, self.held = Counter(), defaultdict(float)
        for (h, _), n in self.pairs.items():
            self.after[h] += n
            self.held[h] += self.d[min(n, 3)]
        for (g, h, _), n in self.triples.items():
            self.after3[g, h] += n
            self.held3[g, h] += self.f[min(n, 3)]

    def p3(self, g, h, w):
        if not self.after3[g, h]:
            return self.p(h, w)
        n = self.triples[g, h, w]
        return max(n - self.f[min(n, 3)], 0) / self.after3[g, h] + self.held3[g, h] / self.after3[g, h] * self.p(h, w)

    def row(self, t):
        w = ["<s>", *self.words(t), "</s>"]
        score = math.log10(self.p(*w[:2])) + sum(math.log10(self.p3(*x)) for x in zip(w, w[1:], w[2:]))
        return (*super().row(t)[:4], score)


@pytest.mark.parametrize("window", [1 << 22, 500])
def test_trigrams_against_dictionaries(spark, monkeypatch, window):
    monkeypatch.setattr(K, "WINDOW", window)
    rows = corpus()
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n", "'x' AS before").repartition(4)
    out = K.score(df, K.train(df.where(~K.held_out()), 3)).collect()
    brute = Brute3([t for i, t in rows if zlib.crc32(str(i).encode()) % 7 != 2])
    assert len(out) == len(rows)
    for r in out:
        want = brute.row(rows[r.doc_id][1])
        got = (r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
        assert got[:3] == want[:3] and got[3:] == pytest.approx(want[3:], rel=1e-9), rows[r.doc_id]
    for g, h in [("<s>", "w0"), ("w0", "w1"), ("hot", "hot"), ("w0", "never seen")]:
        assert sum(brute.p3(g, h, w) for w in [*brute.c, "unknown"]) == pytest.approx(1)
    none = K.score(df, K.train(df.where("false"), 3)).collect()
    assert all(r.score == 0 and r.n_known == 0 for r in none)


def test_the_query_knows_more_than_one_word_of_context(spark, tmp_path):
    """After "b c" comes "d" if "a" stands before it, else "e"; one word of context can't tell."""
    texts = ["a b c d"] * 40 + ["x b c e"] * 40 + ["c d a b", "b c e x"]
    spark.createDataFrame([(i, t) for i, t in enumerate(texts * 3)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: r.score for r in K.op5_kneser_ney(spark, str(tmp_path)).collect()}
    brute = Brute3([t for i, t in enumerate(texts * 3) if zlib.crc32(str(i).encode()) % 7 != 2])
    assert all(got[i] == pytest.approx(brute.row(t)[4]) for i, t in enumerate(texts * 3))


@pytest.mark.parametrize("kind", ["<u8", "<u4", "<i8"])
def test_packed_numbers(kind):
    rng = random.Random(1)
    import numpy as np
    for n in (0, 1, 2, 1000):
        top = np.iinfo(kind).max
        x = np.array([rng.choice([0, 1, 7, top, top - 1, rng.randrange(top)]) for _ in range(n)], kind)
        for y in (x, np.sort(x)):
            assert (K.unpack(K.pack(y), kind) == y).all()
        wide = np.array([[rng.randrange(1 << 40) for _ in range(5)] for _ in range(n)], np.int64).reshape(n, 5)
        assert (K.unpack(K.pack(wide), np.int64, 5) == wide).all()


def test_a_word_never_trained_on_is_unknown(spark):
    df = spark.createDataFrame([(1, f"{twins.A} x")], "doc_id long, text string")
    spec = K.train(df, 3)
    got = K.score(spark.createDataFrame([(2, twins.B), (3, twins.A)], "doc_id long, text string"), spec).collect()
    assert {r.doc_id: r.n_known for r in got} == {2: 1, 3: 2}


def test_sums_of_contexts_are_small_files(spark):
    """Four bytes a context of two words, but for those with large sums, whose scores are right too."""
    import numpy as np
    texts = [f"{'hot pair ' * 400}", *[f"a{i} b{i} c{i} a{i} b{i} d{i}" for i in range(200)]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    spec = K.train(df, 3)
    n = sum(len(K.map_array(files[0], np.uint64)) for _, *files in spec["context_files"])
    size = sum(len(K.map_array(f, np.uint8)) for _, *files in spec["context_files"] for f in files[:2])
    large = sum(len(K.map_array(files[2], np.uint64)) for _, *files in spec["context_files"])
    assert n > 200 and size == 12 * n and 0 < large < 5
    brute = Brute3(texts)
    for r in K.score(df, spec).collect():
        assert r.score == pytest.approx(brute.row(texts[r.doc_id])[4], rel=1e-9)
