"""Each stage of the pipeline on its own input, against brute force."""

import hashlib
import pickle
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

P = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")

import corpus_pipeline as C  # noqa: E402
from test_mixing import brute_targets  # noqa: E402
from test_set_join import brute  # noqa: E402
from vitalspark.llm import bpe, quality_cnn  # noqa: E402
from vitalspark.llm.arrow_text import slices  # noqa: E402
from vitalspark.session import materialize  # noqa: E402

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, f in C.STAGES:
        out.append(materialize(f(spark, out[-1], SF), name))
    return out


def test_stage_columns(stages):
    assert [set(s.columns) for s in stages[:4]] == [set(C.COLUMNS)] * 4
    assert [name for name, _ in C.STAGES] == ["quality", "near_duplicates", "mixture", "tokens"]


def test_quality(spark, stages):
    model = pickle.loads(quality_cnn.train(stages[0], spark.read.parquet(f"{SF}/labels.parquet")))
    rows = stages[0].collect()
    score = np.concatenate([model.score(s) for s in slices(pa.array([r.text for r in rows]))])
    assert {r.doc_id for r in stages[1].collect()} == {r.doc_id for r, x in zip(rows, score) if x >= 0.3}


def test_near_duplicates(stages):
    want = brute([(r.doc_id, r.text) for r in stages[1].collect()])
    assert {r.doc_id for r in stages[2].collect()} == {d for d, _, c in want if d == c}


def test_mixture(stages):
    before, after = stages[2].collect(), Counter(stages[3].collect())
    assert set(after) <= set(before)
    size = {r: len(r.text.split()) for r in before}
    per = Counter()
    for r, n in size.items():
        per[r.source] += n
    want = brute_targets(dict(per))
    for s in per:
        mine = [r for r in before if r.source == s]
        assert abs(sum(size[r] * after[r] for r in mine) - want[s]) <= max(size[r] for r in mine)


def test_tokens(stages):
    theirs = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.read_ranks(C.RANKS), special_tokens={})
    text = {r.doc_id: r.text for r in stages[3].collect()}
    rows = stages[4].collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in stages[3].collect())
    for r in rows:
        assert r.ids == theirs.encode_ordinary(text[r.doc_id])
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()


def test_edge_documents_pass_through(spark):
    docs = spark.createDataFrame([(1, None, "en", None, None), (2, "", "en", "a", 0), (None, "no id at all here", "en", "a", 17),
                                  (3, "a b c d e f", None, "b", 11), (3, "a b c d e f", None, "b", 11)],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    for name, f in C.STAGES:
        docs = materialize(f(spark, docs.withColumn("copies", docs.doc_id), "/root/testdata/sf0.001"), name)
    assert docs.columns == ["doc_id", "n_tokens", "ids", "ids_sha256", "decoded_sha256"]


def odd_ids(spark, name):
    """A third of the rows has no id, another third has one of five."""
    rows = [(None if i % 3 == 0 else i % 5 if i % 3 == 1 else i, " ".join(f"w{i * 31 % 89 + j * (i + 1)}" for j in range(5 + i * 7 % 40)),
             "en", "abc"[i % 7 % 3], i) for i in range(600)]
    rows += [(None, r[1] + " more", "en", "a", -1) for r in rows[20:80]]        # near copies of others, if long
    rows += [(r[0], r[1], "en", "b", -2) for r in rows[100:140]] + [(7, "", "en", "a", 0), (7, None, "en", "a", 0), (None, "", "en", "b", 0)] + rows[:3]
    return rows, materialize(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5), name)


def test_mixture_of_null_and_repeated_ids(spark):
    rows, docs = odd_ids(spark, "odd-mixture")
    got = [tuple(r) for r in C.mixture(spark, docs, SF).collect()]
    assert sorted(map(str, got)) == sorted(str(tuple(r)) for r in C.mixture(spark, materialize(docs.repartition(3), "odd-again"), SF).collect())
    size = lambda r: len((r[1] or "").split())
    per = Counter()
    for r in rows:
        per[r[3]] += size(r)
    want = brute_targets(dict(per))
    for s in per:
        mine = [r for r in rows if r[3] == s]
        assert abs(sum(size(r) for r in got if r[3] == s) - want[s]) <= max(map(size, mine))
    taken, given = Counter(got), Counter(rows)
    for r, n in given.items():
        f = want[r[3]] / per[r[3]]
        assert size(r) == 0 or n * int(f) <= taken[r] <= n * (int(f) + 1)
    assert any(r[0] is None for r in got)


def test_near_duplicates_of_null_and_repeated_ids(spark):
    rows, docs = odd_ids(spark, "odd-near")
    got = Counter(tuple(r) for r in C.near_duplicates(spark, docs, SF).collect())
    component = {i: c for i, _, c in brute([(i, r[1]) for i, r in enumerate(rows)])}
    members = {}
    for i, c in component.items():
        members.setdefault(c, []).append(rows[i])
    assert sum(got.values()) == len(members) < len(rows)
    assert not got - Counter(rows)
    at = {}
    for i, r in enumerate(rows):
        at.setdefault(r, component[i])
    left = Counter(component[i] for i, r in enumerate(rows) if not r[1])      # rows without words stay, each by itself
    for r, n in got.items():
        if r[1]:
            assert n == 1
            left[at[r]] += 1
            ids = [m[0] for m in members[at[r]]]
            assert r[0] == (None if None in ids else min(ids))
    assert left == Counter(dict.fromkeys(members, 1))


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("false")
    for name, f in C.STAGES:
        docs = materialize(f(spark, docs, SF), f"empty-{name}")
        assert docs.count() == 0
        if name != "tokens":
            assert docs.columns == C.COLUMNS


def test_stages_on_very_long_texts(spark):
    """Two near copies of 150,000 words and an unspaced text of 300,000 characters, beside short ones."""
    long = [f"w{i * i % 9973}" for i in range(150_000)]
    texts = [" ".join(long), " ".join([*long[:-100], "other", "end"]), "的一是不" * 75_000, "a short one of six words"]
    rows = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)]
    docs = materialize(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long"), "long")
    kept = materialize(C.near_duplicates(spark, docs, SF), "long-near")
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {0, 2, 3}
    mixed = materialize(C.mixture(spark, kept, SF), "long-mix")
    assert {r.doc_id for r in mixed.select("doc_id").collect()} >= {0}
    ids = {r.doc_id: r for r in C.tokens(spark, kept, SF).collect()}
    for i in (0, 2, 3):
        assert ids[i].decoded_sha256 == hashlib.sha256(texts[i].encode()).hexdigest()
    assert C.quality(spark, docs, SF).count() <= 4
