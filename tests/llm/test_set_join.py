"""Jaccard join against brute force over random edits, shared passages, copies and edge rows."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

import twins
from vitalspark.llm import set_join as J
from vitalspark.llm.arrow_text import LOWER, slices


def brute(rows):
    sets = {}
    for d, t in rows:
        w = "".join(c.lower() if c.isascii() else c for c in t or "").replace(" ", " ")
        w = [x for x in __import__("re").split(r"[\x20\x09-\x0D]+", w) if x]
        sets[d] = {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 75 * len(sets[a] | sets[b]):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {(d, len(sets[d]), root(d)) for d in sets}


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    text = lambda n: rng.choices(vocabulary, k=n)
    passage, rows = text(60), []
    for size in (3, 6, 7, 8, 9, 10, 12, 15, 20, 40, 90, 200, 700):
        for _ in range(6):
            base = text(size)
            if rng.random() < 0.5:
                base = passage + base
            for _ in range(rng.randrange(1, 6)):
                copy = list(base)
                for _ in range(rng.randrange(0, max(2, len(copy) // 18))):
                    i = rng.randrange(len(copy))
                    kind = rng.randrange(3)
                    if kind == 0:
                        copy[i] = rng.choice(vocabulary)
                    elif kind == 1:
                        copy.insert(i, rng.choice(vocabulary))
                    elif len(copy) > 1:
                        del copy[i]
                rows.append(" ".join(x.upper() if rng.random() < 0.1 else x for x in copy))
    rows += [None, "", " \t\n", "one", "ONE", "one two three", "One  two\nthree", "a b c d e", "a b c d e"] + [" ".join(passage)] * 5
    rows += [twins.A, twins.B, f"{twins.A} " * 6, f"{twins.B} " * 6, "very long " * 30_000 + "text"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1L AS n", "'x' AS members", "2L AS id").repartition(4)
    got = {tuple(r) for r in J.jaccard_join(df)[0].collect()}
    assert got == brute(rows)


def test_low_sharing_bounds_do_not_change_the_result(spark, monkeypatch):
    """Many short documents that are mostly one passage: their cheapest signatures are shared ones."""
    monkeypatch.setattr(J, "SHARED_FROM", 2)
    rng = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    rows = [(i, " ".join(passage + [f"u{rng.randrange(300)}" for _ in range(rng.randrange(2, 16))])) for i in range(150)]
    got = {tuple(r) for r in J.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3))[0].collect()}
    assert got == brute(rows)


def test_every_linked_pair_shares_an_indexed_signature():
    rng = np.random.default_rng(0)
    for n in [3, 4, 5, 6, 7, 8, 9, 11, 12, 13, 15, 16, 17, 23, 24, 31, 32, 40, 64, 100, 250, 1000]:
        for _ in range(60):
            base = rng.integers(0, 1 << 63, n, dtype=np.int64).astype(J.U)
            other = base.copy()
            drop = rng.integers(0, n // 4 + 1)
            other = np.sort(np.concatenate([other[drop:], rng.integers(0, 1 << 63, rng.integers(0, n // 3 + 1), dtype=np.int64).astype(J.U)]))
            both = n - drop
            if 100 * both < 75 * (n + len(other) - both):
                continue
            keys = [set(), set()]
            shared = np.sort(rng.choice(base, n // 2, replace=False))
            for row, key, need in J.signatures([np.sort(base), other], (shared, (shared % J.U(5)) + J.U(1))):
                for r in (0, 1):
                    mine = np.sort(key[row == r])
                    if len(mine):
                        keys[r] |= set(mine[:int(need[row == r][0])].tolist())
            assert keys[0] & keys[1] or np.array_equal(np.sort(base), other), n


def test_bitmaps_bound_the_difference():
    rng = np.random.default_rng(1)
    for n in (0, 1, 100, 511, 512, 513, 700, 3000):
        base = rng.integers(0, 1 << 63, n, dtype=np.int64).astype(J.U)
        other = np.concatenate([base[n // 5:], rng.integers(0, 1 << 63, n // 4, dtype=np.int64).astype(J.U)])
        a, b = (np.frombuffer(x, J.U).reshape(1, -1) for x in J.parity_bitmaps([base, other]))
        words = min(a.shape[1], b.shape[1])
        assert np.bitwise_count(J.fold(a, words) ^ J.fold(b, words)).sum() <= n // 5 + n // 4


def test_sets_do_not_depend_on_slices():
    texts = [t for _, t in corpus(3)]
    whole = [J.shingles(s) for s in slices(pa.array(texts), LOWER)][0]
    single = [x for s in slices(pa.array(texts), LOWER, max_bytes=50) for x in J.shingles(s)]
    assert all(np.array_equal(a, b) for a, b in zip(whole, single)) and len(whole) == len(single)


def test_null_and_repeated_ids_and_empty_table(spark):
    t = "one two three four five six seven eight nine ten"
    df = spark.createDataFrame([(None, t), (3, t), (3, t), (4, None), (None, None)], "doc_id long, text string")
    assert J.jaccard_join(df)[0].count() == 5
    out, links, classes = J.jaccard_join(df.where("false"))
    assert out.count() == links.count() == classes.count() == 0


def test_links_are_complete(spark, monkeypatch):
    """Families of variants: every pair that links comes back, also over several blocks; the shortcut gives the same components."""
    monkeypatch.setattr(J, "BLOCK", 8)
    rng = random.Random(9)
    rows = []
    for family in range(4):
        base = [f"f{family}w{i}" for i in range(120)]
        for i in range(30):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(120)] = f"x{rng.randrange(1000)}"
            rows.append((family * 100 + i, " ".join(w[:rng.randrange(100, 121)])))
    sets = {i: {tuple(t.split()[j:j + 5]) for j in range(len(t.split()) - 4)} for i, t in rows}
    first = {}
    for i in sorted(sets):
        first.setdefault(frozenset(sets[i]), i)
    ids = sorted(first.values())
    want = {(a, b) for a in ids for b in ids if a < b and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])}
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    out, links, _ = J.jaccard_join(df)
    got = [tuple(r) for r in links.select("a", "b").collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 4 * 30
    for few in (8, 0):      # 0: members of other components are joined by forests first
        monkeypatch.setattr(J, "FEW", few)
        assert sorted(out.collect()) == sorted(J.jaccard_join(df, complete=False)[0].collect())


@pytest.mark.parametrize("few", [0, 8])
def test_families_that_hang_together_by_chains(spark, monkeypatch, few):
    """Each variant is near its neighbours alone, many share most signatures, and some hang on nothing."""
    monkeypatch.setattr(J, "FEW", few)
    monkeypatch.setattr(J, "BLOCK", 8)
    rng = random.Random(2)
    base, rows = [f"w{i}" for i in range(200)], []
    for i in range(60):
        w = list(base)
        for j in range(0, 4 * (i % 20), 4):
            w[(j * 7) % 200] = f"v{j}"          # the further apart, the more of them differ
        rows.append((i, " ".join(w)))
    rows += [(100 + i, " ".join(base[:100] + rng.choices([f"z{j}" for j in range(5000)], k=60))) for i in range(40)]
    want = brute(rows)
    got = {tuple(r) for r in J.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), complete=False)[0].collect()}
    assert got == want and len({c for _, _, c in want}) > 30


@pytest.mark.parametrize("block, listed", [(1024, 16), (8, 16), (8, 2), (1024, 1)])
def test_pairs_that_meet_in_many_groups_are_handed_on_about_once(spark, monkeypatch, block, listed):
    """Members of many groups, some rows of one id with other sets: every pair comes, most of them from one group."""
    monkeypatch.setattr(J, "BLOCK", block)
    monkeypatch.setattr(J, "LISTED", listed)
    rng = random.Random(block + listed)
    rows, meet = [], set()
    bits = {(i, v): np.array([1 << (i % 3)] + [0] * 7 if v == 0 else [(1 << 64) - 1] * 8, np.uint64).tobytes() for i in range(30) for v in (0, 1)}
    for g in range(-10, 10):
        inside = [(i, v) for i in range(30) for v in ((0, 1) if i == 7 else (0,)) if rng.random() < 0.9]
        rows += [(g * 10 ** 17, i, 20, bits[i, v], i) for i, v in inside]
        meet |= {(min(a, b), max(a, b)) for a, v in inside for b, w in inside if a != b and v == w}
    df = spark.createDataFrame(rows, "gid long, id long, n int, bits binary, component long").repartition(3)
    got = [tuple(r) for r in J.across(J.in_blocks(df)).collect()]
    assert set(got) == meet and len(meet) == 435
    if listed == 16:
        assert len(got) == len(meet)        # one row a group before: about 16 times as many
    else:
        assert len(got) < 20 * len(meet)


def test_a_family_is_joined_without_all_its_pairs(spark, monkeypatch):
    """Variants of one text that link with a few others each: the pairs that are verified don't grow with all links."""
    monkeypatch.setattr(J, "FEW", 8)
    monkeypatch.setattr(J, "BLOCK", 128)
    rng = random.Random(3)
    rows, tried, verify = [], [], J.verify
    for i in range(600):
        w = [f"w{j}" for j in range(110)]
        for j in rng.sample(range(110), 2):
            w[j] = f"v{i}at{j}"         # links with those that were changed at one of the two places, few others
        rows.append((i, " ".join(w)))

    def counted(pairs, *more):
        tried.append(pairs.count())
        return verify(pairs, *more)

    monkeypatch.setattr(J, "verify", counted)
    got = {tuple(r) for r in J.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string").repartition(4), complete=False)[0].collect()}
    assert got == brute(rows)
    assert sum(tried) < 4 * len(rows), tried


def test_forests_join_what_a_block_holds(spark):
    """Bitmaps of two lengths, some rows of one component: no pair too many, all that may link hang together; members of
    several groups stand in one of them."""
    rng = np.random.default_rng(4)
    rows, base = [], rng.integers(0, 1 << 63, 300, dtype=np.int64).astype(J.U)
    for i in range(60):
        size = 250 + i % 14             # over 256 shingles the bitmap is twice as long
        x = np.concatenate([base[:size], rng.integers(0, 1 << 63, i % 20, dtype=np.int64).astype(J.U)]) if i else lone_set(rng)
        rows.append((7, i, len(x), J.parity_bitmaps([x])[0], i // 6 if i else 99))
    df = spark.createDataFrame(rows, "gid long, id long, n int, bits binary, component long").repartition(3)
    assert {len(r[3]) for r in rows} == {64, 128}
    got = [tuple(r) for r in J.forests(df, 0).collect()]
    root = {r[1]: r[4] for r in rows}
    for a, b in got:
        x, y = (np.frombuffer(rows[i][3], J.U).reshape(1, -1) for i in (a, b))
        assert a < b and root[a] != root[b] and J.may_link(x, rows[a][2], y, np.array([rows[b][2]]))[0]
        root = {i: root[b] if root[i] == root[a] else root[i] for i in root}
    assert len(got) == 9 and len(set(root.values())) == 2       # ten components that are one, and the lone set
    several = df.unionByName(df.where("id % 3 > 0").selectExpr("gid + 1 AS gid", "id", "n", "bits", "component"))
    for turn in range(3):
        assert 0 < J.forests(several, turn).count() <= 20


def lone_set(rng):
    return rng.integers(0, 1 << 63, 260, dtype=np.int64).astype(J.U)


@pytest.mark.parametrize("ready", [True, False])
def test_components_of_chains_stars_and_none(spark, ready):
    from vitalspark.llm.components import components
    rng = random.Random(4)
    names = rng.sample(range(1000), 300)
    edges = [(names[i], names[i + 1]) for i in range(0, 120)] + [(names[150], names[i]) for i in range(151, 200)] + [(names[i], names[i + 1]) for i in range(200, 300, 2)]
    edges = [(min(e), max(e)) for e in edges]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    df = spark.createDataFrame(edges + edges[:5], "a long, b long")
    assert {tuple(r) for r in components(df, ready=ready).collect()} == {(x, root(x)) for x in parent}
    assert components(df.where("false"), ready=ready).count() == 0
