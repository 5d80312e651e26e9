from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from casebook.llm import graph, jaccard
from casebook.llm.common import table

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = SPACE.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 4]) for i in range(max(1, len(w) - 3))} if w else set()


def brute(docs):
    """By doc_id: set size, least reachable doc_id."""
    sets = [(k, shingles(t)) for k, t in docs]
    root = {k: k for k, _ in docs}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 85 * len(x | y):
                lo, hi = sorted((find(a), find(b)))
                root[hi] = lo
    return {k: (len(s), find(k)) for k, s in sets}


def corpus(seed: int, n: int) -> list[tuple[int, str | None]]:
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(4000)}"
    passage = [word() for _ in range(60)]
    bases = [[word() for _ in range(rng.choice([3, 4, 5, 8, 30, 120]))] for _ in range(n // 8)]
    docs: list[tuple[int, str | None]] = [(1000, None), (1001, ""), (1002, " \t "), (1003, "A B"), (1004, "a b"), (1005, "a b c d"), (1006, "a b c d")]
    for i in range(n):
        w = list(rng.choice(bases))
        for _ in range(rng.randrange(4) if len(w) > 20 else 0):
            w[rng.randrange(len(w))] = word()
        if rng.random() < 0.3:
            w = passage + w
        docs.append((i, " ".join(w)))
    return docs


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    docs = corpus(seed, 160)
    got = jaccard.join(spark.createDataFrame([(k, t, 7) for k, t in docs], "doc_id long, text string, n long").repartition(3)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs)


def test_a_large_group_of_near_copies(spark):
    rng = random.Random(3)
    base = [f"b{i}" for i in range(60)]
    docs = []
    for i in range(250):
        w = list(base)
        w[rng.randrange(60)] = f"x{rng.randrange(40)}"  # two copies may be too far apart, yet linked through others
        docs.append((i, " ".join(w)))
    got = jaccard.join(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(docs)


def test_far_copies_make_few_pairs(spark, monkeypatch):
    """Copies with three edits are too far from most of their group, and link with a few that share an edit."""
    rng = random.Random(4)
    base, docs = [f"b{i}" for i in range(150)], []
    for i in range(500):
        w = list(base)
        for at in sorted(rng.sample(range(150), rng.choice([1, 2, 3, 3])), reverse=True):
            del w[at]
        docs.append((i, " ".join(w)))
    seen, bounded = [], jaccard.bounded
    monkeypatch.setattr(jaccard, "bounded", lambda pairs, *rest: (seen.append(pairs.count()), bounded(pairs, *rest))[1])
    got = jaccard.join(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(docs)
    assert sum(seen) < 10 * len(docs) and seen[-1] < len(docs), seen


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 3000), st.integers(0, 3000), st.integers(0, 3000))
def test_parities_bound_the_difference(seed, both, one, other):
    """Never more parities differ than shingles do."""
    x = np.unique(np.random.default_rng(seed).integers(0, 1 << 63, both + one + other).astype(np.uint64))
    a, b = x[: both + one], np.concatenate([x[:both], x[both + one :]])
    differ = int(np.bitwise_count((jaccard.parities(a) ^ jaccard.parities(b)).view(np.uint64)).sum())
    n = len(a) + len(b) - 2 * len(np.intersect1d(a, b))
    assert len(jaccard.parities(a)) == jaccard.PARITIES and differ <= n and differ % 2 == n % 2


def test_chains_need_later_rounds(spark):
    docs = [(i, " ".join(f"c{j}" for j in range(3 * i, 3 * i + 60))) for i in range(40)]
    got = jaccard.join(spark.createDataFrame(docs, "doc_id long, text string"))
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got.collect()} == brute(docs)


def test_on_documents(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    got = jaccard.join(docs).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute([(r.doc_id, r.text) for r in docs.collect()])


def test_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame([(1, "a b c d e"), (1, "a b c d e"), (1, "z"), (2, "A B C D E"), (None, "a b c d e"), (3, None)], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id) for r in jaccard.join(docs).collect())
    assert got == [(0, 2, None), (1, 1, 1), (1, 2, 1), (1, 2, 1), (2, 2, 1), (3, 0, 3)]
    assert sorted(r.doc_id or 0 for r in jaccard.select(docs).collect()) == [0, 1, 3]
    assert jaccard.join(docs.limit(0)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 300), st.integers(50, 95), st.booleans())
def test_product_of_a_tile(seed, n, least, narrow):
    """Against sets; narrow hashes leave some blocks of columns empty."""
    rng = np.random.default_rng(seed)
    pool = rng.integers(0, 2**50 if narrow else 2**64, 400, np.uint64)
    a = np.unique(rng.choice(pool, n))
    rows = [np.unique(np.concatenate([a[rng.random(len(a)) > cut], rng.choice(pool, rng.integers(0, 40))])) for cut in rng.random(30) * 0.4]
    rows = [x for x in rows if len(x)] + [a]
    want = [100 * len(np.intersect1d(a, x)) >= least * len(np.union1d(a, x)) for x in rows]
    assert jaccard.product(a, rows, least).tolist() == want


def test_tiles_split_hot_rows(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TILE", 8)
    pairs = spark.createDataFrame([(1, b, 1, b) for b in range(2, 100)] + [(2, 3, 2, 3)], "a long, b long, ca long, cb long")
    rows = jaccard.tiles(pairs).collect()
    assert sorted((r.a, r.b) for r in rows) == sorted([(1, b) for b in range(2, 100)] + [(2, 3)])
    sizes = [sum((x.a, x.part) == (r.a, r.part) for x in rows) for r in rows]
    assert max(sizes) < 30 and len({r.part for r in rows if r.a == 1}) > 8


def test_one_document_id_with_many_rows(spark):
    docs = spark.range(3000).selectExpr("5 AS doc_id", "'a b c d e f g h i j k l m n o p q r s t u v w x y z' AS text").union(spark.sql("SELECT 7, 'a b c d e f g h i j k l m n o p q r s t u v w x y Z'")).union(spark.sql("SELECT 9, 'a b c d e f g h i j k l m n o p q r s t u v w x y z 1'"))
    got = jaccard.join(docs).groupBy("doc_id", "component_id").count().collect()
    assert sorted(map(tuple, got)) == [(5, 5, 3000), (7, 5, 1), (9, 5, 1)]


def test_very_long_texts(spark):
    words = [f"v{i}" for i in range(60_000)]
    docs = spark.createDataFrame([(1, " ".join(words)), (2, " ".join([*words[:30_000], "other", *words[30_000:]])), (3, " ".join(words[:40_000]))], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in jaccard.join(docs).collect()} == {1: 1, 2: 1, 3: 3}


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(40)]
    root = {x: x for e in edges for x in e}
    for _ in range(60):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.comp for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {k: v for k, v in root.items() if k != v}


def test_giant_sets_are_never_discarded(spark):
    giant = jaccard.block_sizes(np.arange(70_000, dtype=np.uint64))  # over 16 bits in one block
    small, far = jaccard.block_sizes(np.arange(9, dtype=np.uint64)), jaccard.block_sizes(np.arange(9, dtype=np.uint64) << np.uint64(60))
    classes = spark.createDataFrame([(1, giant), (2, giant), (3, small), (4, far)], "node long, blocks binary")
    pairs = spark.createDataFrame([(a, b, a, b) for a, b in ((1, 2), (1, 3), (3, 4), (3, 3))], "a long, b long, ca long, cb long")
    for least in (80, 85):
        assert {(r.a, r.b) for r in jaccard.bounded(pairs, classes, least).collect()} == {(1, 2), (1, 3), (3, 3)}


def test_documents_of_several_texts(spark):
    """Rows of one doc_id are one document: what links with any of its texts is reached."""
    rng = random.Random(8)
    a, b, c = (" ".join(f"{x}{rng.randrange(9999)}" for _ in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (7, c), (9, c + " z"), (9, "other words than these are here"), (9, c + " z"), (4, ""), (5, None), (6, "alone")]
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == sorted((k, {2: 1, 3: 1, 9: 7}.get(k, k)) for k, _ in rows)
    kept = jaccard.select(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5, 6, 7]


def test_word_hashes():
    """Equal words have equal hashes wherever they stand, in texts longer than the kept powers too; others differ."""
    s = jaccard.Shingler()
    rng = random.Random(6)
    words = list({"".join(rng.choice("abAB\x00\x01é汉") for _ in range(rng.randrange(1, 7))) for _ in range(3000)})
    h = s.hashes(" ".join(words)).tolist()
    assert len(set(h)) == len({w.translate(LOWER) for w in words})
    long = " \t".join(words * 30)
    assert len(long.encode()) > jaccard.KEPT and s.hashes(long).tolist() == h * 30 and len(s.powers) == jaccard.KEPT + 1
    huge = "x" * (jaccard.KEPT + 5)
    assert len(set(s.hashes(f"a {huge} b {huge}").tolist())) == 3
    assert len(s.hashes(None)) == len(s.hashes(" \n")) == 0
