"""The similarity join, the best k, and segments, against brute force."""

from __future__ import annotations

import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from casebook.operators import relational as R
from casebook.operators import search as fts
from casebook.operators import segments

SMALL = "/root/testdata/sf0.01"


def similar(left, right, least):
    words = lambda x: set(re.findall("[a-z0-9]+", (x or "").lower()))
    out = []
    for a, x in left:
        for b, y in right:
            if (p := words(x)) and (q := words(y)) and (s := round(len(p & q) / len(p | q), 6)) >= least:
                out.append((a, b, s))
    return sorted(out)


@pytest.mark.parametrize("least", [0.05, 0.5, 0.8, 1.0])
def test_similar_pairs_as_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(R, "WORD_ROWS", 7)
    rng = random.Random(4)
    word = lambda: f"w{int(rng.paretovariate(0.6)) % 400}"
    side = lambda n: [(i, " ".join(["the", "bill", *(word() for _ in range(rng.choice([0, 2, 5, 9, 20])))])) for i in range(n)]
    left, right = side(90), side(70)
    left += [(i, x) for i, (_, x) in enumerate(right[:30], 200)] + [(300, None), (301, ""), (302, " .,-"), left[3], left[3]]
    right += [(400, None), (401, "..."), right[5]]
    kinds = ("k long, t string", "o long, u string")
    got = R.similar_pairs(spark.createDataFrame(left, kinds[0]), spark.createDataFrame(right, kinds[1]), "k", "o", "t", "u", least)
    assert sorted(map(tuple, got.collect())) == similar(left, right, least)


def test_candidates_are_few(spark):
    """Word sets that share frequent words alone are never paired."""
    left = spark.createDataFrame([(i, f"a bill to amend the law of trade a{i} b{i} c{i}") for i in range(300)], "k long, t string")
    right = spark.createDataFrame([(i, f"second reading of a bill to amend the law of trade a{i} b{i} c{i}") for i in range(300)], "o long, u string")
    (_, a), (_, b) = R._word_classes(left, "k", "t"), R._word_classes(right, "o", "u")
    assert R.candidate_classes(*R.word_prefixes(a, b, 0.7), 0.7).count() == 300
    assert R.similar_pairs(left, right, "k", "o", "t", "u", 0.7).count() == 300


def plain(index, query, k):
    return [(r.id, round(r.score, 9)) for r in fts.bm25(index, query).orderBy(F.round("score", 9), "id").limit(k).collect()]


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    return fts.build(docs, "doc_id", ["text"]).written(str(tmp_path_factory.mktemp("index")))


@pytest.mark.parametrize("query", ["the", "the tion", "tion OR des OR los", "license", "absentword", "the absentword", "the OR absentword"])
def test_best_as_all_scores(index, query):
    for first in (1, 8):
        got = fts.best(index, query, 20, first=first, growth=2)
        rows = [(r.id, round(r.score, 9)) for r in got.hits.orderBy(F.round("score", 9), "id").limit(20).collect()]
        assert rows == plain(index, query, 20)


def test_best_of_some_and_ties(spark, tmp_path):
    docs = spark.createDataFrame([(i, "one two" if i % 3 else "one two two three") for i in range(400)], "id long, text string")
    index = fts.build(docs, "id", ["text"]).written(str(tmp_path / "i"))
    allowed = docs.where("id % 7 = 0").select("id")
    got = fts.best(index, "two", 10, allowed, first=1, growth=2)
    assert {r.id for r in got.hits.collect()} >= {i for i in range(0, 400, 21)} and got.hits.where("id % 7 <> 0").isEmpty()
    page = fts.search(docs, index, "two", "id", [F.col("id") % 7 == 0], 10)
    assert [r.id for r in page.collect()] == list(range(0, 210, 21))
    assert fts.search(docs.limit(0), index, "two", "id").isEmpty() and fts.best(index, "two NOT one", 5) is None
    assert fts.best(index, '"one two"', 5) is None and fts.best(index, "tw*", 5) is None


def test_few_postings_are_read(spark, tmp_path):
    """Of a list of 6,000 rows, a tenth at most is read for the best 10."""
    rng = random.Random(9)
    docs = spark.createDataFrame([(i, "the " * rng.randint(1, 12) + "x " * rng.randint(1, 300)) for i in range(6000)], "id long, text string")
    index = fts.build(docs.unionByName(spark.createDataFrame([(i, "other") for i in range(6000, 20000)], "id long, text string")), "id", ["text"]).written(str(tmp_path / "i"))
    got = fts.best(index, "the", 10)
    assert got.listed == 6000 and got.read < 600
    assert [(r.id, round(r.score, 9)) for r in got.hits.orderBy(F.round("score", 9), "id").limit(10).collect()] == plain(index, "the", 10)


def test_segments_as_one_index(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(segments, "FAN", 3)
    rng, path, now = random.Random(5), str(tmp_path / "s"), {}
    text = lambda: " ".join(rng.choice(["bill", "act", "law", "court", "trade", f"w{rng.randrange(50)}"]) for _ in range(rng.randrange(12)))
    with pytest.raises(FileNotFoundError):
        segments.opened(spark, path)
    for turn in range(5):
        batch = {rng.randrange(60): text() for _ in range(3 if turn % 2 else 25)}
        now |= batch
        segments.upsert(spark.createDataFrame(list(batch.items()), "id long, text string"), path, "id", ["text"])
        index = segments.opened(spark, path)
        whole = fts.build(spark.createDataFrame(list(now.items()), "id long, text string"), "id", ["text"]).written(str(tmp_path / f"w{turn}"))
        assert index.stats().first()["docs"] == len(now) and index.lengths.count() == len(now)
        for query in ("bill law", '"bill law"', "act NOT court"):
            assert plain(index, query, 100) == plain(whole, query, 100), (turn, query)
        got = fts.best(index, "bill OR trade", 5, first=1, growth=2).hits
        assert [(r.id, round(r.score, 9)) for r in got.orderBy(F.round("score", 9), "id").limit(5).collect()] == plain(whole, "bill OR trade", 5)
    assert len(segments.manifest(spark, path)[1]) < 5
    version = segments.manifest(spark, path)[0]
    assert segments.upsert(spark.createDataFrame([], "id long, text string"), path, "id", ["text"]) == version
    twice = spark.createDataFrame([(1, "bill", 1), (1, "unique", 2)], "id long, text string, at int")
    with pytest.raises(ValueError, match="differ"):
        segments.upsert(twice, path, "id", ["text"])
    segments.upsert(twice, path, "id", ["text"], [F.col("at").desc()])
    assert [r.id for r in fts.bm25(segments.opened(spark, path), "unique").collect()] == [1]


@pytest.mark.parametrize("held, hits", [(0, 1), (10_000, 1), (10_000, 3000)])
def test_similar_pairs_by_either_way(spark, monkeypatch, held, hits):
    """A right side that tasks hold, a few of the left's rows at once or all, and one that is joined: as brute force."""
    monkeypatch.setattr(R, "HELD_WORDS", held)
    monkeypatch.setattr(R, "HITS", hits)
    rng = random.Random(8)
    side = lambda n: [(f"k{i}", " ".join(f"W{int(rng.paretovariate(0.7)) % 60}" for _ in range(rng.choice([0, 1, 4, 12])))) for i in range(n)]
    left, right = [*side(60), ("n", None)], [*side(40), ("n", None), ("e", "..."), ("x", "w1, w2")]
    left, right = [*left, left[7], left[7]], [*right, right[5]]
    make = lambda rows, names: spark.createDataFrame(rows, names)
    for least in (0.05, 0.333333, 1.0):
        got = R.similar_pairs(make(left, "k string, t string"), make(right, "o string, u string"), "k", "o", "t", "u", least)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(similar(left, right, least), key=str)
    assert R.similar_pairs(make([], "k string, t string"), make(right, "o string, u string"), "k", "o", "t", "u", 0.5).count() == 0
    assert R.similar_pairs(make(left, "k string, t string"), make([], "o string, u string"), "k", "o", "t", "u", 0.5).count() == 0


def test_few_rows_on_the_right_shuffle_no_words(spark):
    """The left's texts are dealt out once; neither words nor pairs are shuffled."""
    from casebook import queries

    plan = queries.parent_intent_pairs(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_stems_are_made_once_for_each_distinct_word(spark, monkeypatch):
    """A batch's words are stemmed as a vocabulary, in one column of arrays; texts are cut and folded as before."""
    from casebook.functions import text as T

    texts = ["Licensed works, licensing WORKS!", None, "", "ﬁne ½x² İstanbul Straße éa_b x\x85y Ⅻ ①", "áb̧ c", "ponies caresses cats sky skies"]
    got = spark.createDataFrame(list(enumerate(texts)), "i int, t string").coalesce(1).select("i", T.stemmed_terms(F.col("t")).alias("s"))
    assert [r["s"] for r in sorted(got.collect())] == [T.terms(x) for x in texts]
    assert T.terms(texts[0]) == ["licens", "work", "licens", "work"] and T.terms(texts[5]) == ["poni", "caress", "cat", "sky", "ski"]
    assert T.terms(texts[3], False) == ["fine", "1", "2x2", "istanbul", "straße", "ea", "b", "x", "y", "xii", "1"]
    # a character's category is asked for once, not for each place that has it
    asked = []
    counted = type("Counted", (), {"normalize": staticmethod(unicodedata.normalize), "category": staticmethod(lambda c: (asked.append(c), unicodedata.category(c))[1])})
    monkeypatch.setattr(T, "unicodedata", counted)
    assert T.terms("é" * 1000, False) == ["e" * 1000] and sorted(asked) == ["e", "\u0301"]
