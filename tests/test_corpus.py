from __future__ import annotations

import random
import sqlite3

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__
from casebook import api, schema
from casebook.functions import html, text, urn
from casebook.operators import relational, search, temporal
from casebook.plans import debates
from casebook.sources import store

SMALL = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages benchmark labels conversations".split()


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


# ---- Every registered query against its SQL


@pytest.mark.parametrize("name", sorted(set(__spark_entry__.corpus.ORACLE_SQL)))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for x in TABLES:
        con.execute(f"CREATE VIEW {x} AS SELECT * FROM read_parquet('{SMALL}/{x}.parquet')")
    df = __spark_entry__.queries()[name](spark, SMALL)
    cols = sorted(df.columns)
    shown = lambda v: f"{v:.6g}" if isinstance(v, float) else str(v)
    got = sorted(tuple(shown(r[c]) for c in cols) for r in df.collect())
    cur = con.execute(__spark_entry__.oracle_sql()[name])
    names = [x[0] for x in cur.description]
    want = sorted(tuple(shown(dict(zip(names, r))[c]) for c in cols) for r in cur.fetchall())
    assert got == want


# ---- Identifiers


@pytest.mark.parametrize("u", ["urn:sg:act:PC1871", "urn:sg:act:PC1871:s300-1-a@2020-01-01", "urn:sg:sl:S1-2020:r2", "urn:sg:judgment:2024_SGCA_15:para7", "urn:sg:hansard:2024-02-06:s1:sp2"])
def test_urn_round_trip(spark, u):
    assert one(spark, urn.render(urn.parse(F.lit(u)))) == u and one(spark, schema.valid_urn(F.lit(u)))


@pytest.mark.parametrize("u", ["", "urn:xx:act:1", "urn:sg:act:", "urn:sg:hansard:x@2020-01-01", "urn:sg:act:a b", "urn:sg:act:x@2020-02-31"])
def test_urn_rejects(spark, u):
    assert not one(spark, schema.valid_urn(F.lit(u))) and one(spark, urn.parse(F.lit(u))) is None


def test_urn_forms(spark):
    assert one(spark, urn.from_neutral_citation(F.lit("[2021] SGPDPC 4 (NFA)"), "pdpc")) == "urn:sg:pdpc:2021_SGPDPC_4_NFA"
    assert one(spark, urn.to_citation(F.lit("urn:sg:pdpc:2021_SGPDPC_4_NFA"))) == "[2021] SGPDPC 4 (NFA)"
    assert one(spark, urn.to_citation(F.lit("urn:sg:judgment:2024_SGCA_15:para7"))) == "[2024] SGCA 15 at [7]"
    assert one(spark, urn.child(F.lit("urn:sg:act:X@2020-01-01"), F.lit("s1"))) == "urn:sg:act:X:s1@2020-01-01"
    assert one(spark, urn.at(F.lit("urn:sg:hansard:x"), F.lit("2020-01-01").cast("date"))) is None
    assert one(spark, urn.provisional_decision(F.lit("A & B Ltd."))) == "urn:sg:pdpc:x-a-b-ltd"
    assert one(spark, urn.provisional_decision(F.lit("!!"))) is None


# ---- Text


@pytest.mark.parametrize(("summary", "types", "want"), [
    ("a financial penalty of $5,000 was imposed", [], (5000, "$5,000", None)),
    ("penalty of $5,000 and $2,000", [], (7000, "$5,000 and $2,000", None)),
    ("penalty of $5,000.50; a warning", [], (0, None, "warning")),
    ("no further action", [], (0, None, "nfa")), ("not in breach", [], (0, None, "no_breach")),
    ("directions were issued", [], (0, None, "directions_only")), ("x", ["Directions"], (0, None, "directions_only")),
    ("warning", ["Financial Penalty"], (None, None, None)),
])
def test_penalty(spark, summary, types, want):
    p = one(spark, text.penalty(F.lit(summary), F.array(*map(F.lit, types)).cast("array<string>")))
    assert tuple(p) == want


@pytest.mark.parametrize(("label", "want"), [
    ("The Minister for Law (Mr A B):", ("Mr A B", "The Minister for Law", None)), ("Mr Lim (Aljunied)", ("Mr Lim", None, "Aljunied")),
    ("Ms Tan (Senior Minister of State)", ("Ms Tan", "Senior Minister of State", None)), ("Mr X", ("Mr X", None, None)), ("", (None, None, None)),
])
def test_attribution(spark, label, want):
    assert tuple(one(spark, text.split_attribution(F.lit(label)))) == want


def test_cleaning_and_counsel(spark):
    assert one(spark, text.clean(F.lit("a&amp;b  c\n"))) == "a&b c"
    assert one(spark, text.clean(F.lit(None).cast("string"))) == ""
    c = one(spark, text.counsel(F.lit("A B (Firm LLC) and C (D & Co) for the appellant.")))
    assert (c.side, c.firms) == ("the appellant", ["Firm LLC", "D & Co"])
    assert one(spark, text.obligations(F.lit("breach of the protection and consent obligations"))) == ["Consent", "Protection"]


# ---- Search against SQLite's own index


def fts5(rows, tokenizer):
    con = sqlite3.connect(":memory:")
    con.execute(f"CREATE VIRTUAL TABLE f USING fts5(title, body, tokenize='{tokenizer}')")
    con.executemany("INSERT INTO f(rowid, title, body) VALUES (?, ?, ?)", rows)
    return con


WORDS = "run running runner connection connected relational hopping happy happily ponies agreed plastered fees trouble conditional café naïve sky generalizations oscillators".split()


def test_porter_equals_sqlite():
    con = fts5([(i, w, "") for i, w in enumerate(WORDS)], "porter unicode61 remove_diacritics 2")
    con.execute("CREATE VIRTUAL TABLE v USING fts5vocab(f, instance)")
    assert {doc: term for term, doc, *_ in con.execute("SELECT * FROM v")} == {i: text.terms(w)[0] for i, w in enumerate(WORDS)}


QUERIES = ["run", "run AND happy", "run happy", "run OR sky", "happy NOT run", '"happy run"', "connect*", "title : run", "(run OR sky) AND happy", "NEAR(run sky, 2)", '"run" + "sky"']


@pytest.mark.parametrize("stem", [False, True])
def test_search_equals_sqlite(spark, stem):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choices(WORDS, k=3)), " ".join(rng.choices(WORDS[:12] + ["sky", "happy", "run"], k=rng.randrange(1, 30)))) for i in range(60)]
    con = fts5(rows, ("porter " if stem else "") + "unicode61 remove_diacritics 2")
    index = search.build(spark.createDataFrame(rows, "id long, title string, body string"), "id", ["title", "body"], stem)
    index.postings = index.postings.cache()
    for q in QUERIES:
        want = dict(con.execute("SELECT rowid, bm25(f) FROM f WHERE f MATCH ?", (q,)).fetchall())
        got = {r.id: r.score for r in search.bm25(index, q).collect()}
        assert got.keys() == want.keys(), q
        if "NEAR" not in q and not {"NOT", "OR"} & set(q.split()):  # NEAR scores count occurrences out of the span too
            assert got == pytest.approx(want), q


@pytest.mark.parametrize("q", ["", "s 157(1)", "data-breach", "[2024]", "(a", "AND a", 'a "'])
def test_malformed_queries(q):
    with pytest.raises(search.MatchError):
        search.parse(q)


def test_snippet(spark):
    words = " ".join(f"w{i}" for i in range(50)) + " the License text " + " ".join(f"v{i}" for i in range(50))
    out = one(spark, search.snippet(F.lit(words), ["license"]))
    assert "<<License>>" in out and out.startswith(" ... ") and len(out.split()) <= 26


# ---- Time


def test_as_of_boundary(spark):
    docs = spark.createDataFrame([("urn:sg:act:P:s15@2021-01-02", "urn:sg:act:P:s15", "2021-01-02", "2021-02-01", "old"), ("urn:sg:act:P:s15", "urn:sg:act:P:s15", "2021-02-01", None, "new")], "urn string, canonical_urn string, f string, t string, text string")
    docs = docs.selectExpr("urn", "canonical_urn", "to_date(f) AS in_force_from", "to_date(t) AS in_force_to", "text")
    get = lambda d: api.get_provision(docs, "urn:sg:act:P:s15", d).collect()
    assert get("2021-01-31")[0].text == "old" and get("2021-02-01")[0].text == "new"
    assert {r.error for r in get("2010-01-01")} == {"not_in_force"}
    assert api.get_provision(docs, "urn:sg:act:P").first().error == "invalid_argument"
    assert api.get_provision(docs, "urn:sg:act:P:s15@2021-01-02", "2020-01-01").first().error == "invalid_argument"
    assert api.get_provision(docs.union(docs), "urn:sg:act:P:s15", "2021-03-01").first().error == "ambiguous_version"


def test_intervals_by_month(spark):
    v = spark.sql("SELECT DATE'2020-01-15' AS s, DATE'2020-03-01' AS e")
    assert [str(r.bucket) for r in temporal.by_month(v, "s", "e", F.current_date()).collect()] == ["2020-01-01", "2020-02-01"]


# ---- Sequences


def test_printed_sequence_against_brute_force():
    rng = random.Random(0)
    for _ in range(300):
        rows = [((rng.randrange(6), ""), rng.randrange(2)) for _ in range(rng.randrange(1, 9))]
        runs = [[i for i in range(len(rows)) if m >> i & 1] for m in range(1, 1 << len(rows))]
        runs = [r for r in runs if all(rows[a][0] < rows[b][0] for a, b in zip(r, r[1:]))]
        top = max((len(r), sum(rows[i][1] for i in r)) for r in runs)
        best = [r for r in runs if (len(r), sum(rows[i][1] for i in r)) == top]
        assert relational.printed_sequence(rows) == (best[0] if len(best) == 1 else None)


def test_chunks(spark):
    rows = spark.createDataFrame([("a", i, n) for i, n in enumerate([30, 40, 40, 90, 10, 10])], "k string, i long, n long")
    assert [r.chunk for r in relational.chunk_by_budget(rows, "k", "i", "n", 100).orderBy("i").collect()] == [0, 0, 1, 2, 2, 3]


# ---- Debates


def test_debate_blocks(spark):
    page = "<p>2.20 pm</p><p><strong>Mr Lim (Aljunied)</strong>: I rise.</p><p>More of it, <strong>really</strong>.</p><div><p>Ms Tan: No.</p></div><p>23 Mr Yip Hon Weng asked the Prime Minister whether so.</p>"
    assert [b["text"] for b in html.blocks_of(page)][:2] == ["2.20 pm", "Mr Lim (Aljunied) : I rise."]
    secs = spark.createDataFrame([("urn:sg:hansard:2024-02-06:s0", 0, "OS", None, page)], "urn string, idx int, section_type string, section_question long, content string").withColumn("day", F.lit("2024-02-06").cast("date"))
    rows = debates.speeches(secs).orderBy("speech_index").collect()
    assert [(r.speaker, r.constituency, r.question_no) for r in rows] == [(None, None, None), ("Mr Lim", "Aljunied", None), ("Ms Tan", None, None), ("Mr Yip Hon Weng", None, "23")]
    assert rows[1].text == "I rise.\n\nMore of it, really ."[:7] + rows[1].text[7:] and "More of it" in rows[1].text
    assert rows[3].is_question and rows[3].urn == "urn:sg:hansard:2024-02-06:s0:sp3"


# ---- Stores


def test_snapshots_and_checkpoints(spark, tmp_path):
    rows = spark.sql("SELECT * FROM VALUES (binary('a'), timestamp'2020-01-02', 'u2'), (binary('a'), timestamp'2020-01-01', 'u1'), (binary('b'), timestamp'2020-01-01', 'u3') AS t(body, retrieved_at, url)")
    new = store.new_snapshots(rows, spark.createDataFrame([], "sha256 string"))
    assert {r.url for r in new.collect()} == {"u1", "u3"}
    store.write_snapshots(new, str(tmp_path / "s"))
    assert store.new_snapshots(rows, spark.read.parquet(str(tmp_path / "s"))).count() == 0
    (tmp_path / "c.jsonl").write_text('{"key": "a", "at": "2020-01-01T00:00:00Z"}\n{"key": "b"\n')
    done = store.read_checkpoint(spark, str(tmp_path / "c.jsonl"))
    assert [r.key for r in done.collect()] == ["a"]
    assert [r.key for r in store.mark(done, spark.createDataFrame([("a",), ("c",), ("c",)], "key string")).collect()] == ["c"]


def test_streaming_once(spark, tmp_path):
    from casebook.streaming import incremental

    spark.createDataFrame([("a", 1), ("b", 1), ("a", 2)], "key string, n int").coalesce(1).write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        units = incremental.read_stream(spark, str(tmp_path / "in"), "key string, n int")
        incremental.ingest_once(units, str(tmp_path / "out"), str(tmp_path / f"ck{_}")).awaitTermination(60)
    assert sorted(r.key for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["a", "b"]


def test_decisions_tool(spark):
    docs = spark.createDataFrame([("u1", "pdpc", "c1", 100, ["Consent"]), ("u2", "pdpc", "c1", 100, ["Consent"]), ("u3", "pdpc", None, 50, ["Protection"]), ("u4", "pdpc", "c2", 1, ["Consent"]), ("u5", "pdpc", "c2", None, ["Consent"])], "urn string, corpus string, canonical_urn string, penalty_sgd long, obligations array<string>").withColumn("issued", F.lit("2020-01-01").cast("date"))
    page, totals = api.decisions(docs, obligation=["Consent"])
    assert page.count() == 4 and tuple(totals.first()) == (2, 100, 1, 4)
    page, totals = api.decisions(docs, penalty_min=1000)
    assert page.count() == 0 and tuple(totals.first()) == (0, None, None, 0)


def test_intent_chain(spark):
    docs = [
        ("urn:sg:act:A1", "act", "A Act", None, None), ("urn:sg:act:A1:s1", "act", "s 1", "urn:sg:act:A1", None), ("urn:sg:act:A1:s2", "act", "s 2", "urn:sg:act:A1", None),
        ("urn:sg:bill:2020:7", "bill", "Data Safety (Amendment) Bill", None, None), ("urn:sg:bill:2012:2", "bill", "Data Safety Bill", None, None),
        ("urn:sg:hansard:d1", "hansard", "Sitting", None, '{"level": "sitting"}'), ("urn:sg:hansard:d1:s5", "hansard", "DATA SAFETY (AMENDMENT) BILL", "urn:sg:hansard:d1", '{"level": "section"}'),
        ("urn:sg:hansard:d1:s6", "hansard", "Fish", "urn:sg:hansard:d1", '{"level": "section"}'), ("urn:sg:hansard:d1:s5:sp1", "hansard", "x", "urn:sg:hansard:d1:s5", '{"level": "speech"}'),
        ("urn:sg:hansard:d1:s5:sp2", "hansard", "x", "urn:sg:hansard:d1:s5", '{"level": "speech"}'), ("urn:sg:hansard:d1:s6:sp1", "hansard", "x", "urn:sg:hansard:d1:s6", '{"level": "speech"}'),
    ]
    docs = spark.createDataFrame([(*r, None) for r in docs], "urn string, corpus string, title string, parent string, meta string, canonical_urn string")
    refs = spark.createDataFrame([("urn:sg:act:AA", "urn:sg:act:A1:s2", "amends", 0.5), ("urn:sg:act:AA", "urn:sg:bill:2020:7", "enacted_by", None), ("urn:sg:act:A1", "urn:sg:bill:2012:2", "enacted_by", 1.0), ("urn:sg:act:A1", None, "enacted_by", None)], "`from` string, `to` string, kind string, confidence double")
    got = {(r.provision[-2:], r.act[11:], r.bill[12:], r.section[15:], r.confidence, r.speech[-3:]) for r in relational.intent_chain(docs, refs).collect()}
    assert got == {("s2", "AA", "2020:7", "d1:s5", 0.5, x) for x in ("sp1", "sp2")} | {(s, "A1", "2012:2", "d1:s5", 0.75, x) for s in ("s1", "s2") for x in ("sp1", "sp2")}
    rows = api.parliamentary_intent(docs, refs, "urn:sg:act:A1:s2").collect()
    assert [r.confidence for r in rows] == [0.75, 0.75, 0.5, 0.5] and all(r.sitting == "urn:sg:hansard:d1" and r.caveat for r in rows)


def test_similar_pairs_over_blocks(spark):
    left = spark.createDataFrame([(1, "a b"), (1, "a b"), (2, "c d e f"), (3, ""), (4, None)], "k long, text string")
    right = spark.createDataFrame([(7, "A, b!"), (8, "c z"), (9, None)], "o long, item string")
    assert sorted(map(tuple, relational.similar_pairs(left, right, "k", "o", "text", "item", 0.2).collect())) == [(1, 7, 1.0), (1, 7, 1.0), (2, 8, 0.2)]
