from __future__ import annotations

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from casebook.llm import jaccard, langid, ordinal, secrets
from casebook.llm.common import materialise, table
from tests.llm.test_jaccard import brute

DATA = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = table(spark, DATA, "documents")
    scored = {r.doc_id for r in ordinal.score(docs, ordinal.train(docs, table(spark, DATA, "labels"))).where("kept").collect()}
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out = materialise(stage(spark, seen[-1], DATA))
        assert name == "packing" or out.columns == docs.columns
        seen.append(out)
    ids = [{r.doc_id for r in x.select("doc_id").collect()} for x in seen]
    assert ids[1] == scored and len(ids[1]) < len(ids[0])
    clear = {r.doc_id for r in langid.label(seen[1], langid.train(seen[1])).collect() if r.lang_pred != "und" and r.score >= 0.5}
    assert ids[2] == clear
    groups = brute([(r.doc_id, r.text) for r in seen[2].collect()])
    assert ids[3] == {k for k, (_, c) in groups.items() if k == c}
    assert ids[4] == ids[3] and secrets.digest(seen[4]).where("n_assign + n_access + n_hex > 0").count() == 0
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {r.doc_id: len(t.encode(r.text, add_special_tokens=False).ids) + 1 for r in seen[4].collect()}
    assert {r.doc_id: r.n for r in seen[5].groupBy("doc_id").sum("length").withColumnRenamed("sum(length)", "n").collect()} == want


def test_clashing_columns(spark):
    docs = table(spark, DATA, "documents").selectExpr("*", "1 AS kept", "2 AS score", "3 AS spans", "4 AS kinds", "5 AS n", "6 AS comp", "7 AS node", "8 AS key").limit(50)
    labels = table(spark, DATA, "labels").selectExpr("*", "1 AS grade")
    for out in (ordinal.select(docs, labels), langid.select(docs), jaccard.select(docs), secrets.redact(docs)):
        assert out.columns == docs.columns and 0 < out.count() <= 50


def test_empty_and_null_documents(spark):
    docs = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0)], "doc_id long, text string, lang string, source string, n_chars long")
    for rows in (docs, docs.limit(0)):
        for stage in (lambda d: langid.select(d), jaccard.select, secrets.redact):
            assert stage(rows).columns == docs.columns
            stage(rows).count()


def linked(docs, words, least):
    """Ids that stay, by brute force."""
    sets = [(k, {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))}) for k, w in ((k, t.split()) for k, t in docs)]
    root = {k: k for k, _ in docs}
    for _ in docs:
        for a, x in sets:
            for b, y in sets:
                if 100 * len(x & y) >= least * len(x | y):
                    root[a] = root[b] = min(root[a], root[b])
    return {k for k in root if root[k] == k}


def test_near_copies_at_five_words(spark):
    base = [f"b{i}" for i in range(100)]
    docs = []
    for i, places in enumerate([(), (20, 70), (20, 50, 80), (10, 30, 50, 70)]):  # 5 words: 0.81 at two edits; 4 words: 0.85 less a little
        docs += [(10 * i + j, " ".join(f"d{j}" + (f"x{i}" if k in places else w) for k, w in enumerate(base))) for j in range(3)]
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(docs, "doc_id long, text string"), DATA).collect()}
    assert kept == linked(docs, 5, 80) != linked(docs, 4, 85)
    small = table(spark, DATA, "documents").where("doc_id is not null and length(text) > 200").limit(60)
    same = [(r.doc_id, r.text.lower()) for r in small.collect() if r.text.isascii()]
    kept = {r.doc_id for r in corpus_pipeline.near_duplicates(spark, spark.createDataFrame(same, "doc_id long, text string"), DATA).collect()}
    assert kept == linked(same, 5, 80)
