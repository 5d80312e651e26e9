"""Every operator over documents on the same tables of odd rows: nulls, empty and very long texts, repeats, clashing columns."""

from __future__ import annotations

import hashlib

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from casebook.llm import fertility, jaccard, langid, matroska, ordinal, packing, secrets, tokenfile, viterbi

DATA = "/root/testdata/sf0.001"
LONG = "the quick brown fox jumps over the lazy dog and runs into the wood again. " * 4000
TEXT = "A short text of some words, with password: hunter2hunter2 in it, twice the same row."
ROWS = [(None, None, None, None, None), (None, TEXT, "en", "s", 1), (1, None, "en", None, None), (2, "", None, "s", 0), (3, LONG, "en", "s", len(LONG)), (4, TEXT, "en", "s", len(TEXT)), (4, TEXT, "en", "s", len(TEXT)), (5, TEXT.upper(), "de", "s", len(TEXT)), (6, " \n\t ", "en", "s", 4), (7, "12 34 ::", "en", "s", 8)]
CLASHES = ["kept", "score", "node", "key", "ids", "signature", "part", "seq", "media", "blocks", "low", "start", "end", "n", "n_words", "spans", "kinds", "grade", "comp", "component_id", "lang_pred", "held_out", "__id", "__text", "__spans", "h", "a.b", "c`d"]


def odd(spark, clashes=True):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.select("*", *(F.lit(f"x{c}").alias(c) for c in (CLASHES if clashes else []))).repartition(3)


def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (4, 0, 0), (5, None, None), (None, 1, 0), (3, 1, 0), (99, 0, 1)], "doc_id long, quality int, toxic int")


PIECES, WORDS = "piece_bpe_32k.model", "word_bpe_49k.json"
OPERATORS = {
    "jaccard": jaccard.join,
    "media": lambda d: matroska.describe(matroska.store_samples(d)),
    "langid": langid.predict,
    "secrets": secrets.digest,
    "fertility": lambda d: fertility.measure(d, [public_tokenizers.path(PIECES)], fertility.fit(d, labels(d.sparkSession), [public_tokenizers.path(PIECES)])),
    "viterbi": lambda d: viterbi.digest(d, public_tokenizers.path(PIECES)),
    "ordinal": lambda d: ordinal.score(d, ordinal.train(d, labels(d.sparkSession))),
    "tokenfile": lambda d: tokenfile.read_tokens(tokenfile.write_tokens(d, public_tokenizers.path("byte_bpe_50k.json"))),
}
#: What texts without a word must give.
NOTHING = {
    "jaccard": {"n_shingles": 0},
    "media": {"payload_bytes": 192},
    "langid": {"lang_pred": "und", "score": 0.0},
    "secrets": {"n_assign": 0, "n_access": 0, "n_hex": 0, "base_sha256": hashlib.sha256(b"").hexdigest(), "spans": ""},
    "fertility": {"n_words": 0, "word_chars": 0, "base_failed": True, "kept": False},
    "viterbi": {},
    "ordinal": {},
    "tokenfile": {},
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows(spark, name):
    rows = OPERATORS[name](odd(spark)).collect()
    assert sorted(str(r.doc_id) for r in rows) == sorted(str(x[0]) for x in ROWS)
    by = {k: [r.asDict() for r in rows if r.doc_id == k] for k in (1, 2, 4, 6)}
    for k in (1, 2, 6):
        assert {c: by[k][0][c] for c in NOTHING[name]} == NOTHING[name]
    one, two = ({c: v for c, v in r.items() if c != "start"} for r in by[4])
    assert one == two


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_tables(spark, name):
    assert OPERATORS[name](odd(spark).limit(0)).count() == 0


def test_packing_odd_rows(spark):
    out = packing.pack(odd(spark), public_tokenizers.path(WORDS))
    rows = out.collect()
    pieces = {(r.doc_id, r.start): r.length for r in rows if r.doc_id == 3}
    at = 0
    while (3, at) in pieces:
        at += pieces.pop((3, at))
    assert not pieces and at == next(r.doc_tokens for r in rows if r.doc_id == 3) > 10 * packing.WINDOW
    assert [r.length for r in rows if r.doc_id in (1, 2)] == [1, 1]
    assert sum(r.length for r in rows if r.doc_id == 4) == 2 * next(r.doc_tokens for r in rows if r.doc_id == 4)
    assert packing.pack(odd(spark).limit(0), public_tokenizers.path(WORDS)).count() == 0


@pytest.mark.parametrize("place", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_rows(spark, place):
    name, stage = corpus_pipeline.STAGES[place]
    docs = odd(spark)
    rows = stage(spark, docs, DATA)
    if name != "packing":
        assert rows.columns == docs.columns
        assert all(r[c] == f"x{c}" for r in rows.collect() for c in CLASHES)
    got = {r.doc_id for r in rows.select("doc_id").collect()}
    assert got <= {x[0] for x in ROWS}
    if name in ("redaction", "packing"):
        assert got == {x[0] for x in ROWS}
    if name == "near_duplicates":
        assert got == {None, 1, 2, 3, 4, 6, 7}
    assert stage(spark, docs.limit(0), DATA).count() == 0
