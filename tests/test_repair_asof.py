"""Repair of wrong decoding; as-of by a sweep against a plain count."""

from __future__ import annotations

import random
from datetime import date, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from casebook.functions import repair
from casebook.functions.text import cleaned
from casebook.operators import temporal

TEXTS = ["café", "naïve – “quoted” 100 €", "中文 தமிழ் “é”", "Ünïcödé £5", "emoji 😀", "Straße, Łódź, Žižek", "ñandú ¿qué?", "Ελλάδα Москва"]


def cp1252(text):
    return "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in text.encode())


def latin1(text):
    return text.encode().decode("latin-1")


@pytest.mark.parametrize("text", TEXTS)
@pytest.mark.parametrize("wrong", [cp1252, latin1, lambda x: cp1252(cp1252(x)), lambda x: latin1(cp1252(x)), lambda x: latin1(latin1(x))])
def test_layers_come_off(text, wrong):
    assert repair.decoded_again(wrong(text)) == text


@pytest.mark.parametrize("text", [*TEXTS, "SÃO PAULO NÃO", "à « ici »", "CAFÉ™", "plain", "", "5 × 3 ÷ 2 ± 1", "Ð and Þ", "â, ê, î"])
def test_clean_text_stays(text):
    assert repair.decoded_again(text) == text


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.characters(min_codepoint=0x4E00, max_codepoint=0x9FFF), min_size=1, max_size=20))
def test_any_han_text_comes_back(text):
    assert repair.decoded_again(cp1252(text)) == text and repair.decoded_again(text) == text


def test_other_repairs():
    assert repair.repaired("‘a’ “b” ﬁn ＡＢ\x07\x93c\x94") == "'a' \"b\" fin AB\"c\""
    assert cleaned("  caf&eacute;\xa0 &amp; cafÃ©\n") == "café & café" and cleaned(None) == ""


@pytest.mark.parametrize("kind", ["date", "timestamp", "long"])
def test_sweep_as_a_plain_count(spark, kind):
    rng, first = random.Random(3), date(2019, 6, 1)
    when = (lambda n: n * 40_000) if kind == "long" else (lambda n: first + timedelta(days=n))
    versions = [(rng.randrange(6), n := rng.randrange(900), rng.choice([None, n + rng.randrange(-3, 300)])) for _ in range(60)]
    versions += [(None, 5, 9), (1, None, 4), *[(2, 100, 200)] * 3]
    asked = [(i, rng.choice([0, 1, 2, 3, 4, 5, 9, None]), rng.choice([None, *range(-20, 1300, 7)])) for i in range(400)] + [(500, 2, n) for n in range(95, 205)] + [(500, 2, 150)]
    of = lambda n: None if n is None else when(n)
    day = "long" if kind == "long" else "date"
    v = spark.createDataFrame([(k, of(a), of(b)) for k, a, b in versions], f"key int, start {day}, `end` {day}")
    r = spark.createDataFrame([(i, k, of(n)) for i, k, n in asked], f"id int, key int, at {day}")
    if kind == "timestamp":
        v, r = v.selectExpr("key", "cast(start as timestamp) start", "cast(`end` as timestamp) `end`"), r.selectExpr("id", "key", "cast(at as timestamp) at")
    want = {}
    for i, k, n in asked:
        hits = [a for key, a, b in versions if k is not None and key == k and n is not None and a is not None and a <= n and (b is None or n < b)]
        want.setdefault(i, []).extend(hits)
    got = {x.id: x for x in temporal.as_of_status(r, v, "key", "at", ["id"]).collect()}
    assert set(got) == set(want)
    for i, hits in want.items():
        assert got[i].matches == len(hits) and got[i].status == ("not_in_force", "ok", "ambiguous_version")[min(2, len(hits))]
        stamp = got[i].version.date() if kind == "timestamp" and got[i].version else got[i].version
        assert stamp == (of(hits[0]) if len(hits) == 1 else None)


def test_a_large_sweep_has_more_and_smaller_tasks(spark, monkeypatch):
    """The number of tasks grows with the requests at every shuffle of theirs; null keys and times stay not in force."""
    from casebook.sources import shared

    monkeypatch.setattr(shared, "TASK_ROWS", 10)
    day = "date_add(date'2020-01-01', cast(id % 40 as int))"
    requests = spark.range(400).selectExpr("id", "nullif(id % 7, 6) as key", f"if(id % 11 = 0, null, {day}) as at")
    versions = temporal.timeline(spark.range(70).selectExpr("id % 6 as key", "date_add(date'2020-01-05', cast(id as int)) as start"), "key", "start", 400)
    got = temporal.as_of_status(requests, versions, "key", "at", ["id"], size=400)
    assert got.rdd.getNumPartitions() == 40
    want = temporal.as_of(requests, versions, "key", "at").groupBy("id").agg(F.count("start").alias("n"), F.min("start").alias("s"))
    assert got.count() == 400 and sorted((r.id, r.matches, r.version) for r in got.collect()) == sorted((r.id, r.n, r.s) for r in want.collect())
