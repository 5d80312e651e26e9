"""Markup cut by one expression against the standard parser, and partitions by anchor."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from casebook import source_queries
from casebook.functions import dom
from casebook.operators import relational as R

PIECES = ['<div id="a1">', '<p class="x y" id="b">', "<p>", "<li>", "<td>", "<tr>", "<br>", "<br/>", '<a name="c" name="d" href="/x?a=1">', "<a href='q'>", "<script>", "<style>", "<title>", "</script>", "</style>", "</title>", "</p>", "</div>", "</a>", "</li>", "</P>", "<!-- c -->", "<B>", '<i id="&amp;">', "tail &amp; 1", "&lt", " ", "x\ny", "a < b", "&", "<"]


def by_events(markup):
    builder = dom._Builder()
    builder.feed(markup)
    builder.close()
    return builder.root


def shape(x):
    return x if isinstance(x, str) else (x.tag, x.attrs, [shape(k) for k in x.kids])


def test_trees_as_by_the_standard_parser():
    rng, plain = random.Random(2), 0
    for i in range(6000):
        markup = "".join(rng.choice(PIECES[: 7 if i % 2 else len(PIECES)] + ["t", "</p>", "</div>", "<script>x</script>"]) for _ in range(rng.randrange(9)))
        plain += dom._plain(dom.TAG.split(markup))
        assert shape(dom.tree(markup)) == shape(by_events(markup)), markup
    assert plain > 2000
    assert shape(dom.tree(None)) == ("document", {}, [])


def test_strings_joined_by_anchor(spark):
    rng = random.Random(3)
    marks = ['<p id="a">', '<b name="c">', "<style>s</style>", '<div id="a"><script>x</script></div>', "t", "u &amp; v", "</p>", "</div>", "<i>"]
    rows = [(i, "".join(rng.choice(marks) for _ in range(8)), [["a"], ["a", "c"], [], [None, "c"], None][i % 5]) for i in range(60)] + [(60, None, ["a"])]
    pages = spark.createDataFrame(rows, "page long, html string, ids array<string>").repartition(3)
    single = dom.anchored(pages, "page", "html", F.col("ids"))
    held = {(r.page, r.pos): r.text for r in single.collect()}
    assert held == {(i, x["pos"]): x["text"] for i, html, _ in rows for x in dom.rows_of(html) if x["tag"] is None and not any(y["pos"] < x["pos"] <= y["last"] for y in dom.rows_of(html) if y["tag"] in dom.HIDDEN)}
    want = sorted(map(tuple, R.joined(single, ["page", "anchor"], "pos", "text", "|").select("page", "anchor", "first_pos", "text").collect()))
    assert sorted(map(tuple, dom.anchored(pages, "page", "html", F.col("ids"), "|").select("page", "anchor", "pos", "text").collect())) == want


def test_anchor_partition_shuffles_once(spark):
    """Lines are dealt out by order, and nothing that is made of them is shuffled again."""
    plan = source_queries.anchor_partition(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "ArrowEvalPython" not in plan
