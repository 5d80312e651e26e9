"""Table functions in SQL."""

from __future__ import annotations

import pytest

from casebook.functions import dom, html, tables

PAGE = "<html><body><h1 id='a'>One</h1><p>x <a href='/u'>go <b>on</b></a></p><script>no</script><h2 id='b'>Two</h2><p><strong>Mr A</strong>: says</p></body></html>"


def test_lateral(spark):
    tables.register(spark)
    spark.createDataFrame([(1, PAGE), (2, None), (3, "")], "k int, page string").createOrReplaceTempView("lateral_pages")
    ask = lambda sql: [tuple(r) for r in spark.sql(sql).collect()]
    assert ask("SELECT k, n.tag, n.href, n.text FROM lateral_pages, LATERAL page_nodes(page, 'a') n") == [(1, "a", "/u", "go on")]
    assert ask("SELECT count(*) FROM lateral_pages, LATERAL page_nodes(page) n WHERE k = 1") == [(len(dom.rows_of(PAGE)),)]
    assert ask("SELECT n.pos, n.tag, n.text, n.label FROM lateral_pages, LATERAL page_blocks(page) n WHERE k = 1") == [tuple(x.values()) for x in html.blocks_of(PAGE)]
    assert ask("SELECT k, n.id, n.text FROM lateral_pages, LATERAL page_sections(page, array('b', 'a', 'none')) n") == [(1, "b", "Two\nMr A: says"), (1, "a", "One\nx go on")]
    assert ask("SELECT clean_text(' cafÃ© &amp; ')") == [("café &",)]
    for bad, why in (("page_nodes(k)", "argument 1"), ("page_sections(page, 'a')", "argument 2")):
        with pytest.raises(Exception, match=why):
            spark.sql(f"SELECT * FROM lateral_pages, LATERAL {bad} n").collect()
