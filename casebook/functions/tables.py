"""Pages as tables in SQL: functions for LATERAL, and cleaning as a scalar.

    tables.register(spark)
    SELECT p.page_id, n.href FROM pages p, LATERAL page_nodes(p.html, 'a') n

`page_nodes(html[, tag])` has a row for each element and string, in the page's order, or for each element of a tag, with
the text inside it; `page_blocks(html)` the innermost blocks with their labels; `page_sections(html, ids)` the text from each
of the elements named by an array of ids up to the next. `clean_text(text)` is `text.clean`. Arguments are checked when a
query is analysed. A null page has no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import SparkSession
from pyspark.sql.functions import AnalyzeArgument, AnalyzeResult, pandas_udf, udtf
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from casebook.functions import dom, html
from casebook.functions.text import cleaned

TEXT, NUMBER = StringType(), IntegerType()
NODE = StructType([StructField(x, NUMBER) for x in ("pos", "last", "parent")] + [StructField("tag", TEXT), StructField("id", TEXT), StructField("classes", ArrayType(TEXT)), StructField("href", TEXT), StructField("text", TEXT)])
BLOCK = StructType([StructField("pos", NUMBER), *(StructField(x, TEXT) for x in ("tag", "text", "label"))])
SECTION = StructType([StructField("id", TEXT), StructField("text", TEXT)])
ENDS = frozenset({"p", "div", "li", "h1", "h2", "h3", "h4", "h5", "h6", "br", "tr"})


def _string(name: str, at: int, x: AnalyzeArgument) -> None:
    if not isinstance(x.dataType, StringType):
        raise ValueError(f"{name}: argument {at} is to be a string, not {x.dataType.simpleString()}")


class PageNodes:
    @staticmethod
    def analyze(page: AnalyzeArgument, tag: AnalyzeArgument | None = None) -> AnalyzeResult:
        for at, x in enumerate([page] + [tag] * (tag is not None), 1):
            _string("page_nodes", at, x)
        return AnalyzeResult(NODE)

    def eval(self, page: str | None, tag: str | None = None) -> Iterator[tuple]:
        rows = dom.rows_of(page) if page is not None else []
        for x in rows:
            if tag is None:
                yield tuple(x[f.name] for f in NODE)
            elif x["tag"] == tag:
                text = "".join(y["text"] for y in rows[x["pos"] + 1 : x["last"] + 1] if y["tag"] is None)
                yield tuple((x | {"text": text})[f.name] for f in NODE)


class PageBlocks:
    @staticmethod
    def analyze(page: AnalyzeArgument) -> AnalyzeResult:
        _string("page_blocks", 1, page)
        return AnalyzeResult(BLOCK)

    def eval(self, page: str | None) -> Iterator[tuple]:
        for x in html.blocks_of(page) if page is not None else []:
            yield tuple(x[f.name] for f in BLOCK)


class PageSections:
    @staticmethod
    def analyze(page: AnalyzeArgument, ids: AnalyzeArgument) -> AnalyzeResult:
        _string("page_sections", 1, page)
        if not isinstance(ids.dataType, ArrayType) or not isinstance(ids.dataType.elementType, StringType):
            raise ValueError(f"page_sections: argument 2 is to be an array of strings, not {ids.dataType.simpleString()}")
        return AnalyzeResult(SECTION)

    def eval(self, page: str | None, ids: list[str] | None) -> Iterator[tuple]:
        if page is not None and ids:
            parts = dom.rendered(dom.tree(page), ENDS, anchors=frozenset(ids))
            for name in ids:
                if name in parts:
                    yield name, "\n".join(parts[name])


def register(spark: SparkSession) -> None:
    for name, handler in (("page_nodes", PageNodes), ("page_blocks", PageBlocks), ("page_sections", PageSections)):
        spark.udtf.register(name, udtf(handler))
    spark.udf.register("clean_text", pandas_udf(lambda texts: pd.Series(texts).map(cleaned), "string"))
