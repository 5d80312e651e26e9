"""HTML as rows: blocks, titles, links, from the standard parser; one Arrow pass, no tree leaves the worker."""

from __future__ import annotations

from html.parser import HTMLParser

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

BLOCKS = {"p", "div", "h6"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
HIDDEN = {"script", "style"}
BLOCK = "array<struct<pos:int,tag:string,text:string,label:string>>"


class _Blocks(HTMLParser):
    """Innermost blocks in document order, with the text of their first <strong>."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[dict] = []
        self.found: list[dict] = []
        self.strong = self.hidden = 0
        self.loose = {"tag": "document", "parts": [], "label": None}

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS:
            if tag == "p" and self.open and self.open[-1]["tag"] == "p":
                self.close("p")
            if self.open:
                self.open[-1]["outer"] = True
            self.open.append({"tag": tag, "parts": [], "label": None, "outer": False, "at": len(self.found)})
            self.found.append(self.open[-1])
        elif tag == "strong":
            self.strong += 1
            top = self.open[-1] if self.open else self.loose
            if top["label"] is None:
                top["label"] = []
                top["in"] = True
        self.hidden += tag in HIDDEN

    def close(self, tag):
        while self.open:
            if self.open.pop()["tag"] == tag:
                break

    def handle_endtag(self, tag):
        if tag in BLOCKS and any(b["tag"] == tag for b in self.open):
            self.close(tag)
        elif tag == "strong":
            self.strong = max(0, self.strong - 1)
            (self.open[-1] if self.open else self.loose)["in"] = False
        self.hidden -= tag in HIDDEN and self.hidden > 0

    def handle_data(self, data):
        data = data.strip()
        if self.hidden or not data:
            return
        for b in [self.loose, *self.open[-1:]]:
            b["parts"].append(data)
            if b.get("in") and b["label"] is not None:
                b["label"].append(data)


def blocks_of(text: str | None) -> list[dict]:
    parser = _Blocks()
    parser.feed(text or "")
    inner = [b for b in parser.found if not b["outer"]] or [parser.loose]
    squeeze = lambda parts: " ".join(" ".join(parts or []).replace("\xa0", " ").split())
    out = [{"pos": i, "tag": b["tag"], "text": squeeze(b["parts"]), "label": squeeze(b["label"])} for i, b in enumerate(inner)]
    return [b for b in out if b["text"]]


def html_blocks(markup: Column) -> Column:
    """struct(pos, tag, text, label) of each innermost block that has text."""
    return pandas_udf(lambda pages: pages.map(blocks_of), BLOCK)(markup)


def title(markup: Column) -> Column:
    return F.nullif(F.trim(F.regexp_extract(markup, r"(?is)<title[^>]*>(.*?)</title>", 1)), F.lit(""))


def links(markup: Column) -> Column:
    return F.regexp_extract_all(markup, F.lit(r"""(?i)<a\s[^>]*href=["']([^"']*)["']"""), F.lit(1))
