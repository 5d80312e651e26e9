"""HTML as a small tree, and as rows.

The standard parser's events build a tree of elements; ends that HTML leaves out are supplied for the tags that the
sources use. Markup of plain tags alone gives the same events by one expression, in a fraction of the time. `nodes` turns a page into rows (position, last position below it, tag, id, classes, link, text), so that
selections, fills and partitions are DataFrame operators; parsers of one page use the tree directly. Repeated or broken
markup is kept as it stands; null markup is an empty page.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from casebook.functions.text import cleaned

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN = frozenset({"script", "style"})
#: A tag that opens ends these open ones, up to the nearest of the bounds.
ENDS = {
    **dict.fromkeys("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split(), ({"p"}, {"td", "th", "div", "li", "blockquote", "table"})),
    "li": ({"li", "p"}, {"ul", "ol"}), "option": ({"option"}, {"select"}), "dt": ({"dt", "dd", "p"}, {"dl"}), "dd": ({"dt", "dd", "p"}, {"dl"}),
    "td": ({"td", "th", "p"}, {"tr", "table"}), "th": ({"td", "th", "p"}, {"tr", "table"}), "tr": ({"tr", "td", "th", "p"}, {"table"}),
}
#: A plain tag: an end, or a start with attributes in double quotes that hold no reference.
TAG = re.compile(r'<(?:/([a-z][a-z0-9]*)|([a-z][a-z0-9]*)((?: [a-z][a-z-]*="[^"<>&]*")*))>')
ATTRIBUTES = re.compile(r' ([a-z-]+)="([^"]*)"').findall
#: Tags whose content is not markup, in this version of the standard parser or a later one.
RAW = frozenset("script style iframe noembed noframes noscript plaintext textarea title xmp".split())
NODE = "array<struct<pos:int,last:int,parent:int,tag:string,id:string,classes:array<string>,href:string,text:string>>"


class Element:
    """A tag with its attributes and what it holds: elements and strings."""

    __slots__ = ("tag", "attrs", "kids", "up")

    def __init__(self, tag: str, attrs: dict[str, str], up: Element | None):
        self.tag, self.attrs, self.kids, self.up = tag, attrs, [], up

    @property
    def id(self) -> str:
        return self.attrs.get("id") or ""

    @property
    def classes(self) -> list[str]:
        return held.split() if (held := self.attrs.get("class")) else []

    def below(self) -> Iterator[Element]:
        """Elements inside, in document order."""
        stack = [x for x in reversed(self.kids) if isinstance(x, Element)]
        while stack:
            x = stack.pop()
            yield x
            if x.kids:
                stack += [k for k in reversed(x.kids) if isinstance(k, Element)]

    def above(self) -> Iterator[Element]:
        x = self.up
        while x is not None:
            yield x
            x = x.up

    def find(self, tag: str | None = None, cls: str | None = None, **attrs: str) -> Iterator[Element]:
        """Elements inside with a tag, a class, and attributes of given values."""
        for x in self.below():
            if (tag is None or x.tag == tag) and (x.attrs or not (cls or attrs)) and (cls is None or cls in x.classes) and all(x.attrs.get(k) == v for k, v in attrs.items()):
                yield x

    def first(self, tag: str | None = None, cls: str | None = None, **attrs: str) -> Element | None:
        return next(self.find(tag, cls, **attrs), None)

    def by_class(self) -> dict[str, list[Element]]:
        """Elements inside by each of their classes, in document order."""
        out: dict[str, list[Element]] = {}
        for x in self.below():
            if x.attrs:
                for name in dict.fromkeys(x.classes):
                    out.setdefault(name, []).append(x)
        return out

    def strings(self, skip: Callable[[Element], bool] = lambda x: x.tag in HIDDEN) -> Iterator[str]:
        stack: list = list(reversed(self.kids))
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                yield x
            elif not skip(x):
                stack += reversed(x.kids)

    def text(self, by: str = "") -> str:
        """Cleaned text; `by` stands between strings, which inline tags otherwise don't part."""
        return cleaned(by.join(self.strings()))


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Element("document", {}, None)

    def handle_starttag(self, tag, attrs):
        ended, bounds = ENDS.get(tag, ((), ()))
        x, last = self.at, None
        while ended and x.up is not None and x.tag not in bounds:
            last = x if x.tag in ended else last
            x = x.up
        if last is not None:
            self.at = last.up
        new = Element(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        self.at.kids.append(new)
        if tag not in VOID:
            self.at = new

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.at.tag == tag:
            self.at = self.at.up

    def handle_endtag(self, tag):
        x = self.at
        while x.up is not None and x.tag != tag:
            x = x.up
        if x.up is not None:
            self.at = x.up

    def handle_data(self, data):
        self.at.kids.append(data)

    def take(self, cuts: list[str]) -> None:
        """The events of plain markup, cut at its tags."""
        at = self.at
        if cuts[0]:
            at.kids.append(unescape(cuts[0]))
        for end, start, attrs, text in zip(cuts[1::4], cuts[2::4], cuts[3::4], cuts[4::4], strict=True):
            if end and end == at.tag and at.up is not None:
                at = at.up
            elif start and not attrs and start not in ENDS and start not in VOID:
                new = Element(start, {}, at)
                at.kids.append(new)
                at = new
            else:
                self.at = at
                if end:
                    self.handle_endtag(end)
                else:
                    self.handle_starttag(start, ATTRIBUTES(attrs) if attrs else ())
                at = self.at
            if text:
                at.kids.append(unescape(text) if "&" in text else text)
        self.at = at


def _plain(cuts: list[str]) -> bool:
    """Whether what stands between plain tags is text alone, and that of a tag in RAW the same by any rule."""
    if "<" in "".join(cuts[::4]):
        return False
    ends, starts, texts = cuts[1::4], cuts[2::4], cuts[4::4]
    return RAW.isdisjoint(starts) or all(i + 1 < len(ends) and ends[i + 1] == tag and tag != "plaintext" and "&" not in texts[i] for i, tag in enumerate(starts) if tag in RAW)


def tree(markup: str | None) -> Element:
    builder = _Builder()
    cuts = TAG.split(markup or "")
    if not _plain(cuts):
        builder.feed(markup)
        builder.close()
        return builder.root
    builder.take(cuts)
    return builder.root


def lines(text: str) -> list[str]:
    return [x for x in map(cleaned, text.splitlines()) if x]


def rendered(root: Element, breaks: frozenset[str], tabs: frozenset[str] = frozenset(), skip: frozenset[str] = frozenset(), anchors: frozenset[str] | None = None) -> dict[str, list[str]]:
    """Lines of text by the anchor (an id or name) that stands last before them; before any it is "preamble".

    A line ends after an element of `breaks`; a tab follows one of `tabs`. Elements of a class in `skip`, scripts and
    styles are left out.
    """
    parts: dict[str, list[str]] = {"preamble": []}
    now = parts["preamble"]
    stack: list = [root]
    while stack:
        x = stack.pop()
        if isinstance(x, str):
            now.append(x)
        elif x.tag not in HIDDEN and not (skip and x.attrs and skip.intersection(x.classes)):
            if anchors and x.attrs and (mark := x.id or x.attrs.get("name") or "") in anchors:
                now = parts.setdefault(mark, [])
            if x.tag in breaks:
                stack.append("\n")
            if x.tag in tabs:
                stack.append("\t")
            stack += x.kids[::-1]
    return {k: lines("".join(v)) for k, v in parts.items()}


def rows_of(markup: str | None) -> list[dict]:
    """One row an element, one (with no tag) a string, in document order."""
    out: list[dict] = []
    stack: list = [(tree(markup), None)]
    while stack:
        x, parent = stack.pop()
        if isinstance(x, int):
            out[x]["last"] = len(out) - 1
            continue
        at = len(out)
        if isinstance(x, str):
            out.append({"pos": at, "last": at, "parent": parent, "tag": None, "id": None, "classes": [], "href": None, "text": x})
            continue
        out.append({"pos": at, "last": at, "parent": parent, "tag": x.tag, "id": x.id or x.attrs.get("name") or None, "classes": x.classes, "href": x.attrs.get("href"), "text": None})
        stack.append((at, None))
        stack += [(k, at) for k in reversed(x.kids)]
    return out


def nodes(markup: Column) -> Column:
    """The page's rows. A page is one value, so nothing is shuffled and a page's rows stay together."""
    return pandas_udf(lambda pages: pages.map(rows_of), NODE)(markup)


def strings_by_anchor(markup: str | None, wanted: set[str]) -> Iterator[tuple[str, int, str]]:
    """anchor, pos, text of each string: the last anchor before or around it, and its place among the page's rows."""
    stack: list = [tree(markup)]
    pos, now, hidden = -1, "preamble", 0
    while stack:
        x = stack.pop()
        if x is None:  # a hidden element ends
            hidden -= 1
            continue
        pos += 1
        if isinstance(x, str):
            if not hidden:
                yield now, pos, x
            continue
        if x.attrs and (mark := x.id or x.attrs.get("name")) in wanted:
            now = mark
        if x.tag in HIDDEN:
            hidden += 1
            stack.append(None)
        stack += reversed(x.kids)


def anchored(pages: DataFrame, key: str, markup: str, anchors: Column, by: str | None = None) -> DataFrame:
    """key, anchor, pos, text: every string of a page with the last anchor (of the array `anchors`) before or around it; with
    `by`, a row an anchor of each page: where its first string is, and its strings joined.

    A page is parsed, filled and joined where its row is, so there is no shuffle and no window over a hot page.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            page, found = [], []
            for i, (wanted, html) in enumerate(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                rows = strings_by_anchor(html, set(wanted or ()) - {None})
                if by is not None:
                    parts: dict[str, tuple[int, list[str]]] = {}
                    for anchor, pos, text in rows:
                        parts.setdefault(anchor, (pos, []))[1].append(text)
                    rows = ((anchor, pos, by.join(texts)) for anchor, (pos, texts) in parts.items())
                before = len(found)
                found += rows
                page += [i] * (len(found) - before)
            columns = [batch.column(0).take(pa.array(page, pa.int64())), *(pa.array([x[c] for x in found], kind) for c, kind in enumerate((pa.string(), pa.int32(), pa.string())))]
            yield pa.RecordBatch.from_arrays(columns, names=[key, "anchor", "pos", "text"])

    rows = pages.select(key, anchors.alias("wanted"), markup)
    return rows.mapInArrow(run, f"`{key}` {rows.schema[key].dataType.simpleString()}, anchor string, pos int, text string")
