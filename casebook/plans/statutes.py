"""Statute pages to versions of statutes, provisions and subprovisions.

A page is one row from its markup to its documents: one Arrow pass reads the markup, all that follows (validity, keys,
parents, parts) are expressions over the page's arrays, so nothing is shuffled. Pages that contradict their parameters
carry an error and give no document.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from casebook.functions import urn as U
from casebook.functions.dom import Element, rendered, tree

ADAPTER, VERSION, REVISION = "sso", "1.0.0", 3
# The site's links, the parameters of its snapshots, and how its pages mark things.
HREF = re.compile(r"^/(Act|SL)/([A-Za-z0-9_.-]+)(?:\?[^#]*)?$")
ITEM = "struct<code:string,corpus:string,title:string,href:string>"
PARAMS = f"kind string, item {ITEM}, version_start string, version_end string, historical boolean, requested_ids array<string>, all_ids array<string>, root_record boolean, version_seq int, repealed boolean, path string, page_url string"
PROVISION, LABEL, DELETED, CHAPTER = r"^pr([0-9]+[A-Za-z]*)-", r"\([A-Za-z0-9]+\)", r"(?i)\((?:Deleted|Repealed|Omitted)\)", r"(?i)\b(?:Cap\.?|CHAPTER)\s+\d+[A-Za-z]?"
BREAKS = frozenset({"p", "div", "tr", "table", "br"})
#: The most characters of a request's address.
LONGEST_URL = 6000

TOC, PIECE = "array<struct<anchor:string,label:string>>", "array<struct<anchor:string,text:string>>"
SUB = "array<struct<anchor:string,path:string,parent:string,text:string>>"
PAGE = f"error string, selected string, timeline array<struct<day:string,href:string>>, toc {TOC}, pieces {PIECE}, subs {SUB}"


# ---- One page


def block_text(x: Element) -> str:
    return "\n".join(rendered(x, BREAKS)["preamble"])


def _kids(x: Element, *tags: str) -> list[Element]:
    return [k for k in x.kids if isinstance(k, Element) and k.tag in tags]


def _rows(within: Element, path: str) -> list[tuple[str, str, str]]:
    """(path, parent path, text) of the labelled rows of the outermost paragraph tables, each before those that it holds."""
    out, stack = [], [(within, path, None)]
    while stack:
        within, path, row = stack.pop()
        if row is not None:
            out.append((path, path[: path.rindex("(")], block_text(row)))
        found = [x for x in within.find("table") if any(re.match(r"p[1-9]_", c) for c in x.classes)]
        held = {id(y) for x in found for y in x.find("table")}
        inner = []
        for table in (x for x in found if id(x) not in held):
            for r in (r for part in [table, *_kids(table, "tbody", "thead", "tfoot")] for r in _kids(part, "tr")):
                cells = _kids(r, "td")
                if len(cells) > 1 and re.fullmatch(LABEL, label := cells[0].text()):
                    inner.append((cells[1], path + label, r))
        stack += reversed(inner)
    return out


def subparts(block: Element) -> list[tuple[str, str, str]]:
    """(path, parent path, text) of numbered subsections and of lettered rows, as in (2)(b)(i); "" is the provision."""
    sections = [x for x in block.below() if {"prov2TxtIL", "prov2Txt"} & set(x.classes)]
    if not sections:
        return _rows(block, "")
    out = []
    for section in sections:
        text = block_text(section)
        if number := re.match(r"[—\s]*(\(\d+\))", text):
            out += [(number[1], "", text), *_rows(section, number[1])]
    return out


def read_page(markup: str | None) -> dict:
    root = tree(markup)
    panel, content = root.first(id="tocPanel"), root.first(id="legisContent")
    empty = {"error": "statute structure missing (a soft 404?)", "selected": None, "timeline": [], "toc": [], "pieces": [], "subs": []}
    if panel is None or content is None:
        return empty
    button = root.first(id="versionsButton")
    versions = {m[1]: x.attrs["href"] for pop in root.find(id="versionsPopover") for x in pop.find("a") if (m := re.search(r"[?&]ValidDate=(\d{8})(?:&|#|$)", x.attrs.get("href", "")))}
    if not versions or button is None:
        return empty | {"error": "version timeline or selected date missing; dates are never guessed"}
    toc = dict.fromkeys((x.attrs["href"][1:], x.text(" ")) for x in panel.find("a", "nav-link") if x.attrs.get("href", "").startswith("#") and x.attrs["href"] != "#top")
    pieces = rendered(content, BREAKS, anchors=frozenset(a for a, _ in toc))
    subs = []
    for anchor, _ in toc:
        header = next(content.find(id=anchor), None) if re.match(PROVISION, anchor) else None
        block = next((x for x in header.above() if x.tag == "div" and "prov1" in x.classes), None) if header is not None else None
        subs += [{"anchor": anchor, "path": a, "parent": b, "text": c} for a, b, c in (subparts(block) if block is not None else [])]
    return {
        "error": None, "selected": button.text(), "timeline": [{"day": d, "href": h} for d, h in sorted(versions.items())],
        "toc": [{"anchor": a, "label": b} for a, b in toc], "pieces": [{"anchor": k, "text": "\n".join(v)} for k, v in pieces.items()], "subs": subs,
    }


def page(markup: Column) -> Column:
    """The parts of a page that documents are made from. As nondeterministic, so that a filter on them reads no page again."""
    return pandas_udf(lambda pages: pd.DataFrame(list(pages.map(read_page)), columns=[x.split(" ")[0] for x in re.split(r", (?=\w+ )", PAGE)]), PAGE).asNondeterministic()(markup)


def listing_of(markup: str | None) -> dict:
    tables = [x for x in tree(markup).find("table", "browse-list")]
    if not tables:
        return {"error": "browse table missing", "items": []}
    items = []
    for row in (r for t in tables for r in t.find("tr")):
        cell = next((k for k in row.kids if isinstance(k, Element) and k.tag in ("td", "th")), None)
        for a in cell.kids if cell is not None and cell.tag == "td" else []:
            if isinstance(a, Element) and a.tag == "a" and "non-ajax" in a.classes and (m := HREF.match(a.attrs.get("href", ""))):
                items.append({"href": m[0], "title": a.text(), "code": m[2], "corpus": "act" if m[1] == "Act" else "sl"})
    return {"error": None, "items": items}


def listing(markup: Column) -> Column:
    """struct(error, items): first-column links to statutes of a browse page; a page without its table is an error."""
    return pandas_udf(lambda pages: pd.DataFrame(list(pages.map(listing_of)), columns=["error", "items"]), "error string, items array<struct<href:string,title:string,code:string,corpus:string>>")(markup)


# ---- Keys and addresses


def part_key(anchor: Column, corpus: Column) -> Column:
    """s15 or r15 of provisions; else the anchor without its last dashes, dots as dashes."""
    number = F.regexp_extract(anchor, PROVISION, 1)
    return F.when(number != "", F.concat(F.when(corpus == "act", "s").otherwise("r"), number)).otherwise(F.translate(F.regexp_replace(anchor, "-+$", ""), ".", "-"))


def root_urn(corpus: Column, code: Column) -> Column:
    """Of an act by its code, of subsidiary legislation by the act's code and its number; null without either."""
    number = F.regexp_extract(code, "^([^-]+)-(.+)$", 2)
    return F.when(corpus == "act", F.concat(F.lit("urn:sg:act:"), code)).when(number != "", F.concat(F.lit("urn:sg:sl:"), F.substring_index(code, "-", 1), F.lit(":"), number))


def with_ids(url: Column, ids: Column) -> Column:
    """The address that asks for these provisions, in place of any that it asked for."""
    bare = F.regexp_replace(F.regexp_replace(url, "#.*$", ""), r"(?<=[?&])ProvIds=[^&]*&?|&ProvIds=[^&]*$", "")
    bare = F.regexp_replace(bare, "[?&]$", "")
    return F.concat(bare, F.when(F.contains(bare, F.lit("?")), "&").otherwise("?"), F.lit("ProvIds="), F.url_encode(F.array_join(ids, ",")))


def id_chunks(url: Column, ids: Column, longest: int = LONGEST_URL) -> Column:
    """The ids in order, in lists whose addresses are as long as allowed; a single id may be longer."""
    none = F.expr("cast(array() as array<string>)")
    start = F.struct(F.expr("cast(array() as array<array<string>>)").alias("done"), none.alias("now"))

    def step(acc: Column, x: Column) -> Column:
        longer = F.concat(acc["now"], F.array(x))
        full = (F.size(acc["now"]) > 0) & (F.length(with_ids(url, longer)) > longest)
        return F.struct(F.when(full, F.concat(acc["done"], F.array(acc["now"]))).otherwise(acc["done"]).alias("done"), F.when(full, F.array(x)).otherwise(longer).alias("now"))

    return F.aggregate(ids, start, step, lambda acc: F.when(F.size(acc["now"]) > 0, F.concat(acc["done"], F.array(acc["now"]))).otherwise(acc["done"]))


def missing(requested: Column, present: Column) -> Column:
    """Requested anchors that aren't there."""
    return F.array_except(requested, present)


# ---- Documents


def placed(toc: Column, root: Column, corpus: Column) -> Column:
    """The table of contents with each entry's urn, parent, and the Part and Division that it stands in.

    A Part ends the Division, a schedule both; histories, lists of amendments and schedules belong to the statute.
    """
    null = F.lit(None).cast("string")
    start = F.struct(null.alias("part"), null.alias("division"), F.expr("cast(array() as array<struct<anchor:string,label:string,key:string,urn:string,parent:string,part:string,division:string>>)").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        low, key = F.lower(x["label"]), part_key(x["anchor"], corpus)
        own = U.child(root, key)
        is_part, schedule = low.startswith("part "), x["anchor"].startswith("Sc")
        is_division = ~is_part & low.startswith("division ")
        resets = ~is_part & ~is_division & schedule
        part = F.when(is_part, own).when(~resets, acc["part"])
        division = F.when(is_division, own).when(~is_part & ~resets, acc["division"])
        parent = F.when(is_part | (~is_division & x["anchor"].rlike("^(Sc|xv|al)")), root).when(is_division, F.coalesce(acc["part"], root)).otherwise(F.coalesce(acc["division"], acc["part"], root))
        row = F.struct(x["anchor"].alias("anchor"), x["label"].alias("label"), key.alias("key"), own.alias("urn"), parent.alias("parent"), part.alias("part"), division.alias("division"))
        return F.struct(part.alias("part"), division.alias("division"), F.concat(acc["out"], F.array(row)).alias("out"))

    return F.aggregate(toc, start, step, lambda acc: acc["out"])


def pages(snapshots: DataFrame) -> DataFrame:
    """Pages of provisions with their parameters, root and `error`: why nothing may be made of them."""
    p = F.col("p")
    rows = snapshots.withColumn("p", F.from_json("params", PARAMS))
    known = p["kind"].isin("listing", "structure", "provisions")
    rows = rows.where(~F.coalesce(known & (p["kind"] != "provisions"), F.lit(False)))
    rows = rows.withColumn("page", page(F.decode("body", "UTF-8")))
    day = F.try_to_timestamp("page.selected", F.lit("d MMM yyyy")).cast("date")
    rows = rows.withColumn("selected", day).withColumn("timeline", F.transform("page.timeline", lambda x: F.struct(F.try_to_timestamp(x["day"], F.lit("yyyyMMdd")).cast("date").alias("from"), x["href"].alias("href"))))
    later = F.filter(F.transform("timeline", lambda x: x["from"]), lambda d: d > F.col("selected"))
    rows = rows.withColumn("ends", F.array_min(later)).withColumn("bare", root_urn(p["item"]["corpus"], p["item"]["code"]))
    absent = missing(p["requested_ids"], F.transform("page.pieces", lambda x: x["anchor"]))
    error = (
        F.when(~F.coalesce(known, F.lit(False)), F.concat(F.lit("unknown snapshot kind: "), F.coalesce(p["kind"], F.lit("none"))))
        .when(F.col("page.error").isNotNull(), F.col("page.error"))
        .when(~F.coalesce(F.col("selected").cast("string") == p["version_start"], F.lit(False)), "selected version differs from the parameters")
        .when(~F.col("ends").cast("string").eqNullSafe(p["version_end"]), "validity endpoint differs from the timeline")
        .when(F.col("bare").isNull(), "subsidiary legislation without its act's code")
        .when(F.size(absent) > 0, F.concat(F.lit("provisions absent: "), F.array_join(absent, ", ")))
    )
    return rows.withColumn("error", error).withColumn("root", U.at(F.col("bare"), F.when(F.coalesce(p["historical"], F.lit(False)), F.col("selected"))))


def documents(read: DataFrame) -> DataFrame:
    """The envelope's rows of pages without an error: the statute (of root records), its provisions, their subprovisions."""
    p, item, toc = F.col("p"), F.col("p.item"), F.col("toc")
    rows = read.where("error is null").withColumn("toc", placed(F.col("page.toc"), F.col("root"), item["corpus"]))
    sub_key = lambda key, path: F.concat_ws("-", key, F.regexp_extract_all(path, F.lit(r"\(([^)]+)\)"), F.lit(1)))
    subs = F.transform("page.subs", lambda s: F.struct(s["anchor"].alias("anchor"), s["path"].alias("path"), s["text"].alias("text"), F.get(F.filter(toc, lambda t: t["anchor"] == s["anchor"]), F.lit(0)).alias("of"), s["parent"].alias("above")))
    asked = lambda a: F.array_contains(F.col("p.requested_ids"), a)
    rows = rows.withColumn("subs", F.filter(subs, lambda s: asked(s["anchor"])))
    rows = rows.withColumn("subs", F.transform("subs", lambda s: F.struct(
        s["of"].alias("of"), s["path"].alias("path"), s["text"].alias("text"), sub_key(s["of"]["key"], s["path"]).alias("key"),
        U.child(F.col("root"), sub_key(s["of"]["key"], s["path"])).alias("urn"), U.child(F.col("root"), sub_key(s["of"]["key"], s["above"])).alias("parent"))))
    history = F.array_join(F.transform(F.filter("page.pieces", lambda x: x["anchor"].startswith("xv")), lambda x: x["text"]), "\n")
    below = lambda rows_, urn: F.transform(F.filter(rows_, lambda c: c["parent"] == urn), lambda c: c["urn"])
    text_of = lambda anchor: F.coalesce(F.get(F.filter("page.pieces", lambda x: x["anchor"] == anchor), F.lit(0))["text"], F.lit(""))
    shown = {"ignoreNullFields": "false"}
    repealed = F.coalesce(p["repealed"], F.lit(False)).alias("repealed")

    def meta(level: Column, key: Column, t: Column, number: Column) -> Column:
        return F.to_json(F.struct(
            level.alias("level"), U.child(F.col("bare"), key).alias("canonical_urn"), item["code"].alias("short_code"), t["anchor"].alias("source_anchor"), number.alias("provision_number"),
            p["version_seq"].alias("version_seq"), repealed, t["label"].rlike(DELETED).alias("deleted"), F.lit("source_version_date").alias("issued_basis"), t["part"].alias("part"), t["division"].alias("division")), shown)

    def record(title: Column, citation: Column, text: Column, parts: Column, parent: Column, urn: Column, about: Column) -> Column:
        return F.struct(urn.alias("urn"), title.alias("title"), citation.alias("citation"), text.alias("text"), parts.alias("parts"), parent.alias("parent"), about.alias("meta"))

    is_provision = lambda t: t["anchor"].startswith("pr")
    own_number = lambda t: F.when(is_provision(t), F.substring(t["key"], 2, 1000))
    top = record(
        item["title"], item["title"], text_of(F.lit("preamble")), below(toc, F.col("root")), F.lit(None).cast("string"), F.col("root"),
        F.to_json(F.struct(
            F.lit("statute").alias("level"), item["code"].alias("short_code"), repealed,
            F.array_distinct(F.regexp_extract_all(history, F.lit(CHAPTER), F.lit(0))).alias("chapter_alias_candidates"), history.alias("legislative_history"), F.col("timeline").alias("version_timeline"),
            F.when(item["corpus"] == "sl", F.concat(F.lit("urn:sg:act:"), F.substring_index(item["code"], "-", 1))).alias("made_under"), F.lit("source_version_date").alias("issued_basis")), shown))
    provisions = F.transform(F.filter(toc, lambda t: asked(t["anchor"])), lambda t: record(
        t["label"], F.concat(t["label"], F.lit(" of "), item["title"]), text_of(t["anchor"]), F.concat(below(toc, t["urn"]), below(F.col("subs"), t["urn"])), t["parent"], t["urn"],
        meta(F.when(is_provision(t), "provision").otherwise("structure"), t["key"], t, own_number(t))))
    number = lambda s: F.concat(F.substring(s["of"]["key"], 2, 1000), s["path"])
    inner = F.transform("subs", lambda s: record(
        F.concat(number(s), F.lit(" "), s["of"]["label"]), F.concat(number(s), F.lit(" of "), item["title"]), s["text"], below(F.col("subs"), s["urn"]), s["parent"], s["urn"],
        meta(F.lit("subprovision"), s["key"], s["of"], number(s))))
    made = F.concat(F.when(F.coalesce(p["root_record"], F.lit(False)), F.array(top)).otherwise(F.slice(F.array(top), 1, 0)), provisions, inner)
    made_rows = rows.select("selected", "ends", item["corpus"].alias("corpus"), F.struct(F.col("url").alias("source_url"), "retrieved_at", F.col("sha256").alias("snapshot_sha256"), F.lit(ADAPTER).alias("adapter"), F.lit(VERSION).alias("adapter_version"), F.lit(REVISION).alias("parser_rev")).alias("provenance"), F.explode(made).alias("r"))
    return made_rows.select("r.urn", "corpus", F.lit("AGC").alias("authority"), "r.title", "r.citation", F.col("selected").alias("issued"), F.col("selected").alias("in_force_from"), F.col("ends").alias("in_force_to"), F.lit("en").alias("language"), "r.text", "r.parts", "r.parent", "r.meta", "provenance")


def units(listings: DataFrame, versions: bool = False) -> DataFrame:
    """Second phase of discovery: key, payload of each statute of the latest listing pages, the first of each link.

    `listings` are snapshots of kind listing; a page without its table stops the plan.
    """
    from casebook.operators.relational import latest

    rows = listings.withColumn("p", F.from_json("params", PARAMS)).where("p.kind = 'listing'")
    rows = latest(rows.withColumn("page_url", F.col("p.page_url")), ["page_url"], [F.desc("retrieved_at"), F.col("sha256")])
    rows = rows.withColumn("found", listing(F.decode("body", "UTF-8"))).withColumn("items", F.when(F.col("found.error").isNull(), F.col("found.items")).otherwise(F.raise_error(F.col("found.error"))))
    each = rows.select("page_url", F.col("p.path").alias("path"), F.posexplode("items").alias("pos", "item"))
    once = latest(each.withColumn("href", F.col("item.href")), ["path", "href"], [F.col("page_url"), F.col("pos")])
    family, status = F.split("path", "/")[2], F.split("path", "/")[3]
    return once.select(F.concat(F.lit("sso:"), family, F.lit(":"), F.col("item.code"), F.lit(":"), status, F.lit(f":versions={versions}")).alias("key"), F.to_json(F.struct(F.lit("statute").alias("kind"), "item", (status == "Repealed").alias("repealed"))).alias("payload"))
