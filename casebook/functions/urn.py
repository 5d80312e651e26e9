"""Identifier functions as columns; all stay in generated code."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from casebook.schema import valid_urn

# The citation forms.
CITATION = r"(?i)\[(\d{4})\]\s+([A-Z]+(?:\([A-Z]+\))?)\s+(\d+)(\s*\(NFA\))?"
SUBPROVISION = r"\(([A-Za-z0-9]+)\)"


def parse(urn: Column) -> Column:
    """struct(corpus, work, parts, as_of); null where the identifier isn't valid."""
    urn = F.trim(urn)
    halves = F.split(urn, "@")
    rest = F.split(halves[0], ":")
    get = lambda i: F.get(rest, F.lit(i))
    fields = F.struct(get(2).alias("corpus"), get(3).alias("work"), F.slice(rest, F.lit(5), F.size(rest)).alias("parts"), F.to_date(F.get(halves, F.lit(1))).alias("as_of"))
    return F.when(valid_urn(urn), fields)


def parsed(urn: Column, of: Callable[[Column], Column]) -> Column:
    """`of` the parsed identifier, which is parsed once however often `of` reads it."""
    return F.transform(F.array(parse(urn)), of)[0]


def render(u: Column) -> Column:
    """The identifier of a parsed one."""
    head = F.concat_ws(":", F.lit("urn:sg"), u["corpus"], u["work"], u["parts"])
    return F.concat(head, F.when(u["as_of"].isNotNull(), F.concat(F.lit("@"), u["as_of"].cast("string"))).otherwise(F.lit("")))


def work_urn(urn: Column) -> Column:
    return F.nullif(F.regexp_extract(urn, r"^(urn:sg:[a-z]+:[A-Za-z0-9._-]+)", 1), F.lit(""))


def child(urn: Column, part: Column) -> Column:
    """The part goes before the date; a part that is no segment gives null."""
    date = F.regexp_extract(urn, "(@.*)$", 1)
    return F.when(part.rlike("^[A-Za-z0-9._-]+$"), F.concat(F.regexp_replace(urn, "@.*$", ""), F.lit(":"), part, date))


def at(urn: Column, when: Column) -> Column:
    """Pin (or, with a null date, clear) the date; only acts and subsidiary legislation take one."""
    bare = F.regexp_replace(urn, "@.*$", "")
    return F.when(when.isNull(), bare).when(bare.rlike("^urn:sg:(act|sl):"), F.concat(bare, F.lit("@"), when.cast("string")))


def from_neutral_citation(citation: Column, corpus: str = "judgment") -> Column:
    """Null where there is no citation."""
    group = lambda i: F.regexp_extract(citation, CITATION, i)
    work = F.concat_ws("_", group(1), F.upper(F.translate(group(2), "()", "")), group(3))
    nfa = F.when(group(4) != "", F.lit("_NFA")).otherwise(F.lit(""))
    return F.when(group(1) != "", F.concat(F.lit(f"urn:sg:{corpus}:"), work, nfa))


def slug(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def provisional_decision(text: Column) -> Column:
    return F.when(slug(text) != "", F.concat(F.lit("urn:sg:pdpc:x-"), slug(text)))


def provision(code: Column, number: Column, as_of: Column | None = None) -> Column:
    """PC1871, 300(1)(a) to urn:sg:act:PC1871:s300-1-a."""
    base = F.trim(F.regexp_replace(number, SUBPROVISION, ""))
    tail = F.regexp_extract_all(number, F.lit(SUBPROVISION), F.lit(1))
    urn = F.concat(F.lit("urn:sg:act:"), code, F.lit(":s"), F.concat_ws("-", base, tail))
    return urn if as_of is None else F.concat(urn, F.coalesce(F.concat(F.lit("@"), as_of.cast("string")), F.lit("")))


def sitting(day: Column) -> Column:
    return F.concat(F.lit("urn:sg:hansard:"), day.cast("string"))


def section(day: Column, index: Column) -> Column:
    return F.concat(sitting(day), F.lit(":s"), index.cast("string"))


def speech(day: Column, index: Column, number: Column) -> Column:
    return F.concat(section(day, index), F.lit(":sp"), number.cast("string"))


def to_citation(urn: Column) -> Column:
    """The one display form of an identifier; an invalid one is shown as it is. Subsidiary legislation is shown by its last
    part, as its section."""
    return F.coalesce(parsed(urn, _display), urn)


def _display(u: Column) -> Column:
    bits, first, last = F.split(u["work"], "_"), F.get(u["parts"], F.lit(0)), F.try_element_at(u["parts"], F.lit(-1))
    case = F.concat(F.lit("["), bits[0], F.lit("] "), F.get(bits, F.lit(1)), F.lit(" "), F.get(bits, F.lit(2)), F.when(F.get(bits, F.lit(3)) == "NFA", F.lit(" (NFA)")).otherwise(F.lit("")))
    case = F.concat(case, F.when(first.startswith("para"), F.concat(F.lit(" at ["), F.substring(first, 5, 1000), F.lit("]"))).otherwise(F.lit("")))
    pieces = F.split(F.ltrim(F.when(u["corpus"] == "sl", last).otherwise(first), F.lit("s")), "-")
    tail = F.array_join(F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), lambda x: F.concat(F.lit("("), x, F.lit(")"))), "")
    law = F.concat(F.lit("s "), pieces[0], tail, F.lit(" of "), u["work"], F.coalesce(F.concat(F.lit(" (as at "), u["as_of"].cast("string"), F.lit(")")), F.lit("")))
    debate = F.concat(F.lit("Sing. Parl. Deb., "), F.coalesce(F.date_format(F.try_to_timestamp(u["work"], F.lit("yyyy-MM-dd")), "dd MMM yyyy"), u["work"]))
    return (
        F.when(u["corpus"].isin("judgment", "pdpc"), F.when(F.size(bits) >= 3, case).otherwise(u["work"]))
        .when(u["corpus"].isin("act", "sl"), F.when(F.size(u["parts"]) == 0, u["work"]).otherwise(law))
        .when(u["corpus"] == "hansard", debate)
    )
