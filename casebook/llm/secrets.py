"""Secret scans with a trigram inverted index, in DataFrame functions alone.

1. From each rule's regular expression a Boolean query over trigrams is derived: every match holds, for each conjunct,
   all trigrams of one of its alternatives. Rules without mandatory trigrams scan every text.
2. The index has a posting (trigram, doc_id) for each trigram of those queries that a text holds. Postings are
   intersected and united by document; what satisfies a query is that rule's candidate.
3. Candidates are verified: the regular expression runs on their texts alone.

Spans are code points, end exclusive. Null text is empty. A null doc_id can't be looked up, so such rows are verified
by every rule. Repeated rows are scanned each. Other columns are kept out of the result; an empty table gives no row.
"""

from __future__ import annotations

import re
import re._parser as sre
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import fresh, join_by_size, materialise, quoted


@dataclass(frozen=True)
class Rule:
    """Leftmost, non-overlapping matches of `pattern`; those whose `group` has under `least` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The three base kinds, in order, then what this method adds.
BASE = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
]
ADDED = [
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36}"),
    Rule("chat", r"xox[abprs]-[0-9A-Za-z-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
]
RULES = [*BASE, *ADDED]
#: Sets of strings beyond this many are given up; the query then asks for less, which is still a superset.
MOST_STRINGS = 128


def _strings(node) -> set[str] | None:
    """All strings that a node can match, lower-cased, or None if there are too many."""
    op, arg = node
    name = str(op)
    if name == "LITERAL":
        return {chr(arg).lower()}
    if name == "IN":
        out: set[str] = set()
        for o, a in arg:
            if str(o) == "LITERAL":
                out.add(chr(a).lower())
            elif str(o) == "RANGE" and a[1] - a[0] < 4:
                out |= {chr(c).lower() for c in range(a[0], a[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if name == "SUBPATTERN":
        return _joined(arg[3])
    if name == "BRANCH":
        sets = [_joined(x) for x in arg[1]]
        return None if None in sets else set().union(*sets)
    if name in ("MAX_REPEAT", "MIN_REPEAT"):
        low, high, body = arg
        if high == sre.MAXREPEAT or high > 8 or (one := _joined(body)) is None:
            return None
        out, now = set() if low else {""}, {""}
        for k in range(1, int(high) + 1):
            now = {a + b for a in now for b in one}
            if len(now) > MOST_STRINGS:
                return None
            if k >= low:
                out |= now
        return out
    if name == "AT":
        return {""}
    return None


def _joined(nodes) -> set[str] | None:
    out = {""}
    for node in nodes:
        if (part := _strings(node)) is None:
            return None
        out = {a + b for a in out for b in part}
        if len(out) > MOST_STRINGS:
            return None
    return out


def trigram_query(pattern: str) -> list[list[frozenset[str]]]:
    """Conjuncts; a conjunct is a list of alternatives, each a set of lower-case trigrams that all must occur."""
    conjuncts: list[list[frozenset[str]]] = []
    run = {""}

    def flush() -> None:
        nonlocal run
        sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in run}
        if frozenset() not in sets:
            least = [a for a in sets if not any(b < a for b in sets)]
            conjuncts.append(sorted(least, key=sorted))
        run = {""}

    def walk(nodes) -> None:
        nonlocal run
        for node in nodes:
            part = _strings(node)
            if part is not None and len(run) * len(part) <= MOST_STRINGS:
                run = {a + b for a in run for b in part}
                continue
            flush()
            name = str(node[0])
            if part is not None:
                run = part
            elif name == "SUBPATTERN":
                walk(node[1][3])
                flush()
            elif name in ("MAX_REPEAT", "MIN_REPEAT") and node[1][0] >= 1:
                walk(node[1][2])
                flush()

    walk(sre.parse(pattern))
    flush()
    return [c for i, c in enumerate(conjuncts) if c not in conjuncts[:i]]


def any_of(trigrams: list[str]) -> str:
    """A pattern that stands at each place where one of the trigrams begins, in its first group. Classes of their first,
    second and third characters turn most places away; then the trigrams branch by first and second character."""
    one = lambda chars: "[" + "".join(re.escape(c) for c in sorted(set(chars))) + "]"
    tree: dict[str, dict[str, list[str]]] = {}
    for a, b, c in trigrams:
        tree.setdefault(a, {}).setdefault(b, []).append(c)
    branches = (f"{re.escape(a)}(?:{'|'.join(re.escape(b) + one(c) for b, c in sorted(seconds.items()))})" for a, seconds in sorted(tree.items()))
    return f"(?={''.join(map(one, zip(*trigrams, strict=True)))})(?=({'|'.join(branches)}))"


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index over the named trigrams: trigram, doc_id, once a text. Texts are lower-cased and read in one
    pass, whatever the number of trigrams."""
    low = F.lower(F.coalesce("text", F.lit("")))
    held = F.array_distinct(F.regexp_extract_all(low, F.lit(any_of(trigrams)), F.lit(1)))
    return docs.select(F.explode(held).alias("trigram"), "doc_id")


def candidates(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """doc_id and kinds: the bits (1 << place in rules) of the rules whose trigram query the document satisfies.

    Only ids and trigrams are shuffled, once, by doc_id. The clauses are as many as the rules need, so they are
    broadcast.
    """
    spark = docs.sparkSession
    queries = [(i, q) for i, r in enumerate(rules) if (q := trigram_query(r.pattern))]
    clauses = [(i, c, a, t, len(alt)) for i, q in queries for c, alts in enumerate(q) for a, alt in enumerate(alts) for t in sorted(alt)]
    if not clauses:
        return spark.createDataFrame([], "doc_id long, kinds int")
    clause = F.broadcast(spark.createDataFrame(clauses, "rule int, conj int, alt int, trigram string, need int"))
    needs = F.broadcast(spark.createDataFrame([(i, len(q)) for i, q in queries], "rule int, conjs int"))
    posted = postings(docs.where(F.col("doc_id").isNotNull()), sorted({x[3] for x in clauses})).repartition("doc_id")
    found = posted.distinct().join(clause, "trigram").groupBy("doc_id", "rule", "conj", "alt", "need").count().where("count = need")
    met = found.groupBy("doc_id", "rule").agg(F.countDistinct("conj").alias("met")).join(needs, "rule").where("met = conjs")
    return met.groupBy("doc_id").agg(F.expr("bit_or(shiftleft(1, rule))").alias("kinds"))


def _spans(rule: Rule, place: int, wanted: Column) -> Column:
    """The rule's spans in `text`, as structs (start, place, end, kind), where `wanted` holds."""
    kind = "array<struct<start:int,place:int,end:int,kind:string>>"
    pattern = F.lit(rule.pattern)
    whole = F.regexp_extract_all("text", pattern, F.lit(0))
    checked = whole if not rule.group else F.regexp_extract_all("text", pattern, F.lit(rule.group))
    pairs = F.arrays_zip(F.split("text", rule.pattern).alias("gap"), whole.alias("hit"), checked.alias("part"))
    start = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as {kind})").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["hit"])
        span = F.struct(begin.alias("start"), F.lit(place).alias("place"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        keep = x["hit"].isNotNull() & (F.length(x["part"]) >= rule.least)
        return F.struct(F.coalesce(end, begin).alias("at"), F.when(keep, F.concat(acc["out"], F.array(span))).otherwise(acc["out"]).alias("out"))

    got = F.aggregate(pairs, start, step, lambda acc: acc["out"])
    return F.when(wanted & F.col("text").rlike(rule.pattern), got).otherwise(F.expr(f"cast(array() as {kind})"))


def scan(docs: DataFrame, rules: list[Rule] = RULES, keep: list[str] | None = None, name: str = "spans") -> DataFrame:
    """`keep` columns (doc_id unless named) and, as `name`, the spans: array of (start, place, end, kind), by start, then rule order.

    Candidates are counted; if they are few they are broadcast and no text is shuffled, beyond that both sides are.
    """
    keep = keep or ["doc_id"]
    indexed = [i for i, r in enumerate(rules) if trigram_query(r.pattern)]
    found = materialise(candidates(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), rules))
    rows = docs.select(F.struct(*quoted(keep)).alias("__row"), F.col("doc_id").cast("long").alias("__id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = join_by_size(rows, found.select(F.col("doc_id").alias("__id"), F.col("kinds").alias("__kinds")), ["__id"], "left", found.count())
    rows = rows.select("__row", "text", F.when(F.col("__id").isNull(), -1).otherwise(F.coalesce("__kinds", F.lit(0))).alias("__kinds"))
    wanted = lambda i: F.col("__kinds").bitwiseAND(1 << i) != 0 if i in indexed else F.lit(True)
    # One column a rule first: they are read several times below.
    rows = rows.select("__row", *(_spans(r, i, wanted(i)).alias(f"s{i}") for i, r in enumerate(rules)))
    return rows.select("__row.*", F.array_sort(F.concat(*(f"s{i}" for i in range(len(rules))))).alias(name))


def as_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(docs: DataFrame) -> DataFrame:
    """The query's columns: counts of the base kinds, their digest, and all spans."""
    n = len(BASE)
    base = F.filter("spans", lambda x: x["place"] < n)
    count = lambda i: F.size(F.filter("spans", lambda x: x["place"] == i)).cast("long")
    return scan(docs).select("doc_id", *(count(i).alias(f"n_{r.kind}") for i, r in enumerate(BASE)), F.sha2(F.encode(as_text(base), "UTF-8"), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mask: str = "[SECRET]") -> DataFrame:
    """The same rows and columns, each run of overlapping spans replaced by the mask; n_chars follows if it is there.

    Null texts stay null.
    """
    spans = fresh(docs.columns) + "spans"
    rows = scan(docs, keep=docs.columns, name=spans)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        fresh = x["start"] >= acc["at"]
        out = F.when(fresh, F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, x["start"] - acc["at"]), F.lit(mask))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["end"]).alias("at"), out.alias("out"))

    clean = F.aggregate(spans, start, step, lambda acc: F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    rows = rows.withColumn("text", F.when((F.size(spans) > 0) & F.col("text").isNotNull(), clean).otherwise(F.col("text"))).drop(spans)
    if "n_chars" in docs.columns:
        rows = rows.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*quoted(docs.columns))
