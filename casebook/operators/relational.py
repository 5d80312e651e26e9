"""Filters, joins, aggregates, sets and sequences of the corpus."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.sources import shared
from casebook.sources.shared import spread, stored

# ---- Filters


def filtered(df: DataFrame, *, isin: dict[str, list] | None = None, between: dict[str, tuple] | None = None, any_of: dict[str, list] | None = None, equals: dict[str, object] | None = None) -> DataFrame:
    """Only the predicates that were given; empty lists, null bounds and null values filter nothing."""
    for c, values in (isin or {}).items():
        df = df.where(F.col(c).isin(values)) if values else df
    for c, (low, high) in (between or {}).items():
        df = df.where(F.col(c) >= F.lit(low)) if low is not None else df
        df = df.where(F.col(c) <= F.lit(high)) if high is not None else df
    for c, values in (any_of or {}).items():
        df = df.where(F.arrays_overlap(c, F.array(*map(F.lit, values)))) if values else df
    for c, value in (equals or {}).items():
        df = df.where(F.col(c) == F.lit(value)) if value is not None else df
    return df


def json_field(path: str, kind: str = "string") -> Column:
    """A field of `meta`; JSON null and a missing field are null."""
    return F.get_json_object("meta", f"$.{path}").cast(kind)


def json_filtered(docs: DataFrame, *, between: dict[str, tuple] | None = None, equals: dict[str, str] | None = None, any_of: dict[str, list[str]] | None = None) -> DataFrame:
    """Predicates on fields of `meta`: number ranges (a null never matches), equality, any of the values in an array.
    What isn't given, or is empty, filters nothing."""
    for path, (low, high) in (between or {}).items():
        docs = docs.where(json_field(path, "double") >= F.lit(low)) if low is not None else docs
        docs = docs.where(json_field(path, "double") <= F.lit(high)) if high is not None else docs
    for path, value in (equals or {}).items():
        docs = docs.where(json_field(path) == F.lit(value)) if value else docs
    for path, values in (any_of or {}).items():
        docs = docs.where(F.arrays_overlap(F.from_json(json_field(path), "array<string>"), F.array(*map(F.lit, values)))) if values else docs
    return docs


def same_identity(candidates: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows whose urn or canonical_urn is wanted: two equi-joins, so no disjunction reaches a join."""
    first = candidates.join(wanted, candidates.urn == wanted.wanted, "left_semi")
    return first.unionByName(candidates.where("canonical_urn is null or canonical_urn <> urn").join(wanted, F.col("canonical_urn") == F.col("wanted"), "left_semi")).distinct()


def canonical(requests: DataFrame, docs: DataFrame) -> DataFrame:
    """requested, status (ok, ambiguous_publication, not_found), urn, publications."""
    j = requests.join(docs.select(F.col("canonical_urn").alias("requested"), "urn"), "requested", "left").groupBy("requested").agg(F.count("urn").alias("publications"), F.min("urn").alias("urn"))
    status = F.when(F.col("publications") == 0, "not_found").when(F.col("publications") == 1, "ok").otherwise("ambiguous_publication")
    return j.select("requested", status.alias("status"), F.when(F.col("publications") == 1, F.col("urn")).alias("urn"), "publications")


def pending(plan: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    return plan.join(done, key, "left_anti")


def finished(plan: DataFrame, done: DataFrame, key: list[str]) -> DataFrame:
    return plan.join(done, key, "left_semi")


def latest(df: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the order (limited before the shuffle, so a hot key sends one row a task)."""
    w = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def upsert(old: DataFrame, new: DataFrame, key: list[str], seq: str) -> DataFrame:
    """New rows replace old ones of their key; the last of new rows wins."""
    last = latest(new, key, [F.col(seq).desc()])
    return old.join(last, key, "left_anti").unionByName(last)


def rollup_parts(children: DataFrame, parent: str, position: str, child: str) -> DataFrame:
    return children.groupBy(parent).agg(F.transform(F.array_sort(F.collect_list(F.struct(position, child))), lambda x: x[child]).alias("parts"))


# ---- Aggregates


def corpus_stats(docs: DataFrame) -> DataFrame:
    return docs.groupBy("corpus").agg(F.count(F.lit(1)).alias("document_count"), F.min("issued").alias("earliest"), F.max("issued").alias("latest")).orderBy("corpus")


def share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.round(F.lit(100.0) * part / whole, 2))


def quality(docs: DataFrame, metrics: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Per corpus, in one pass: for each metric the rows, those that pass, and the percentage."""
    aggs = []
    for name, (of, good) in metrics.items():
        aggs += [F.count_if(of).alias(f"{name}_rows"), F.count_if(of & good).alias(f"{name}_passed")]
    out = docs.groupBy("corpus").agg(*aggs)
    return out.select("*", *(share(F.col(f"{n}_passed"), F.col(f"{n}_rows")).alias(f"{n}_pct") for n in metrics))


#: What each corpus counts: the rows that a metric is of, those that pass, and the names of rows, passed and percentage.
QUALITY = {
    "hansard": [("speeches", "attributed", "attribution_pct", "level = 'speech'", "get_json_object(meta, '$.speaker') is not null")],
    "judgment": [("judgments", None, "full_text_pct", "level = 'judgment'", "length(text) > 0")],
    "pdpc": [("decisions", None, "citation_pct", "true", "get_json_object(meta, '$.citation_provisional') = 'false'")],
    "act": [("provisions", None, "commencement_pct", "true", "in_force_from is not null")],
    "sl": [("provisions", None, "commencement_pct", "true", "in_force_from is not null")],
}
#: Counts that are there even when they are 0.
COUNTED = {"hansard": [("sittings", "level = 'sitting'"), ("vernacular_speeches", "level = 'vernacular'")]}


def corpus_quality(docs: DataFrame) -> DataFrame:
    """corpus, quality: each corpus's own metrics as JSON, all in one pass; what is of no row is left out."""
    aggs, values, at = [], {}, 0
    for corpus, metrics in QUALITY.items():
        fields = []
        for rows, passed, pct, of, good in metrics:
            n, k = f"n{at}", f"k{at}"
            at += 1
            own = (F.col("corpus") == corpus) & F.expr(of)
            aggs += [F.count_if(own).alias(n), F.count_if(own & F.expr(good)).alias(k)]
            some = F.when(F.col(n) > 0, F.col(n))
            fields += [some.alias(rows), *([F.when(F.col(n) > 0, F.col(k)).alias(passed)] if passed else []), share(F.col(k), F.col(n)).alias(pct)]
        for name, of in COUNTED.get(corpus, []):
            n = f"n{at}"
            at += 1
            aggs.append(F.count_if((F.col("corpus") == corpus) & F.expr(of)).alias(n))
            fields.append(F.col(n).alias(name))
        values[corpus] = F.to_json(F.struct(*fields))
    out = F.lit("{}")
    for corpus, value in values.items():
        out = F.when(F.col("corpus") == corpus, value).otherwise(out)
    return docs.groupBy("corpus").agg(*aggs).select("corpus", out.alias("quality"))


def corpus_meta(docs: DataFrame) -> DataFrame:
    """One row a corpus: counts, first and last issue, last retrieval, the newest parser's version, quality."""
    p = F.col("provenance")
    newest = F.max(F.struct(p["parser_rev"].alias("rev"), p["adapter_version"].alias("version")))
    stats = docs.groupBy("corpus").agg(F.count(F.lit(1)).alias("document_count"), F.min("issued").alias("earliest"), F.max("issued").alias("latest"), F.max(p["retrieved_at"]).alias("last_fetch"), newest.alias("by"))
    rows = stats.join(corpus_quality(docs), "corpus")
    return rows.select("corpus", "document_count", "earliest", "latest", "last_fetch", F.lit(None).cast("double").alias("coverage_pct"), F.col("by.version").alias("adapter_version"), F.col("by.rev").alias("parser_rev"), "quality")


def text_metrics(docs: DataFrame, corpus: str = "hansard") -> DataFrame:
    """speeches, speakers (distinct), characters of each language of a corpus."""
    rows = docs.where(F.col("corpus") == corpus)
    return rows.groupBy("language").agg(F.count_if(F.col("level") == "speech").alias("speeches"), F.count_distinct(F.get_json_object("meta", "$.speaker")).alias("speakers"), F.sum(F.length("text")).alias("characters"))


def run_counters(units: DataFrame, status: str) -> DataFrame:
    """Units by what became of them."""
    return units.groupBy(F.col(status).alias("status")).agg(F.count(F.lit(1)).alias("n"))


def numbered(rows: DataFrame, key: list[str], order: list[str], name: str = "idx") -> DataFrame:
    """Rows with their place from 0 within a key."""
    return rows.withColumn(name, (F.row_number().over(Window.partitionBy(*key).orderBy(*order)) - 1).cast("long"))


def ordered_distinct(values: Column) -> Column:
    """Of an array of structs whose first field is a position: the second fields in order, each where it is first."""
    return F.array_distinct(F.transform(F.array_sort(values), lambda x: x["value"]))


def citing_counts(refs: DataFrame) -> DataFrame:
    """to_urn, citing, first_citing of resolved edges."""
    return refs.where("to_urn is not null").groupBy("to_urn").agg(F.count(F.lit(1)).alias("citing"), F.min("from_urn").alias("first_citing"))


def resolve_aliases(named: DataFrame, aliases: DataFrame, name: str) -> DataFrame:
    """Rows with the urn of their alias, null where there is none."""
    return named.join(aliases.select(F.col("alias").alias(name), F.col("urn").alias("alias_urn")).dropDuplicates([name]), name, "left")


def penalty_totals(decisions: DataFrame, identity: str, penalty: str) -> DataFrame:
    """Over distinct identities; an identity with conflicting or missing amounts is unknown and not summed."""
    one = decisions.groupBy(identity).agg(F.count(F.lit(1)).alias("n"), F.count(penalty).alias("known"), F.min(penalty).alias("lo"), F.max(penalty).alias("hi"))
    sure = one.select("n", F.when((F.col("known") == F.col("n")) & (F.col("lo") == F.col("hi")), F.col("hi")).alias("penalty"))
    return sure.agg(F.count(F.lit(1)).alias("count"), F.sum("penalty").alias("total_penalty"), F.sum(F.col("penalty").isNull().cast("long")).alias("unknown_penalties"), F.coalesce(F.sum("n"), F.lit(0)).alias("publications"))


# ---- Sequences


def islands(rows: DataFrame, key: str, pos: str, starts: Column) -> DataFrame:
    """`grp`: how many rows up to here start a group; 0 is what comes before the first."""
    w = Window.partitionBy(key).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("grp", F.sum(F.coalesce(starts, F.lit(False)).cast("long")).over(w))


def joined(rows: DataFrame, key: list[str], pos: str, text: str, by: str = "\n\n") -> DataFrame:
    return rows.groupBy(*key).agg(F.min(pos).alias("first_pos"), F.count(F.lit(1)).alias("blocks"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(text).alias("t")))), lambda x: x["t"]), by).alias("text"))


def forward_fill(rows: DataFrame, key: str, pos: str, value: Column, name: str) -> DataFrame:
    w = Window.partitionBy(key).orderBy(pos).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(name, F.last(value, ignorenulls=True).over(w))


def printed_sequence(rows: list[tuple[tuple[int, str], int]]) -> list[int] | None:
    """Places of the longest strictly increasing run of numbers; of equals the one with most well-printed ones; None if
    the best is not unique.

    A tree over the ranks of numbers keeps, for each prefix, the best (length, well-printed) that ends there, one place
    that has it and whether there is more than one way to it: n log n for n paragraphs.
    """
    if not rows:
        return []
    rank = {x: i + 1 for i, x in enumerate(sorted({number for number, _ in rows}))}
    none = (0, 0, -1, False)  # length, good, place, several ways
    held = [none] * (len(rank) + 1)

    def better(x: tuple, y: tuple) -> tuple:
        if x[:2] != y[:2]:
            return x if x[:2] > y[:2] else y
        return x if x[2] == y[2] or not x[0] else (*x[:3], True)

    back, top = [], none
    for i, (number, good) in enumerate(rows):
        before, at = none, rank[number] - 1
        while at:
            before = better(before, held[at])
            at &= at - 1
        back.append(before[2])
        own = (before[0] + 1, before[1] + good, i, before[3])
        top = better(top, own)
        at = rank[number]
        while at < len(held):
            held[at] = better(held[at], own)
            at += at & -at
    if top[3]:
        return None
    path, at = [], top[2]
    while at >= 0:
        path.append(at)
        at = back[at]
    return path[::-1]


def printed_paragraphs(rows: DataFrame, key: str, pos: str, number: str, suffix: str, good: str) -> DataFrame:
    """key, pos of the paragraphs in each document's printed sequence; documents with an ambiguous one give pos null.

    A row is one document's paragraphs, so documents share Arrow batches and a task holds some judgments at a time.
    """
    rows = rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(pos).cast("long").alias("p"), F.col(number).cast("long").alias("n"), F.coalesce(suffix, F.lit("")).alias("s"), F.col(good).cast("long").alias("g")))).alias("list"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for k, items in zip(pdf[key], pdf["list"], strict=True):
                path = printed_sequence([((x["n"], x["s"]), x["g"]) for x in items])
                out += [(k, None)] if path is None else [(k, items[i]["p"]) for i in path]
            yield pd.DataFrame({key: [x[0] for x in out], pos: pd.array([x[1] for x in out], "Int64")})

    return rows.mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, {pos} long")


def chunk_by_budget(rows: DataFrame, key: str, pos: str, size: str, budget: int) -> DataFrame:
    """key, pos, chunk: a new chunk starts where the next size would exceed the budget. A task holds a batch of rows,
    however many its keys have."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, used, chunk = object(), 0, 0
        for pdf in batches:
            out = []
            for k, n in zip(pdf[key].astype(object).where(pdf[key].notna(), None), pdf[size], strict=True):
                if k != last:
                    last, used, chunk = k, 0, 0
                if used and used + n > budget:
                    used, chunk = 0, chunk + 1
                used += n
                out.append(chunk)
            yield pd.DataFrame({key: pdf[key], pos: pdf[pos], "chunk": pd.array(out, "int64")})

    ordered = rows.select(key, pos, size).repartition(key).sortWithinPartitions(key, pos)
    return ordered.mapInPandas(run, f"{key} {rows.schema[key].dataType.simpleString()}, {pos} {rows.schema[pos].dataType.simpleString()}, chunk long")


# ---- References


def citations(docs: DataFrame, key: str, text: str, pattern: str) -> DataFrame:
    """key, ord, raw for each match of a citation pattern in running text."""
    return docs.select(key, F.posexplode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("ord", "raw"))


def find_citing(refs: DataFrame, docs: DataFrame, urn: Column, kind: str | None = None) -> DataFrame:
    hits = refs.where(F.col("to_urn") == urn)
    hits = hits.where(F.col("kind") == kind) if kind else hits
    return hits.join(docs, F.col("from_urn") == docs.urn)


#: Rows of a word on the left that one task pairs with those on the right; a word with more is split.
WORD_ROWS = 20_000


def _word_sets(rows: DataFrame, key: str, text: str) -> DataFrame:
    """key, words: each row's distinct words, in order. Rows without a word are left out."""
    words = F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))))
    return rows.select(F.col(key), words.alias("words")).where(F.size("words") > 0)


def _classes(sets: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows with the class of their word set, and the classes with their words."""
    held = sets.withColumn("cls", F.unhex(F.sha2(F.array_join("words", " "), 256)))
    return held.select(key, "cls"), held.select("cls", "words").dropDuplicates(["cls"])


def _word_classes(rows: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    return _classes(_word_sets(rows, key, text), key)


def overlap_needed(n: Column, m: Column, least: float) -> Column:
    """Words that sets of n and m must share for a similarity of `least`: both / (n + m - both) >= least."""
    return F.ceil(F.lit(least / (1 + least)) * (n + m) - F.lit(1e-9))


def word_prefixes(left: DataFrame, right: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """For each side's classes (cls, words): cls, n, `shared` (the words that the other side has too, rarest first) and from
    which place on they stand, so that a set's place counts all its words, those of one side alone before all others.

    A set that has enough words in common with another has one of them among its first n - ceil(least n) + 1.
    """
    tokens = [x.select("cls", F.size("words").alias("n"), F.explode("words").alias("word")) for x in (left, right)]
    counts = [x.groupBy("word").agg(F.count(F.lit(1)).alias(f"f{i}")) for i, x in enumerate(tokens)]
    both = stored(counts[0].join(counts[1], "word"))
    word = F.struct((F.col("f0") + F.col("f1")).alias("f"), "word", F.ceil(F.col("f0") / WORD_ROWS).cast("int").alias("parts"))
    listed = [stored(x.join(both, "word").groupBy("cls", "n").agg(F.array_sort(F.collect_list(word)).alias("shared")).withColumn("first", F.col("n") - F.size("shared"))) for x in tokens]
    return listed[0], listed[1]


def candidate_classes(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """a, b: classes that share a word of both prefixes, and whose sizes and places there leave room for enough others. A
    word that is frequent on the left is dealt out to several tasks, each of which gets the right's rows of it."""

    def prefix(rows: DataFrame) -> DataFrame:
        # a slice of no length would be an error where all of a prefix stands on one side alone
        keep = F.col("n") - F.ceil(F.col("n") * least - F.lit(1e-9)).cast("int") + 1 - F.col("first")
        own = rows.where(keep > 0).select("cls", "n", "first", F.posexplode(F.slice("shared", F.lit(1), keep)).alias("i", "w"))
        return own.select("cls", "n", (F.col("first") + F.col("i")).alias("pos"), "w.word", "w.parts")

    a = prefix(left).select(F.col("cls").alias("a"), F.col("n").alias("na"), F.col("pos").alias("pa"), "word", F.pmod(F.xxhash64("cls"), F.col("parts")).cast("int").alias("part"))
    b = prefix(right).select(F.col("cls").alias("b"), F.col("n").alias("nb"), F.col("pos").alias("pb"), "word", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    room = F.least(F.col("na") - F.col("pa"), F.col("nb") - F.col("pb")) >= overlap_needed(F.col("na"), F.col("nb"), least)
    sizes = F.least("na", "nb") >= F.greatest("na", "nb") * least - F.lit(1e-9)
    return a.join(b, ["word", "part"]).where(sizes & room).select("a", "b").distinct()


#: Words of all rows of a right side that each task of the left may hold.
HELD_WORDS = 200_000
#: Common words and counts that are held at once for some rows of the left.
HITS = 2_000_000


def overlaps(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """a, b, na, nb, both: of each left row (a, words) the right ones (b, words) that share enough words for a similarity of
    `least`, how many words each has and how many both. The right side's words, which must be few, are an index in each
    task, so no pair and no word is shuffled."""
    table = right.select("b", "words").toArrow()
    lists = table["words"].combine_chunks()
    ids, sizes = table["b"].combine_chunks(), lists.value_lengths().to_numpy().astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    vocabulary, word = coded.dictionary, coded.indices.to_numpy()
    # of each word the rows that have it, one word after another
    having = np.repeat(np.arange(len(sizes)), sizes)[np.argsort(word, kind="stable")]
    frequency = np.bincount(word, minlength=len(vocabulary))
    begin = np.cumsum(frequency) - frequency

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = batch.column(1).value_lengths().to_numpy().astype(np.int64)
            at = pc.index_in(batch.column(1).flatten(), value_set=vocabulary).fill_null(-1).to_numpy()
            row, at = np.repeat(np.arange(len(own)), own)[at >= 0], at[at >= 0]
            # a row costs its hits and a count for each right row
            group = np.cumsum(np.bincount(row, frequency[at], len(own)) + len(sizes)) // HITS
            cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(own)]
            for low, high in zip(cuts[:-1], cuts[1:], strict=True):
                some = slice(*np.searchsorted(row, [low, high]).tolist())
                n = frequency[at[some]]
                ends = np.cumsum(n)
                hits = having[np.repeat(begin[at[some]] - ends + n, n) + np.arange(n.sum())]
                both = np.bincount(np.repeat(row[some] - low, n) * len(sizes) + hits, minlength=(high - low) * len(sizes))
                pair = np.flatnonzero(both)
                i, j, both = pair // len(sizes) + low, pair % len(sizes), both[pair]
                enough = both >= (own[i] + sizes[j] - both) * least - 1e-9
                i, j, both = i[enough], j[enough], both[enough]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(i)), ids.take(pa.array(j)), pa.array(own[i]), pa.array(sizes[j]), pa.array(both)], names=["a", "b", "na", "nb", "both"])

    kind_a, kind_b = (x.schema[c].dataType.simpleString() for x, c in ((left, "a"), (right, "b")))
    return left.select("a", "words").mapInArrow(run, f"a {kind_a}, b {kind_b}, na long, nb long, both long")


def similar_pairs(left: DataFrame, right: DataFrame, key: str, other: str, text: str, other_text: str, least: float) -> DataFrame:
    """All pairs whose word sets' Jaccard similarity, to six places, is at least `least` (over 0): a set-similarity join.

    If the right side's rows have HELD_WORDS words at most, tasks of the left hold them all as an index, count what each of
    their rows shares with each of them, and are done. Else equal word sets are compared once, and words are ordered rarest
    first; only a set's first words are join keys, sizes and places bound the overlap, and what is left is verified.
    Repeated rows are paired each; null and empty texts with nothing.
    """
    least_exact = least - 5e-7  # what rounds up to `least`
    held_b = stored(_word_sets(right, other, other_text))
    held_a = _word_sets(spread(left.select(key, text), key, text), key, text)
    similarity = lambda both: F.round(both / (F.col("na") + F.col("nb") - both), 6).alias("confidence")
    if (held_b.agg(F.sum(F.size("words"))).first()[0] or 0) <= HELD_WORDS:
        found = overlaps(held_a.withColumnRenamed(key, "a"), held_b.withColumnRenamed(other, "b"), least_exact)
        return found.select(F.col("a").alias(key), F.col("b").alias(other), similarity(F.col("both"))).where(F.col("confidence") >= least)
    (rows_a, sets_a), (rows_b, sets_b) = _classes(stored(held_a), key), _classes(held_b, other)
    listed_a, listed_b = word_prefixes(sets_a, sets_b, least_exact)
    pairs = candidate_classes(listed_a, listed_b, least_exact)
    words = lambda x, side: x.select(F.col("cls").alias(side), F.col("n").alias(f"n{side}"), F.transform("shared", lambda w: w["word"]).alias(f"w{side}"))
    sure = pairs.join(words(listed_a, "a"), "a").join(words(listed_b, "b"), "b").select("a", "b", similarity(F.size(F.array_intersect("wa", "wb")))).where(F.col("confidence") >= least)
    return sure.join(rows_a.withColumnRenamed("cls", "a"), "a").join(rows_b.withColumnRenamed("cls", "b"), "b").select(key, other, "confidence")


#: Keys over which one bill's chains are dealt out.
SALTS = 64


def intent_chain(docs: DataFrame, refs: DataFrame, least: float = 0.5) -> DataFrame:
    """provision, act, bill, sitting, section, confidence, speech: provision to the acts that enacted (its parent) or amended
    it (`amends`), to their bills (`enacted_by`), to debate sections with a title like the bill's, to their speeches.

    The confidence is that of the chain's edges multiplied; a section without speeches has a null one.
    """
    sure = F.coalesce(F.col("confidence"), F.lit(1.0))
    provisions = docs.where(F.col("corpus").isin("act", "sl") & F.col("parent").isNotNull())
    own = provisions.select(F.col("urn").alias("provision"), F.col("parent").alias("act"), F.lit(1.0).alias("c1"))
    amended = refs.where("kind = 'amends'").select(F.col("to").alias("provision"), F.col("from").alias("act"), sure.alias("c1")).join(provisions.select(F.col("urn").alias("provision")), "provision", "left_semi")
    acts = own.unionByName(amended).groupBy("provision", "act").agg(F.max("c1").alias("c1"))
    bills = refs.where("kind = 'enacted_by' and to is not null").groupBy(F.col("from").alias("act"), F.col("to").alias("bill")).agg(F.max(sure).alias("c2"))
    level = F.get_json_object("meta", "$.level")
    sections = docs.where((F.col("corpus") == "hansard") & (level == "section")).select(F.col("urn").alias("section"), F.col("parent").alias("sitting"), F.col("title").alias("heading"))
    named = docs.where("corpus = 'bill'").select(F.col("urn").alias("bill"), "title")
    debated = similar_pairs(named, sections, "bill", "section", "title", "heading", least)
    speeches = docs.where((F.col("corpus") == "hansard") & (level == "speech")).select(F.col("parent").alias("section"), F.col("urn").alias("speech"))
    said = stored(debated.join(sections.select("section", "sitting"), "section").join(speeches, "section", "left"))
    # A bill's provisions meet all its speeches, which is the result's size: both sides are made first, so the product is never
    # shuffled, and a bill's is dealt out over SALTS keys by provisions, and by speeches so that a task holds TASK_ROWS of them.
    # Rounding costs more than all else of a row, so a provision brings its product with each value that the bill's sections
    # have, and a section says which of them is its own.
    parts = max(1, -(-said.count() // shared.TASK_ROWS))
    values = said.groupBy("bill").agg(F.array_sort(F.collect_set("confidence")).alias("values"))
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)).cast("array<bigint>"))
    enacted = acts.join(bills, "act").join(values, "bill").select("bill", "provision", "act", F.transform("values", lambda x: F.round(F.col("c1") * F.col("c2") * x, 6)).alias("rounded"), upto(parts).alias("part"))
    enacted = enacted.withColumn("salt", F.pmod(F.xxhash64("provision", "act"), F.lit(SALTS)) * parts + F.col("part")).drop("part")
    said = said.join(values, "bill").select("bill", "sitting", "section", "speech", (F.array_position("values", F.col("confidence")) - 1).cast("int").alias("which"), upto(SALTS).alias("salt"))
    said = said.withColumn("salt", F.col("salt") * parts + F.pmod(F.xxhash64("section", "speech"), F.lit(parts)))
    chain = spread(enacted, "bill", "salt", least=4 * parts).join(spread(said, "bill", "salt", least=4 * parts), ["bill", "salt"])
    return chain.select("provision", "act", "bill", "sitting", "section", F.get("rounded", F.col("which")).alias("confidence"), "speech")
