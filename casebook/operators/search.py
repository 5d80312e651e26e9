"""Full-text search: inverted index, MATCH queries, BM25, the best k, snippets.

The index is three tables of Parquet, and the corpus's statistics beside them. `postings` has a row a term, document and
column (term, id, col, n: the length of the document, and pos: the places of all its occurrences), is read as a row an
occurrence, and serves phrases, NEAR and columns. `frequencies` has a row a term and
document, ordered by term and falling impact (the part of BM25 that doesn't depend on the query): its pages are the blocks
of a posting list, and Parquet's page index holds the greatest impact of each, so that a reader skips what is below a cut.
Of an index of one column it is columns of `postings`, which are in that order then. `levels` counts a term's rows by steps
of impact.

A query of single words reads frequencies; others read the postings of all their terms once and shuffle them by id;
phrases, counts, and the Boolean answer (an expression over the leaves' counts) are made there, so there is no join of
posting lists. The best k of words joined by AND or OR are found from the top of the lists, by growing waves, until no
document that wasn't read far enough can reach them. Statistics cover the whole index, whatever filters a search has.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from casebook.functions.text import plain_terms, stemmed_terms, terms
from casebook.sources.shared import removed, spread, stored

K1, B, LEAST_IDF = 1.2, 0.75, 1e-6
OPEN, CLOSE, GAP, SNIPPET = "<<", ">>", " ... ", 24


#: Steps of impact, which is below 1; rows of a page, which is what a reader skips or decodes.
STEPS, PAGE = 64, 512
#: Rows that a task sorts, and characters that it splits into terms, where a corpus is large.
RANGE_ROWS, TASK_CHARS = 1_000_000, 8_000_000
#: Words that are grouped at once; a document with more is grouped alone.
WORDS = 1 << 20
POSTING, FREQUENCY = ("term", "id", "col", "n", "pos"), ("term", "id", "tf", "n", "impact")


@dataclass
class Index:
    postings: DataFrame  # id, col, pos, term, n
    lengths: DataFrame  # id, n
    stem: bool
    statistics: DataFrame | None = None  # one row: docs, mean, built (the mean for which impacts were made)
    frequencies: DataFrame | None = None  # term, id, tf, n, impact
    levels: DataFrame | None = None  # term, level, rows: of which impact is at least level / STEPS and below the next
    listed: DataFrame | None = None  # id, n, t0, t1, ... (terms of each column): what a new index is made of
    columns: tuple[str, ...] = ()
    grouped: DataFrame | None = None  # the postings with an array of places, as they are stored

    def stats(self) -> DataFrame:
        """docs, mean: read where they were written, else summed over the lengths."""
        return self.statistics if self.statistics is not None else self.lengths.agg(F.count(F.lit(1)).alias("docs"), F.avg("n").alias("mean"))

    def written(self, path: str) -> Index:
        """The same index from Parquet, clustered by term so that a query reads few row groups."""
        spark = self.postings.sparkSession
        if self.listed is not None:  # texts are tokenised once, not for each table and each sample of a range
            rows = stored(_grouped(self.listed, self.columns), f"{path}/listed")
            lengths = rows.where(F.col("term").isNull()).select("id", F.explode("pos").alias("pos"), "n").drop("pos")
            held = rows.where(F.col("term").isNotNull())
            Index(occurring(held), lengths, self.stem, columns=self.columns, grouped=held)._tables(path)
            removed(spark, f"{path}/listed")
        else:
            self._tables(path)
        return opened(spark, path, self.stem)

    def _tables(self, path: str) -> None:
        spark = self.postings.sparkSession
        self.lengths.write.mode("overwrite").parquet(f"{path}/lengths")
        stats = Index(self.postings, spark.read.parquet(f"{path}/lengths"), self.stem).stats()
        stats.withColumn("built", F.col("mean")).coalesce(1).write.mode("overwrite").parquet(f"{path}/statistics")
        write_lists(self, path, spark.read.parquet(f"{path}/statistics").first()["built"])


def impact(tf: Column, n: Column, mean: Column) -> Column:
    return tf / (tf + K1 * (1 - B + B * n / mean))


def ranged(rows: DataFrame, n: int, *order: str | Column) -> DataFrame:
    """The rows in order, in ranges whose number grows with theirs, so that a task's sort stays in memory."""
    parts = -(-n // RANGE_ROWS)
    few = parts <= int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartitionByRange(*order) if few else rows.repartitionByRange(parts, *order)).sortWithinPartitions(*order)


def write_lists(index: Index, path: str, built: float | None) -> None:
    """postings, frequencies and levels of an index; `built` is the mean length for the impacts."""
    spark = index.postings.sparkSession
    # what a lost executor must not change is written before it is read twice
    held = index.grouped if index.grouped is not None else stored(index.postings.groupBy("id", "col", "term", "n").agg(F.collect_list("pos").alias("pos")), f"{path}/counted")
    n, weight = held.count(), impact(F.col("tf"), F.col("n"), F.lit(built or 1.0))
    lists = lambda rows: rows.write.mode("overwrite").option("compression", "zstd").option("parquet.page.row.count.limit", PAGE)
    if len(index.columns) == 1:  # a posting is a frequency too: one shuffle, of what neither can be reckoned from, and one table
        tf = F.size("pos").cast("long")
        own = impact(tf, F.col("n"), F.lit(built or 1.0))
        rows = ranged(held.select("term", "id", "n", "pos"), n, "term", own.desc(), "id")
        lists(rows.select("term", "id", F.lit(index.columns[0]).alias("col"), "n", "pos", tf.alias("tf"), own.alias("impact"))).parquet(f"{path}/postings")
    else:
        ranged(held.select(*POSTING), n, "term", "id").write.mode("overwrite").option("compression", "zstd").parquet(f"{path}/postings")
        tf = stored(held.groupBy("id", "n", "term").agg(F.sum(F.size("pos")).alias("tf")), f"{path}/summed")
        rows = tf.select("term", "id", "tf", "n", weight.alias("impact"))
        lists(ranged(rows, n, "term", F.col("impact").desc(), "id")).parquet(f"{path}/frequencies")
    levels = frequencies(spark, path).groupBy("term", F.floor(F.col("impact") * STEPS).cast("int").alias("level")).agg(F.count(F.lit(1)).alias("rows"))
    levels.sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/levels")
    for x in ("counted", "summed"):
        removed(spark, f"{path}/{x}")


def postings(spark, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/postings").select(*POSTING)


def frequencies(spark, path: str) -> DataFrame:
    rows = spark.read.parquet(f"{path}/postings")
    return (rows if "impact" in rows.columns else spark.read.parquet(f"{path}/frequencies")).select(*FREQUENCY)


def opened(spark, path: str, stem: bool = False) -> Index:
    """An index that `written` wrote."""
    t = {x: spark.read.parquet(f"{path}/{x}") for x in ("lengths", "levels", "statistics")}
    held = postings(spark, path)
    return Index(occurring(held), t["lengths"], stem, t["statistics"], frequencies(spark, path), t["levels"], grouped=held)


def occurring(grouped: DataFrame) -> DataFrame:
    """A row an occurrence of stored postings."""
    return grouped.select("id", "col", F.explode("pos").alias("pos"), "term", "n")


def _by_id(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of rows in order of id, cut anew: rows of an id stay together, and have WORDS words at most otherwise."""
    rest = None
    for batch in batches:
        rows = pa.concat_batches([rest, batch]) if rest is not None else batch
        if not rows.num_rows:
            continue
        code = rows.column(0).dictionary_encode("encode").indices.to_numpy()
        begin = np.flatnonzero(np.diff(code, prepend=-1))
        words = np.cumsum(sum(x.value_lengths().to_numpy().astype(np.int64) for x in rows.columns[2:]))
        group = words[begin] // WORDS
        cuts = [0, *begin[1:][np.diff(group) > 0].tolist(), int(begin[-1])]
        yield from (rows.slice(low, high - low) for low, high in zip(cuts[:-1], cuts[1:], strict=True) if low < high)
        rest = rows.slice(int(begin[-1]))
    if rest is not None:
        yield rest


def _grouped(listed: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Stored postings of documents that are dealt out by id, so nothing is shuffled; of each document a row without a term
    too, with an entry for each row of its id and length. Words are numbered and sorted as numbers, some documents at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _by_id(batches):
            ids, n = rows.column(0), rows.column(1)
            lengths = n.to_numpy()
            code = ids.dictionary_encode("encode").indices.to_numpy().astype(np.int64)
            _, first, doc, same = np.unique(code * (int(lengths.max()) + 1) + lengths, return_index=True, return_inverse=True, return_counts=True)
            of = lambda d: [ids.take(pa.array(first[d])), n.take(pa.array(first[d]))]  # noqa: B023, E731
            made = lambda d, col, term, ends, pos: pa.RecordBatch.from_arrays([*of(d), pa.array([col], pa.string()).take(pa.array(np.zeros(len(d), np.int8))), term, pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(pos.astype(np.int32)))], names=["id", "n", "col", "term", "pos"])  # noqa: B023, E731
            yield made(np.arange(len(first)), None, pa.nulls(len(first), pa.string()), np.concatenate([[0], np.cumsum(same)]), np.full(len(ids), -1))
            for col, lists in zip(columns, rows.columns[2:], strict=True):
                held, coded = lists.value_lengths().to_numpy().astype(np.int64), lists.flatten().dictionary_encode()
                total, terms_ = int(held.sum()), len(coded.dictionary)
                if not total:
                    continue
                key = np.repeat(doc, held) * terms_ + coded.indices.to_numpy()
                bits, at = total.bit_length(), np.arange(total)
                if (len(first) * terms_).bit_length() + bits < 63:  # a number and its place sort as one number, and faster
                    order = np.sort((key << bits) | at)
                    key, order = order >> bits, order & ((1 << bits) - 1)
                else:
                    order = np.argsort(key, kind="stable")
                    key = key[order]
                begin = np.flatnonzero(np.diff(key, prepend=-1))
                pos = (at - np.repeat(np.cumsum(held) - held, held))[order]
                yield made(key[begin] // terms_, col, coded.dictionary.take(pa.array(key[begin] % terms_)), np.append(begin, total), pos)

    kind = listed.schema["id"].dataType.simpleString()
    words = listed.select("id", "n", *(f"t{i}" for i in range(len(columns)))).sortWithinPartitions("id")
    return words.mapInArrow(run, f"id {kind}, n long, col string, term string, pos array<int>")


def build(docs: DataFrame, key: str, columns: list[str], stem: bool = False) -> Index:
    words = stemmed_terms if stem else plain_terms
    texts = docs.select(key, *(c for c in dict.fromkeys(columns) if c != key))
    size = texts.agg(F.sum(sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in columns), F.lit(0)))).first()[0] or 0
    held = spread(texts, key, least=size // TASK_CHARS).select(F.col(key).alias("id"), *(words(F.col(c)).alias(f"t{i}") for i, c in enumerate(columns)))
    held = held.withColumn("n", sum((F.size(f"t{i}") for i in range(len(columns))), F.lit(0)).cast("long"))
    return _of(held, tuple(columns), stem)


def _placed(columns: tuple[str, ...]) -> list[Column]:
    def placed(i: int) -> Column:
        return F.transform(f"t{i}", lambda w, at: F.struct(F.lit(columns[i]).alias("col"), at.alias("pos"), w.alias("term")))

    return [placed(i) for i in range(len(columns))]


def _of(listed: DataFrame, columns: tuple[str, ...], stem: bool) -> Index:
    postings = listed.select("id", F.inline(F.concat(*_placed(columns))), "n").select("id", "col", "pos", "term", "n")
    return Index(postings, listed.select("id", "n"), stem, listed=listed, columns=columns)


# ---- Queries


class MatchError(ValueError):
    """The query isn't a MATCH expression."""


@dataclass(frozen=True)
class Leaf:
    words: tuple[str, ...]
    prefix: bool = False
    col: str | None = None


@dataclass(frozen=True)
class Near:
    leaves: tuple[Leaf, ...]
    distance: int


@dataclass(frozen=True)
class Op:
    kind: str  # AND, OR, NOT
    left: object
    right: object


TOKEN = re.compile(r'\s*(?:"((?:[^"]|"")*)"|([()*:,+])|([^\W]+))', re.U)


def parse(query: str, stem: bool = False) -> Leaf | Near | Op:
    """Grammar: OR < AND (also implied) < NOT; "phrases", prefix*, col: x, a + b, NEAR(a b, n), parentheses."""
    found, at = [], 0
    text = query.rstrip()
    while at < len(text):
        m = TOKEN.match(text, at)
        if not m:
            raise MatchError(f"syntax error near {text[at:]!r}")
        found.append(("str", m[1].replace('""', '"')) if m[1] is not None else ("mark", m[2]) if m[2] else ("word", m[3]))
        at = m.end()
    place = 0

    def peek(k: int = 0):
        return found[place + k] if place + k < len(found) else (None, None)

    def take(*wanted):
        nonlocal place
        if wanted and peek() not in wanted:
            raise MatchError(f"expected {wanted[0][1]!r}")
        place += 1
        return found[place - 1]

    def phrase(col: str | None) -> Leaf:
        kind, value = peek()
        if kind not in ("str", "word") or (kind == "word" and value in ("AND", "OR", "NOT")):
            raise MatchError("expected a term")
        take()
        words = terms(value, stem)
        while peek() == ("mark", "+"):
            take()
            words += list(phrase(col).words)
        prefix = peek() == ("mark", "*")
        if prefix:
            take()
        return Leaf(tuple(words), prefix, col)

    def unit(col: str | None = None):
        if peek() == ("mark", "("):
            take()
            out = disjunction(col)
            take(("mark", ")"))
            return out
        if peek() == ("word", "NEAR") and peek(1) == ("mark", "("):
            take()
            take()
            leaves, distance = [], 10
            while peek() not in (("mark", ")"), ("mark", ",")):
                leaves.append(phrase(col))
            if peek() == ("mark", ","):
                take()
                distance = int(take()[1])
            take(("mark", ")"))
            return Near(tuple(leaves), distance)
        if peek()[0] == "word" and peek(1) == ("mark", ":"):
            name = take()[1]
            take()
            return unit(name)
        return phrase(col)

    def negation(col):
        out = unit(col)
        while peek() == ("word", "NOT"):
            take()
            out = Op("NOT", out, unit(col))
        return out

    def conjunction(col):
        grouped = peek() == ("mark", "(")
        out = negation(col)
        while peek()[0] and peek() not in (("word", "OR"), ("mark", ")")):
            if peek() == ("word", "AND"):
                take()
            elif grouped or peek() == ("mark", "("):
                raise MatchError("AND is implied between terms alone, not beside parentheses")
            grouped = peek() == ("mark", "(")
            out = Op("AND", out, negation(col))
        return out

    def disjunction(col=None):
        out = conjunction(col)
        while peek() == ("word", "OR"):
            take()
            out = Op("OR", out, conjunction(col))
        return out

    if not found:
        raise MatchError("empty query")
    out = disjunction()
    if peek()[0]:
        raise MatchError(f"unexpected {peek()[1]!r}")
    return out


def _near(node) -> list[Near]:
    if isinstance(node, Op):
        return _near(node.left) + _near(node.right)
    return [node] if isinstance(node, Near) else []


def _all_leaves(node) -> list[Leaf]:
    if isinstance(node, Op):
        return _all_leaves(node.left) + _all_leaves(node.right)
    return list(node.leaves) if isinstance(node, Near) else [node]


def occurrences(index: Index, found: list[Leaf]) -> DataFrame:
    """id, n, leaf (its place), col, start of each occurrence of the leaves: one read of the postings, one shuffle by id.

    A word of a phrase that stands i words in votes for the start i before it; a start with all votes is an occurrence.
    """
    wanted = []
    for leaf, x in enumerate(found):
        for i, w in enumerate(x.words):
            is_word = F.col("term").startswith(w) if x.prefix and i == len(x.words) - 1 else F.col("term") == w
            wanted.append((is_word if x.col is None else is_word & (F.col("col") == x.col), leaf, i))
    rows = index.postings
    if not wanted:
        return rows.select("id", "n", F.lit(0).alias("leaf"), "col", F.col("pos").alias("start")).where("false")
    rows = rows.where(reduce(Column.__or__, (c for c, *_ in wanted)))
    votes = F.array_compact(F.array(*(F.when(c, F.struct(F.lit(leaf).alias("leaf"), F.lit(i).alias("i"))) for c, leaf, i in wanted)))
    rows = rows.repartition("id").select("id", "n", "col", "pos", F.explode(votes).alias("v"))
    rows = rows.select("id", "n", "v.leaf", "col", (F.col("pos") - F.col("v.i")).alias("start"))
    if all(len(x.words) == 1 for x in found):
        return rows
    need = F.element_at(F.array(*(F.lit(len(x.words)) for x in found)), F.col("leaf") + 1)
    return rows.groupBy("id", "n", "leaf", "col", "start").agg(F.count(F.lit(1)).alias("votes")).where(F.col("votes") == need).drop("votes")


def _is_word(x: Leaf) -> bool:
    return len(x.words) == 1 and x.col is None


def word_counts(index: Index, found: list[Leaf]) -> DataFrame:
    """id, n, f0, f1, ...: how often each leaf, a word or a beginning of words, is in a document that has any of them."""
    is_term = [F.col("term").startswith(x.words[0]) if x.prefix else F.col("term") == x.words[0] for x in found]
    rows = index.frequencies.where(reduce(Column.__or__, is_term))
    return rows.groupBy("id", "n").agg(*(F.coalesce(F.sum(F.when(c, F.col("tf"))), F.lit(0)).alias(f"f{k}") for k, c in enumerate(is_term)))


def near_ids(found: DataFrame, node: Near, first: int) -> DataFrame:
    """Distinct ids with all leaves of a NEAR (places from `first`) in one column, as near as it says.

    Occurrences are swept in order: the nearest span that ends at one begins at the least of the leaves' last starts.
    """
    w = Window.partitionBy("id", "col").orderBy("start", "leaf").rowsBetween(Window.unboundedPreceding, 0)
    own = found.where(F.col("leaf").between(first, first + len(node.leaves) - 1))
    words = [len(x.words) for x in node.leaves]
    last = [F.last(F.when(F.col("leaf") == first + k, F.col("start")), ignorenulls=True).over(w).alias(f"s{k}") for k in range(len(words))]
    swept = own.select("id", *last)
    all_seen = reduce(Column.__and__, (F.col(f"s{k}").isNotNull() for k in range(len(words))))
    ends = [F.col(f"s{k}") + n for k, n in enumerate(words)]
    starts = [F.col(f"s{k}") for k in range(len(words))]
    span = (F.greatest(*ends) if len(ends) > 1 else ends[0]) - (F.least(*starts) if len(starts) > 1 else starts[0])
    return swept.where(all_seen & (span - sum(words) <= node.distance)).select("id").distinct()


def bm25(index: Index, query: str) -> DataFrame:
    """id, score of every match; lower is better. Each leaf is a unit with its own frequency; what follows NOT has none."""
    node = parse(query, index.stem)
    found = _all_leaves(node)
    if index.frequencies is not None and not _near(node) and all(_is_word(x) for x in found):
        counts = word_counts(index, found)
    else:
        rows = occurrences(index, found)
        counts = rows.groupBy("id", "n").agg(*(F.count_if(F.col("leaf") == k).alias(f"f{k}") for k in range(len(found))))
    place = {"leaf": 0, "near": 0}
    for k, x in enumerate(_near(node)):
        first = next(i for i in range(len(found)) if tuple(found[i : i + len(x.leaves)]) == x.leaves)
        counts = counts.join(near_ids(rows, x, first).withColumn(f"near{k}", F.lit(True)), "id", "left")

    scored: list[int] = []

    def holds(x, positive: bool = True) -> Column:
        if isinstance(x, Op):
            left = holds(x.left, positive)
            right = holds(x.right, positive and x.kind != "NOT")
            return left | right if x.kind == "OR" else left & (~right if x.kind == "NOT" else right)
        size = len(x.leaves) if isinstance(x, Near) else 1
        first = place["leaf"]
        place["leaf"] += size
        if positive:
            scored.extend(range(first, first + size))
        if isinstance(x, Near):
            place["near"] += 1
            return F.coalesce(F.col(f"near{place['near'] - 1}"), F.lit(False))
        return F.col(f"f{first}") > 0

    matches = holds(node)
    total = counts.agg(*(F.count_if(F.col(f"f{k}") > 0).alias(f"df{k}") for k in scored)).withColumn("one", F.lit(1))
    total = total.join(F.broadcast(index.stats().withColumn("one", F.lit(1))), "one")

    def idf(k: int) -> Column:
        value = F.log((F.col("docs") - F.col(f"df{k}") + 0.5) / (F.col(f"df{k}") + 0.5))
        return F.when(value <= 0, LEAST_IDF).otherwise(value)

    weights = total.select("one", "mean", *(idf(k).alias(f"idf{k}") for k in scored))  # one row
    held = counts.where(matches).withColumn("one", F.lit(1)).join(F.broadcast(weights), "one")
    length = K1 * (1 - B + B * F.col("n") / F.col("mean"))
    return held.select("id", (-sum((F.col(f"idf{k}") * F.col(f"f{k}") * (K1 + 1) / (F.col(f"f{k}") + length) for k in scored), F.lit(0.0))).alias("score"))


@dataclass
class Best:
    hits: DataFrame  # id, score: the k best and whatever else was found on the way
    read: int  # rows of frequencies that were read
    listed: int  # rows that the terms have in all


def _idf(docs: int, df: int) -> float:
    value = math.log((docs - df + 0.5) / (df + 0.5))
    return value if value > 0 else LEAST_IDF


def _conjunction(node) -> tuple[list[str], bool] | None:
    """The words of a query that joins different words by AND alone, or by OR alone, and whether by AND; else None."""

    def kinds(x) -> set[str]:
        return {x.kind} | kinds(x.left) | kinds(x.right) if isinstance(x, Op) else set()

    leaves = _all_leaves(node)
    if _near(node) or not all(_is_word(x) and not x.prefix for x in leaves) or len(set(leaves)) < len(leaves) or not kinds(node) in (set(), {"AND"}, {"OR"}):
        return None
    return [x.words[0] for x in leaves], kinds(node) == {"AND"}


def best(index: Index, query: str, k: int, allowed: DataFrame | None = None, first: int = 8, growth: int = 8) -> Best | None:
    """The k best of `allowed` ids (all, if None), ties included, for words joined by AND or by OR; None for other queries.

    Lists are read from their greatest impact down to a cut. A document that was met in all lists, or in all but those read
    to their end, has its score; of any other the cuts bound what is missing. The cuts are lowered until the k-th best
    score is above all bounds. A wave reads `growth` times the rows of the one before, so all waves together read little
    more than the last. Only counts of levels (64 a word) and k scores come to the driver.
    """
    wanted = _conjunction(parse(query, index.stem))
    if wanted is None or index.frequencies is None:
        return None
    words, both = wanted
    docs, mean, built = index.stats().select("docs", "mean", "built").first()
    levels: dict[str, dict[int, int]] = {w: {} for w in words}
    for r in index.levels.where(F.col("term").isin(words)).groupBy("term", "level").agg(F.sum("rows").alias("rows")).collect():
        levels[r["term"]][r["level"]] = r["rows"]
    # rows taken back are counted below all levels: they lower the count of documents, and no list
    weight = {w: _idf(docs, sum(levels[w].values())) * (K1 + 1) for w in words}
    lists = {w: {at: n for at, n in levels[w].items() if at >= 0} for w in words}
    stretch = max(1.0, (mean or 1.0) / (built or 1.0))  # impacts for this mean are at most so many times those stored
    listed, read, want = sum(sum(x.values()) for x in lists.values()), 0, first * k
    while True:
        cut = {}
        for w, counts in lists.items():
            n, cut[w] = 0, 0
            for at in sorted(counts, reverse=True):
                n, cut[w] = n + counts[at], at
                if n >= want:
                    break
            cut[w] = 0 if n >= sum(counts.values()) else cut[w]
            read += n
        rows = index.frequencies.where(reduce(Column.__or__, ((F.col("term") == w) & (F.col("impact") >= at / STEPS) if at else F.col("term") == w for w, at in cut.items())))
        rows = rows if allowed is None else rows.join(allowed, "id", "left_semi")
        own = reduce(lambda x, w: F.when(F.col("term") == w, F.lit(weight[w])).otherwise(x), words, F.lit(0.0)) * impact(F.col("tf"), F.col("n"), F.lit(mean))
        rest = {w: weight[w] * stretch * at / STEPS for w, at in cut.items()}
        has = [F.array_contains("terms", w) for w in words]
        missing = sum((F.when(h, 0.0).otherwise(rest[w]) for w, h in zip(words, has, strict=True)), F.lit(0.0))
        whole = reduce(Column.__and__, (h if both else h | F.lit(not cut[w]) for w, h in zip(words, has, strict=True)))
        lost = reduce(Column.__or__, (~h & F.lit(both and not cut[w]) for w, h in zip(words, has, strict=True)))
        met = rows.groupBy("id").agg(F.sum(own).alias("sum"), F.collect_set("term").alias("terms")).where(~lost)
        met = stored(met.select("id", F.col("sum").alias("score"), whole.alias("whole"), (F.col("sum") + missing).alias("most")))
        top = [r["score"] for r in met.where("whole").orderBy(F.desc("score")).limit(k).collect()]
        open_ = [w for w in words if cut[w]]
        unmet = sum(rest.values()) if open_ and (not both or len(open_) == len(words)) else 0.0
        bound = max(unmet, met.where("not whole").agg(F.max("most")).first()[0] or 0.0)
        if not open_ or (len(top) == k and top[-1] > bound + 1e-9):
            return Best(met.where("whole").select("id", (-F.col("score")).alias("score")), read, listed)
        want *= growth


def search(docs: DataFrame, index: Index, query: str, key: str, where: list[Column] | None = None, limit: int = 20, tie: str | None = None) -> DataFrame:
    """The best documents (score to nine places, then `tie` or the key), of those that pass all filters; limit is clamped
    to 1..100."""
    limit = max(1, min(limit, 100))
    for predicate in where or []:
        docs = docs.where(predicate)
    found = best(index, query, limit, docs.select(F.col(key).alias("id")) if where else None)
    hits = found.hits if found else bm25(index, query)
    return docs.join(hits.withColumnRenamed("id", key), key).orderBy(F.round("score", 9), tie or key).limit(limit)


def wanted_terms(query: str, column: str, stem: bool = False) -> list[list[tuple[str, bool]]]:
    """The phrases that a column's snippet marks: (term, whether it is a prefix) of each word."""

    def of(x, positive: bool = True) -> list[Leaf]:
        if isinstance(x, Op):
            return of(x.left) + ([] if x.kind == "NOT" else of(x.right))
        return list(x.leaves) if isinstance(x, Near) else [x]

    return [[(w, x.prefix and i == len(x.words) - 1) for i, w in enumerate(x.words)] for x in of(parse(query, stem)) if x.words and x.col in (None, column)]


@lru_cache(100_000)
def word_terms(word: str, stem: bool) -> list[str]:
    return terms(word, stem)


def snippets_of(text: str | None, phrases: list[list[tuple[str, bool]]], stem: bool, size: int = SNIPPET) -> str:
    """Up to `size` words of a text with its phrases marked; phrases that overlap share their marks.

    The window has the highest score among those that begin at a phrase's occurrence: 1,000 for each distinct phrase in
    it, 1 for each further occurrence, and 100 for a beginning of a sentence (120 of the text). It is moved left so that
    its occurrences stand in the middle.
    """
    text = text or ""
    found = [(m.start(), m.end(), word_terms(m[0], stem)) for m in re.finditer(r"[^\W_]+(?:[\u0300-\u036f]+[^\W_]*)*", text)]
    words = [t[0] if t else "" for _, _, t in found]
    hits = [(i, k) for i in range(len(words)) for k, p in enumerate(phrases) if i + len(p) <= len(words) and all(words[i + j].startswith(w) if prefix else words[i + j] == w for j, (w, prefix) in enumerate(p))]

    def score(start: int) -> tuple[int, int]:
        """Of the window from a word, and where it had better start."""
        seen: set[int] = set()
        value, first, last = 0, None, start
        for i, k in hits:
            if start <= i < start + size:
                value += 1 if k in seen else 1000
                seen.add(k)
                first, last = (i if first is None else first), max(last, i + len(phrases[k]))
        if first is None:
            return value, start
        return value, max(0, min(first - (size - (last - first)) // 2, len(words) - size))

    sentences = [i for i in range(len(words)) if not i or text[found[i - 1][1] : found[i][0]].rstrip().endswith((".", ":"))]
    best = (0, 0)
    for i, _ in hits:
        value, at = score(i)
        if value > best[0]:
            best = (value, at)
        j = sentences[bisect_right(sentences, i) - 1]
        if len(words) > size and j < i and (value := score(j)[0] + (100 if j else 120)) > best[0]:
            best = (value, j)
    start, end = best[1], min(len(words), best[1] + size)
    marks: list[list[int]] = []  # phrases that overlap are one
    for i, k in hits:
        if marks and i < marks[-1][1]:
            marks[-1][1] = max(marks[-1][1], i + len(phrases[k]))
        else:
            marks.append([i, i + len(phrases[k])])
    opens = {a: min(b, end) - 1 for a, b in marks if start <= a < end}
    out, at, closes = [GAP] if start else [], found[start][0] if start else 0, -1
    for i in range(start, end):
        out.append(text[at : found[i][0]])
        if i in opens:
            out.append(OPEN)
            closes = opens[i]
        out.append(text[found[i][0] : found[i][1]] + (CLOSE if i == closes else ""))
        at = found[i][1]
    return "".join([*out, text[at:] if start + size >= len(words) else GAP])


def snippet_for(text: Column, query: str, column: str = "text", stem: bool = False, size: int = SNIPPET) -> Column:
    """The snippet of a column for a MATCH query: phrases, prefixes and stems as the index has them. For a page of results."""
    phrases = wanted_terms(query, column, stem)
    return pandas_udf(lambda texts: texts.map(lambda x: snippets_of(x, phrases, stem, size)), "string")(text)


def snippet(text: Column, words: list[str], size: int = SNIPPET) -> Column:
    """`size` terms around the window with most matches (the first such), matches marked."""
    hit = F.array(*map(F.lit, words))
    tokens = F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}]+[^\p{L}\p{N}]*"), F.lit(0))
    flags = F.transform(tokens, lambda t: F.array_contains(hit, F.lower(F.regexp_extract(t, r"[\p{L}\p{N}]+", 0))).cast("int"))
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(tokens) - size + 1))
    best = F.array_max(F.transform(starts, lambda s: F.struct(F.aggregate(F.slice(flags, s, F.lit(size)), F.lit(0), lambda a, x: a + x).alias("n"), (-s).alias("s"))))
    start = -best["s"]
    marked = F.transform(F.slice(tokens, start, F.lit(size)), lambda t: F.when(F.array_contains(hit, F.lower(F.regexp_extract(t, r"[\p{L}\p{N}]+", 0))), F.regexp_replace(t, r"^([\p{L}\p{N}]+)", f"{OPEN}$1{CLOSE}")).otherwise(t))
    return F.concat(F.when(start > 1, F.lit(GAP)).otherwise(F.lit("")), F.trim(F.array_join(marked, "")), F.when(start + size <= F.size(tokens), F.lit(GAP)).otherwise(F.lit("")))
