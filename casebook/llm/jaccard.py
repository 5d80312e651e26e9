"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence with itself.

Documents link when 100 * |A and B| >= least * |A or B| over their distinct word shingles.

1. Texts with equal sets are one class, which has a number of its own; only classes are compared, and classes of one doc_id
   begin as one component.
2. Columns of the product: a link needs so large an overlap that both sets' first n - ceil(least n / 100) + 1 shingles,
   in one order for all documents, share a column. The order puts frequent shingles last, so common passages rarely
   are such columns. Columns with one class are dropped, and columns are split
   into bands of sizes that may link.
3. Rows of the product, in rounds: each column takes one pivot class and pairs it with the column's classes of other
   components. Sizes and places in the order bound the overlap; pairs below the bound are discarded. Then they are
   bounded by the sizes of 256 blocks of columns (hash ranges), and what is left is multiplied: a tile has a row and
   about 256 of its partners, whose overlap counts are summed over blocks of columns; a pair goes as soon as the rest
   can't lift its count to the bound. Links merge components, so a group of copies costs about one product each, not one a
   pair.
4. After PLAIN such rounds a column takes up to PIVOTS pivots, others in each column, so that a class that is far from most
   of its group meets some that it links with. Before a pair of these rounds becomes a row, its sets' parities bound it: of
   the two sets' shingles in each of 512 classes of hashes. Each that differs stands for a shingle that one set lacks.
5. After ROUNDS, or a round with few new links, all remaining pairs of different components in a column are bounded so
   and multiplied. So no link between components is lost.

Null and empty texts have the empty set and link with nothing. A null doc_id can't be named as a component: such rows
get a null component and are compared with nothing. Repeated rows are members of one class. Rows of one doc_id with
different texts are one document of several texts: what links with any of them is in its component. Very long texts are
taken whole. Ties can't be: a set links or doesn't, and a component has the least doc_id. An empty table gives no row.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import discard, fresh, join_by_size, materialise, quoted, small_batches, tidy
from casebook.llm.graph import components as connected

WORDS, LEAST = 4, 85
#: The order's list of frequent shingles: at most so many from each task and in all. Any list gives the same links.
HOT_TASK, HOT, HOT_LEAST = 4096, 20_000, 16
ROUNDS, BLOCKS, SIZES, MOST_SIZE, TILE = 6, 4, 256, (1 << 16) - 1, 256
#: Words of 64 parities, a power of two; rounds with one pivot a column; pivots of a column in later rounds.
PARITIES, PLAIN, PIVOTS = 8, 2, 16
#: Bytes of text for which powers are kept.
KEPT = 1 << 17
MIX = np.uint64(0x9E3779B97F4A7C15)
#: The polynomial's base, odd, so that it has an inverse modulo 2 ** 64.
BASE = np.uint64(0xD6E8FEB86659FD93)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
BLANK = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _powers(base: np.uint64, n: int) -> np.ndarray:
    return np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base))])


class Shingler:
    """Distinct shingles of texts, as sorted 64-bit hashes.

    A word's hash is a polynomial of its bytes, taken from running sums over the whole text: no word is made, looked up or
    remembered.
    """

    def __init__(self, words: int = WORDS):
        self.words, self.powers, self.inverses = words, _powers(BASE, KEPT), _powers(INVERSE, KEPT)

    def hashes(self, text: str | None) -> np.ndarray:
        """Of the words, in order."""
        raw = np.frombuffer((text or "").encode().lower(), np.uint8)
        n = len(raw)
        # tables for a longer text are its own, and go with it
        up, down = (self.powers, self.inverses) if n <= KEPT else (_powers(BASE, n), _powers(INVERSE, n))
        inside = np.zeros(n + 2, np.int8)
        inside[1:-1] = ~BLANK[raw]
        edge = np.diff(inside)
        starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:n], out=sums[1:])
        h = (sums[ends] - sums[starts]) * down[starts]
        h = (h ^ h >> np.uint64(31)) * MIX
        return h ^ h >> np.uint64(29)

    def of(self, text: str | None) -> np.ndarray:
        h = self.hashes(text)
        if not len(h):
            return h
        size = min(self.words, len(h))
        n = len(h) - size + 1
        key = h[:n] ^ np.uint64(size)
        for i in range(1, size):
            key = (key ^ key >> np.uint64(29)) * MIX + h[i : i + n]
        return np.unique((key ^ key >> np.uint64(32)) * MIX)


def need(n: Column | int, least: int = LEAST):
    """The least overlap of a set of n with any set that it links with: ceil(least n / 100)."""
    return -(-n * least // 100) if isinstance(n, int) else F.ceil(n * least / F.lit(100))


def frequent(docs: DataFrame, words: int) -> np.ndarray:
    """Frequent shingles, most frequent last. Each task keeps a bounded summary; sums are bounded to HOT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, keys, sums = Shingler(words), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            new, n = np.unique(np.concatenate([np.zeros(0, np.uint64), *(s.of(x) for x in batch.column(0).to_pylist())]), return_counts=True)
            new, n = new[n > 1], n[n > 1]
            keys, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
            sums = np.bincount(at, np.concatenate([sums, n]), len(keys)).astype(np.int64)
            if len(keys) > HOT_TASK:
                top = np.sort(np.argpartition(-sums, HOT_TASK)[:HOT_TASK])
                keys, sums = keys[top], sums[top]
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(sums)], names=["sh", "n"])

    sums = docs.select("text").mapInArrow(tidy(run), "sh long, n long").groupBy("sh").agg(F.sum("n").alias("n"))
    top = sums.where(F.col("n") >= HOT_LEAST).orderBy(F.desc("n"), "sh").limit(HOT).toArrow()
    return top["sh"].to_numpy().view(np.uint64)[::-1].copy()


def prefixes(docs: DataFrame, words: int, least: int, hot: np.ndarray) -> DataFrame:
    """doc_id, n, key (digest of the set), prefix (its first shingles in the common order), sizes of its blocks, parities."""
    order = np.argsort(hot)
    listed, rank = hot[order], order

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Shingler(words)
        for batch in batches:
            sets = [s.of(x) for x in batch.column(1).to_pylist()]
            first = []
            for x in sets:
                n = len(x)
                p = n - need(n, least) + 1 if n else 0
                if len(listed) and n:
                    at = np.minimum(np.searchsorted(listed, x), len(listed) - 1)
                    is_hot = listed[at] == x
                    cold = x[~is_hot]
                    if len(cold) < p:
                        cold = np.concatenate([cold, hot[np.sort(rank[at[is_hot]])]])
                    x = cold  # noqa: PLW2901
                first.append(x[:p].view(np.int64))
            keys = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in sets], pa.int64()), pa.array(keys, pa.binary()), pa.array(first, pa.list_(pa.int64())), pa.array([block_sizes(x) for x in sets], pa.binary()), pa.array([parities(x) for x in sets], pa.list_(pa.int64()))], names=["doc_id", "n", "key", "prefix", "blocks", "parity"])

    return docs.mapInArrow(tidy(run), "doc_id long, n long, key binary, prefix array<long>, blocks binary, parity array<long>")


def block_sizes(x: np.ndarray) -> bytes:
    """How many hashes fall in each of SIZES ranges. A set too large for 16 bits has MOST_SIZE in all: it bounds nothing."""
    n = np.bincount((x >> np.uint64(64 - SIZES.bit_length() + 1)).astype(np.int64), minlength=SIZES)
    return (n if n.max(initial=0) < MOST_SIZE else np.full(SIZES, MOST_SIZE)).astype("<u2").tobytes()


def parities(x: np.ndarray) -> np.ndarray:
    """Whether the hashes are odd in number, a bit for each remainder by 64 * PARITIES (the blocks go by the first bits)."""
    n = np.bincount((x & np.uint64(64 * PARITIES - 1)).astype(np.int64), minlength=64 * PARITIES)
    return np.packbits((n & 1).astype(np.uint8)).view(np.int64)


def _near_enough(n: Column, parity: Column, m: Column, other: Column, least: int) -> Column:
    """Bound from parities: each that differs stands for a shingle that one of the sets lacks."""
    differ = sum((F.bit_count(parity[i].bitwiseXOR(other[i])) for i in range(PARITIES)), F.lit(0))
    return differ * (100 + least) <= (n + m) * (100 - least)


def bounded(pairs: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """Pairs whose blocks' sizes allow the overlap that they need: it is at most the sum of the lesser sizes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(i).to_pylist()), "<u2").reshape(-1, SIZES).astype(np.int64) for i in (4, 5))
            unbounded = (a.min(1) == MOST_SIZE) | (b.min(1) == MOST_SIZE)
            most, n = np.minimum(a, b).sum(1), a.sum(1) + b.sum(1)
            yield pa.RecordBatch.from_arrays(batch.columns[:4], names=["a", "b", "ca", "cb"]).filter(pa.array(unbounded | (most * (100 + least) >= n * least)))

    left, right = (classes.select(F.col("node").alias(x), F.col("blocks").alias(f"blocks_{x}")) for x in "ab")
    return pairs.join(left, "a").join(right, "b").select("a", "b", "ca", "cb", "blocks_a", "blocks_b").mapInArrow(tidy(run), "a long, b long, ca long, cb long")


def tiles(pairs: DataFrame) -> DataFrame:
    """Pairs a, b, ca, cb with `part`: the pairs of a row a are a tile, or several of about TILE if it has more."""
    many = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > TILE)
    rows = join_by_size(pairs, many, ["a"], "left", many.count())
    part = F.pmod(F.xxhash64("b"), F.ceil(F.col("n") / TILE).cast("long"))
    return rows.select("a", F.coalesce(part, F.lit(0)).cast("int").alias("part"), "b", "ca", "cb")


def product(a: np.ndarray, rows: list[np.ndarray], least: int) -> np.ndarray:
    """Which rows link with the row a: a block of the product. Overlap counts are summed over blocks of columns (ranges of
    hashes), and a row is left out as soon as what remains can't lift its count to the bound that the sizes set."""
    edges = np.arange(1, BLOCKS, dtype=np.uint64) << np.uint64(64 - BLOCKS.bit_length() + 1)
    cut = lambda x: [0, *np.searchsorted(x, edges).tolist(), len(x)]
    own, cuts = cut(a), np.array([cut(x) for x in rows])
    size = cuts[:, -1]
    bound = -(-least * (len(a) + size) // (100 + least))
    count, open_ = np.zeros(len(rows), np.int64), np.flatnonzero(np.minimum(size, len(a)) >= bound)
    for k in range(BLOCKS):
        mine, n = a[own[k] : own[k + 1]], cuts[open_, k + 1] - cuts[open_, k]
        if len(mine) and n.any():
            columns = np.concatenate([rows[i][cuts[i, k] : cuts[i, k + 1]] for i in open_.tolist()])
            at = np.minimum(np.searchsorted(mine, columns), len(mine) - 1)
            held = np.concatenate([[0], np.cumsum(mine[at] == columns)])
            ends = np.cumsum(n)
            count[open_] += held[ends] - held[ends - n]
        open_ = open_[count[open_] + np.minimum(len(a) - own[k + 1], size[open_] - cuts[open_, k + 1]) >= bound[open_]]
    out = np.zeros(len(rows), bool)
    out[open_] = True
    return out


def multiply(pairs: DataFrame, classes: DataFrame, docs: DataFrame, words: int, least: int) -> DataFrame:
    """Of pairs a, b, ca, cb (components) the components that link.

    A tile's rows come to one task: the sets of its documents, made from their texts before the shuffle (each once a
    tile, not once a pair), then its pairs.
    """
    tiled = materialise(tiles(pairs))
    nodes = tiled.select("a", "part", F.explode(F.array("a", "b")).alias("node")).distinct().join(classes.select("node", "key", F.col("low").alias("doc_id")), "node")
    wanted = materialise(nodes.select("a", "part", "doc_id", "node", "key"))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Shingler(words)
        for batch in batches:
            raw = {x: s.of(x).tobytes() for x in set(batch.column(4).to_pylist())}
            made = [raw[x] for x in batch.column(4).to_pylist()]
            # of a doc_id's texts the one of this class
            same = [hashlib.blake2b(x, digest_size=16).digest() == k for x, k in zip(made, batch.column(3).to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(made, pa.binary())], names=["a", "part", "node", "shingles"]).filter(pa.array(same, pa.bool_()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, held, asked = None, {}, []

        def linked() -> list[tuple[int, int]]:
            good = product(held[tile[0]], [held[b] for b, _, _ in asked], least) if asked else []
            return [x[1:] for x, ok in zip(asked, good, strict=True) if ok]

        for batch in batches:
            found = []
            for a, part, node, raw, ca, cb in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (a, part) != tile:
                    found += linked()
                    tile, held, asked = (a, part), {}, []
                if raw is not None:
                    held[node] = np.frombuffer(raw, np.uint64)
                else:
                    asked.append((node, ca, cb))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], names=["ca", "cb"])
        yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in linked()], pa.int64()) for i in (0, 1)], names=["ca", "cb"])

    texts = join_by_size(docs, wanted, ["doc_id"], "inner", wanted.count()).select("a", "part", "node", "key", "text")
    made = texts.mapInArrow(tidy(sets), "a long, part int, node long, shingles binary")
    none = F.lit(None).cast("long")
    rows = made.select("*", none.alias("ca"), none.alias("cb")).unionByName(tiled.select("a", "part", F.col("b").alias("node"), F.lit(None).cast("binary").alias("shingles"), "ca", "cb"))
    rows = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("shingles").isNull())
    out = materialise(rows.mapInArrow(tidy(run), "ca long, cb long").distinct())
    discard(tiled, wanted)
    return out


def _may_link(n: Column, pos: Column, m: Column, mpos: Column, least: int) -> Column:
    """Bounds from sizes, and from what follows a pair's first common column."""
    sizes = (F.least(n, m) * 100 >= F.greatest(n, m) * least)
    return sizes & (F.least(n - pos, m - mpos) * (100 + least) >= (n + m) * least)


def _pairs(x: DataFrame) -> DataFrame:
    a = F.col("node") < F.col("other")
    return x.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"), F.when(a, F.col("comp")).otherwise(F.col("ocomp")).alias("ca"), F.when(a, F.col("ocomp")).otherwise(F.col("comp")).alias("cb")).distinct()


def _banded(columns: DataFrame, least: int) -> DataFrame:
    """Columns split by size: bands are so wide that sets that may link are in one or in neighbouring bands, and each
    row stands in its own band and the next. Bands with one class are dropped. Each class begins as its own component."""
    own = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(100.0 / least)) * 0.999).cast("int")
    rows = columns.select("sh", "node", "n", "pos", F.explode(F.array(own, own + 1)).alias("band"))
    several = rows.groupBy("sh", "band").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("sh", "band")
    return rows.join(several, ["sh", "band"], "left_semi").withColumn("comp", F.col("node"))


def join(docs: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """One row a document: doc_id, n_shingles, component_id (the least doc_id reachable by links)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    base = materialise(prefixes(rows, words, least, frequent(rows, words)))
    named = base.where("n > 0 and doc_id is not null")
    sets = named.groupBy("key").agg(F.min("doc_id").alias("low"), F.first("n").alias("n"), F.first("prefix").alias("prefix"), F.first("blocks").alias("blocks"), F.first("parity").alias("parity"))
    classes = materialise(sets.withColumn("node", F.monotonically_increasing_id()))
    # A doc_id with many equal rows would bring each of them to its tiles.
    repeated = not named.groupBy("doc_id", "key").count().where("count > 1").isEmpty()
    once = rows.dropDuplicates(["doc_id", "text"]) if repeated else rows
    incidence = classes.select("node", "n", F.posexplode("prefix").alias("pos", "sh"))
    several = incidence.groupBy("sh").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("sh")
    columns = materialise(_banded(incidence.join(several, "sh", "left_semi"), least))
    labels: DataFrame | None = None

    def linked(pairs: DataFrame) -> DataFrame:
        """Components that link."""
        pairs = materialise(bounded(pairs, classes, least))
        links = multiply(pairs, classes, once, words, least)
        discard(pairs)
        return links

    def merge(links: DataFrame, old: DataFrame | None) -> DataFrame:
        """Labels after the links between components; only nodes that aren't their own component have a row."""
        new = connected(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
        if old is None:
            return new
        moved = old.join(new.select(F.col("node").alias("comp"), F.col("comp").alias("to")), "comp", "left").select("node", F.coalesce("to", "comp").alias("comp"))
        return materialise(moved.union(new))

    def still_open(x: DataFrame) -> DataFrame:
        """The columns that hold several components."""
        if labels is not None:
            x = x.drop("comp").join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
        wide = x.groupBy("sh", "band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("sh", "band")
        out = materialise(x.join(wide, ["sh", "band"], "left_semi"))
        discard(columns)
        return out

    several = named.groupBy("doc_id").agg(F.min("key").alias("lo"), F.max("key").alias("hi")).where("lo <> hi").select("doc_id")
    if not several.isEmpty():
        texts = named.join(several, "doc_id", "left_semi").select("doc_id", "key").distinct().join(classes.select("key", "node"), "key")
        labels = connected(texts.join(texts.groupBy("doc_id").agg(F.min("node").alias("a")), "doc_id").select("a", F.col("node").alias("b")))
        columns = still_open(columns)

    def marked(x: DataFrame) -> DataFrame:
        """With the classes' parities."""
        out = materialise(x.join(classes.select("node", "parity"), "node"))
        discard(x)
        return out

    def named_other(x: DataFrame) -> DataFrame:
        names = {"node": "other", "n": "on", "pos": "opos", "comp": "ocomp", "parity": "oparity"}
        return x.select("sh", "band", *(F.col(c).alias(names[c]) for c in x.columns if c in names))

    def may_link(x: DataFrame) -> DataFrame:
        x = x.where("comp <> ocomp").where(_may_link(F.col("n"), F.col("pos"), F.col("on"), F.col("opos"), least))
        return x.where(_near_enough(F.col("n"), F.col("parity"), F.col("on"), F.col("oparity"), least)) if "parity" in x.columns else x

    most, dense = 0, False
    for k in range(ROUNDS):
        by = [F.col("node"), *([F.col("sh")] if dense else []), F.lit(k)]
        slot = F.pmod(F.xxhash64(*by), F.lit(PIVOTS if dense else 1))
        pivot = columns.groupBy("sh", "band", slot.alias("slot")).agg(F.min(F.struct(F.xxhash64(*by).alias("by"), *(c for c in columns.columns if c not in ("sh", "band")))).alias("p"))
        links = linked(_pairs(may_link(columns.join(named_other(pivot.select("sh", "band", "p.*")), ["sh", "band"]))))
        found = links.count()
        most = max(most, found)
        if found:
            labels = merge(links, labels)
            columns = still_open(columns)
        few = found * 50 <= most
        if dense and few:
            break
        if not dense and (few or k + 1 >= PLAIN):
            columns, dense = marked(columns), True
    if not dense:
        columns = marked(columns)
    rest = may_link(columns.join(named_other(columns), ["sh", "band"]).where("node < other"))
    links = linked(_pairs(rest))
    if not links.isEmpty():
        labels = merge(links, labels)
    discard(columns)
    ends = classes.select("key", "node", "low")
    if labels is not None:
        moved = labels.join(classes.select("node", "low"), "node").groupBy("comp").agg(F.min("low").alias("least"))
        own = classes.select(F.col("node").alias("comp"), "low")
        lows = moved.join(own, "comp").select("comp", F.least("least", "low").alias("least"))  # of components of several classes
        ends = ends.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node")).join(lows, "comp", "left").select("key", F.coalesce("least", "low").alias("low"))
    out = base.join(ends.select("key", "low"), "key", "left")
    comp = F.when(F.col("doc_id").isNotNull(), F.coalesce("low", "doc_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), comp.alias("component_id"))


def select(docs: DataFrame, words: int = WORDS, least: int = LEAST) -> DataFrame:
    """One document of each component (the least doc_id; of repeated rows one), with its columns. Null ids stay."""
    own = fresh(docs.columns) + "id"
    ids = materialise(join(docs, words, least))
    out = ids.where("doc_id <> component_id").select(F.col("doc_id").alias(own)).distinct()
    kept = docs.withColumn(own, F.col("doc_id").cast("long"))
    kept = join_by_size(kept, out, [own], "left_anti", out.count())
    if not ids.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        kept = kept.where(F.col(own).isNotNull()).dropDuplicates([own]).unionByName(kept.where(F.col(own).isNull()))
    return kept.select(*quoted(docs.columns))
