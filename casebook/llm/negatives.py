"""Hard-negative mining over a vector-approximation file.

Vectors become integers and are stored in blocks of rows: the integers, and beside them the approximation, four bits for
each dimension, which name one of 16 cells between the dimension's quantiles. For an anchor, a cell bounds what its
dimension can add to the score; two dimensions share a byte, so a row's bounds are sums of table look-ups by bytes.
Exact scores are taken only of rows that may enter: for positives, rows of the anchor's label whose upper bound reaches
the k-th best lower bound; for negatives, rows of other labels whose bounds meet a positive's window and reach the k-th
best lower bound of those that lie in it for sure. A few likely rows of a window are scored first, and their k-th best score
narrows it further.

Anchors are a stated query set: blocks of anchors meet blocks of rows, each pair of blocks once, by an equi-join on
buckets of row blocks. Each pair gives at most k rows an anchor and window, which are ranked again by anchor. No row is
moved by its label, so a hot label is of no matter, and no anchor's rows are gathered in one task.

Rows with a null label or vector, or a null or non-finite component, take no part. A null vec_id is no anchor, and comes
last among equal scores. Every row counts: copies of a row are its own positives, ties go to the smaller vec_id, and a
repeated anchor has its rows repeated. Shorter vectors are as if filled up with zeros. Integers so large that scores may not
fit a long raise ValueError. An empty table gives no row. Further columns are ignored. There are no texts here.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.common import discard, materialise, small_batches, tidy

#: Each block of anchors is copied to each bucket, so their number is bounded: the copies grow with the anchors alone.
CELLS, ROWS, ANCHORS, BUCKETS = 16, 4096, 128, 64
#: Times k likely rows of a window that are scored first, to narrow it.
TRIED = 4
ROW_BLOCK = "bucket int, ids binary, named binary, labels binary, rids binary, q binary, codes binary"
ANCHOR_BLOCK = "a_ids binary, a_labels binary, a_rids binary, a_q binary, a_scores binary, a_positives binary, a_named binary"
POSITIVE = "rid long, anchor_id long, positive_id long, positive_score long"
NEGATIVE = "rid long, place int, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"


class Cells:
    """The cells of each dimension: `low` and `high` are the least and largest integer of each."""

    def __init__(self, cuts: np.ndarray, least: np.ndarray, most: np.ndarray):
        """cuts: 15 a dimension, ascending; a value is in the cell after the last cut that isn't above it."""
        self.cuts = cuts
        self.low = np.concatenate([least[:, None], np.maximum(cuts, least[:, None])], 1)
        self.high = np.maximum(self.low, np.concatenate([cuts - 1, most[:, None]], 1))

    def codes(self, q: np.ndarray) -> np.ndarray:
        """A byte for each two dimensions, rows along the second axis."""
        cell = np.array([np.searchsorted(c, q[:, d], side="right") for d, c in enumerate(self.cuts)], np.uint8).reshape(-1, len(q))
        cell = np.pad(cell, ((0, len(cell) % 2), (0, 0)))
        return cell[::2] * CELLS + cell[1::2]

    def bounds(self, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest product for each byte of `codes`: tables of 256 entries."""
        a, b = anchor[:, None] * self.low, anchor[:, None] * self.high
        pad = ((0, len(anchor) % 2), (0, 0))
        pairs = lambda x: (np.pad(x, pad)[::2, :, None] + np.pad(x, pad)[1::2, None, :]).reshape(-1, CELLS * CELLS)
        return pairs(np.minimum(a, b)), pairs(np.maximum(a, b))


def looked_up(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
    out = np.zeros(codes.shape[1], np.int64)
    for entries, code in zip(table, codes, strict=True):
        out += entries[code]
    return out


def kth_best(x: np.ndarray, k: int) -> int | None:
    return None if len(x) < k else np.partition(x, len(x) - k)[len(x) - k]


def first(scores: np.ndarray, ids: np.ndarray, named: np.ndarray, k: int) -> np.ndarray:
    """Places of the k first: higher scores, then smaller ids, then null ids."""
    return np.lexsort((ids, ~named, -scores))[:k]


def _read(cell: bytes, kind: type, width: int = 0) -> np.ndarray:
    out = np.frombuffer(cell, kind)
    return out.reshape(-1, width) if width else out


def _pairs(run: Callable[[dict, dict], Iterator[list]], names: str, dims: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For mapInArrow over joined blocks: `run` takes a block of rows and one of anchors and gives columns of results."""
    fields = [x.split() for x in names.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32()}

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                raw = {name: batch.column(j)[i].as_py() for j, name in enumerate(batch.schema.names)}
                rows = {k: _read(raw[k], np.int64) for k in ("ids", "labels", "rids")} | {"named": _read(raw["named"], np.bool_), "q": _read(raw["q"], np.int64, dims), "codes": _read(raw["codes"], np.uint8).reshape(-(-dims // 2), -1)}
                anchors = {k: _read(raw[k], np.int64) for k in ("a_ids", "a_labels", "a_rids", "a_scores", "a_positives")} | {"a_named": _read(raw["a_named"], np.bool_), "a_q": _read(raw["a_q"], np.int64, dims)}
                for columns in run(rows, anchors):
                    yield pa.RecordBatch.from_arrays([pa.array(c, kinds[kind]) if isinstance(c, list) else c for c, (_, kind) in zip(columns, fields, strict=True)], names=[name for name, _ in fields])

    return each


def prepared(rows: DataFrame, scale: int) -> DataFrame:
    """rid, vec_id, label, q: the rows that take part, as integers."""
    finite = lambda v: F.abs(v) < F.lit(float("inf"))
    held = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("x")).where(F.col("label").isNotNull() & F.col("x").isNotNull() & F.forall("x", finite))
    return materialise(held.select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", F.transform("x", lambda v: F.floor(v * scale)).alias("q")))


def cells_of(vectors: DataFrame, dims: int) -> Cells:
    """Cuts at the dimensions' (approximate) sixteenths; a row a dimension comes to the driver."""
    at = [i / CELLS for i in range(1, CELLS)]
    each = vectors.select(F.posexplode("q").alias("d", "v")).groupBy("d").agg(F.percentile_approx("v", at, 1000).alias("cuts"), F.min("v").alias("least"), F.max("v").alias("most"), F.count(F.lit(1)).alias("n"))
    cuts, least, most = np.zeros((dims, CELLS - 1), np.int64), np.zeros(dims, np.int64), np.zeros(dims, np.int64)
    for r in each.collect():
        # shorter vectors have zeros here, which must lie in a cell too
        cuts[r["d"]], least[r["d"]], most[r["d"]] = r["cuts"], min(r["least"], 0), max(r["most"], 0)
    return Cells(cuts, least, most)


def row_blocks(vectors: DataFrame, cells: Cells, dims: int, buckets: int) -> DataFrame:
    """The stored file: up to ROWS vectors a row, with their approximations."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        for batch in blocks(batches, ROWS):
            rid, ids, label, q = batch.columns
            q = padded(q, dims)
            arrays = [filled(ids), np.array(ids.is_valid()), label.to_numpy(), rid.to_numpy(), q, cells.codes(q)]
            bucket = (part * 2654435761 + seq) % buckets  # neighbouring blocks of a task go to neighbouring buckets
            yield pa.RecordBatch.from_arrays([pa.array([bucket], pa.int32()), *(pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in arrays)], names=[x.split()[0] for x in ROW_BLOCK.split(", ")])
            seq += 1

    return materialise(vectors.select("rid", "vec_id", "label", "q").mapInArrow(tidy(run), ROW_BLOCK))


def blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """The batches' rows, `most` at a time."""
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            some = batch.slice(0, most - n)
            held.append(some)
            n += some.num_rows
            batch = batch.slice(some.num_rows)
            if n == most:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, n = [], 0
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def filled(ids: pa.Array) -> np.ndarray:
    return ids.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def padded(q: pa.Array, dims: int) -> np.ndarray:
    sizes = np.diff(q.offsets.to_numpy())
    out = np.zeros((len(q), dims), np.int64)
    out[np.arange(dims) < sizes[:, None]] = q.flatten().to_numpy()
    return out


def anchor_blocks(anchors: DataFrame, dims: int, k: int) -> DataFrame:
    """Up to ANCHORS anchors a row. anchors: rid, vec_id, label, q, best (array of at most k structs id, score)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in blocks(batches, ANCHORS):
            rid, ids, label, q, best = batch.columns
            scores, positives, named = np.zeros((len(rid), k), np.int64), np.zeros((len(rid), k), np.int64), np.zeros((len(rid), k), np.bool_)
            counts = np.zeros(len(rid), np.int64)
            for i, some in enumerate(best.to_pylist()):
                for j, x in enumerate(some):
                    scores[i, j], positives[i, j], named[i, j] = x["score"], x["id"] or 0, x["id"] is not None
                counts[i] = len(some)
            arrays = [filled(ids), label.to_numpy(), rid.to_numpy(), padded(q, dims), np.concatenate([counts[:, None], scores], 1), positives, named]
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(x).tobytes()], pa.binary()) for x in arrays], names=[x.split()[0] for x in ANCHOR_BLOCK.split(", ")])

    return anchors.select("rid", "vec_id", "label", "q", "best").mapInArrow(tidy(run), ANCHOR_BLOCK)


def met(stored: DataFrame, anchors: DataFrame, buckets: int) -> DataFrame:
    """Each block of rows beside each block of anchors, by the buckets of the row blocks.

    Spark's estimate of the anchors' size leaves out their copies, so it would broadcast them; the hint keeps both sides from
    the driver.
    """
    each = anchors.withColumn("bucket", F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))))
    return stored.join(each.hint("merge"), "bucket").drop("bucket")


def best_of(rows: DataFrame, key: list[str], score: str, tie: str, k: int, name: str) -> DataFrame:
    """The k first of each key, with their places from 1; Spark keeps k of a key in each task before it shuffles."""
    order = [F.col(score).desc(), F.col(tie).asc_nulls_last()]
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col(name) <= k)


def positives_in(cells: Cells, k: int) -> Callable[[dict, dict], Iterator[list]]:
    """For `_pairs`: of each anchor the k first rows of its label, itself left out."""

    def run(rows: dict, anchors: dict) -> Iterator[list]:
        for label in np.unique(anchors["a_labels"]):
            own = np.flatnonzero(rows["labels"] == label)
            codes = rows["codes"][:, own]
            for i in np.flatnonzero(anchors["a_labels"] == label):
                rid, q = int(anchors["a_rids"][i]), anchors["a_q"][i]
                low, up = (looked_up(t, codes) for t in cells.bounds(q))
                others = rows["rids"][own] != rid
                least = kth_best(low[others], k)
                some = own[others & (up >= least)] if least is not None else own[others]
                scores = rows["q"][some] @ q
                top = first(scores, rows["ids"][some], rows["named"][some], k)
                n = len(top)
                yield [[rid] * n, [int(anchors["a_ids"][i])] * n, pa.array(rows["ids"][some][top], mask=~rows["named"][some][top]), pa.array(scores[top])]

    return run


def negatives_in(cells: Cells, positives: int, k: int, least: int, most: int, seen: list[int] | None = None) -> Callable[[dict, dict], Iterator[list]]:
    """For `_pairs`: of each anchor and positive the k first rows of other labels whose score is in the window of least to
    most hundredths of the positive's. `seen` gets how many rows were looked up, and how many exactly scored."""

    def run(rows: dict, anchors: dict) -> Iterator[list]:
        n_anchors = len(anchors["a_ids"])
        windows = anchors["a_scores"].reshape(n_anchors, positives + 1)
        names, named = anchors["a_positives"].reshape(n_anchors, positives), anchors["a_named"].reshape(n_anchors, positives)
        for i in range(n_anchors):
            q = anchors["a_q"][i]
            low, up = (looked_up(t, rows["codes"]) for t in cells.bounds(q))
            other = rows["labels"] != anchors["a_labels"][i]
            wanted, scored = [], np.zeros(len(other), np.bool_)
            for score in windows[i, 1 : windows[i, 0] + 1].tolist():
                bottom, top = -(-least * score // 100), most * score // 100
                may = other & (up >= bottom) & (low <= top)
                sure = kth_best(low[may & (low >= bottom) & (up <= top)], k)
                likely = np.flatnonzero(may & (low + up <= 2 * top) & (True if sure is None else up >= sure))
                if len(likely) > TRIED * k:
                    likely = likely[np.argpartition(low[likely] + up[likely], -TRIED * k)[-TRIED * k :]]
                tried = rows["q"][likely] @ q
                reached = kth_best(tried[(tried >= bottom) & (tried <= top)], k)
                scored[likely] = True
                wanted.append((score, bottom, top, may & (up >= max(x for x in (bottom, sure, reached) if x is not None))))
            some = np.flatnonzero(np.logical_or.reduce([w[3] for w in wanted])) if wanted else np.zeros(0, np.int64)
            if seen is not None:
                seen[0] += len(other)
                seen[1] += np.count_nonzero(scored) + np.count_nonzero(~scored[some])
            exact = rows["q"][some] @ q
            for j, (score, bottom, top, may) in enumerate(wanted):
                inside = np.flatnonzero(may[some] & (exact >= bottom) & (exact <= top))
                at = some[inside]
                best = first(exact[inside], rows["ids"][at], rows["named"][at], k)
                n = len(best)
                if n:
                    yield [[int(anchors["a_rids"][i])] * n, [j] * n, [int(anchors["a_ids"][i])] * n, [int(names[i, j]) if named[i, j] else None] * n, [score] * n, pa.array(rows["ids"][at][best], mask=~rows["named"][at][best]), pa.array(exact[inside][best])]

    return run


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, least: int = 30, most: int = 90, scale: int = 256) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    small_batches(rows.sparkSession)
    vectors = prepared(rows, scale)
    facts = vectors.agg(F.max(F.size("q")).alias("dims"), F.max(F.greatest(F.array_max("q"), -F.array_min("q"))).alias("largest"), F.count(F.lit(1)).alias("n")).first()
    dims = facts["dims"] or 1
    if dims * (facts["largest"] or 0) ** 2 >= 1 << 62:
        raise ValueError(f"scores of {dims} components up to {facts['largest']} may not fit a long")
    buckets = max(1, min(BUCKETS, facts["n"] // ROWS))
    cells = cells_of(vectors, dims)
    stored = row_blocks(vectors, cells, dims, buckets)
    anchors = vectors.where(is_anchor)
    none = F.lit(None).cast("array<struct<id: bigint, score: bigint>>")
    found = met(stored, anchor_blocks(anchors.withColumn("best", F.coalesce(none, F.array())), dims, positives), buckets).mapInArrow(tidy(_pairs(positives_in(cells, positives), POSITIVE, dims)), POSITIVE)
    best = best_of(found, ["rid"], "positive_score", "positive_id", positives, "place")
    best = best.groupBy("rid").agg(F.transform(F.array_sort(F.collect_list(F.struct("place", F.col("positive_id").alias("id"), F.col("positive_score").alias("score")))), lambda x: F.struct(x["id"].alias("id"), x["score"].alias("score"))).alias("best"))
    held = materialise(anchors.join(best, "rid"))
    found = met(stored, anchor_blocks(held, dims, positives), buckets).mapInArrow(tidy(_pairs(negatives_in(cells, positives, negatives, least, most), NEGATIVE, dims)), NEGATIVE)
    out = materialise(best_of(found, ["rid", "place"], "negative_score", "negative_id", negatives, "rank").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"))
    discard(vectors, stored, held)
    return out


def relabelled(rows: DataFrame, divisor: int = 7, labels: int = 10) -> DataFrame:
    """Rows whose vec_id is divisible by `divisor` get the next label."""
    moved = F.when(F.col("vec_id") % divisor == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return rows.select("vec_id", "embedding", moved.alias("label"))


SQL = """WITH v AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS q
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
s AS MATERIALIZED (SELECT a.rid, a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_sum(list_transform(list_zip(a.q, b.q), lambda p: coalesce(p[1], 0) * coalesce(p[2], 0)))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.rid <> b.rid),
p AS (SELECT rid, anchor_id, other AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, other) <= 5),
n AS (SELECT p.anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score, row_number() OVER (PARTITION BY p.rid, positive_id ORDER BY score DESC, other) AS rank
  FROM p JOIN s ON p.rid = s.rid AND NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 10"""
