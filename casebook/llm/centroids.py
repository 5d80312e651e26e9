"""Centroid clustering of integer vectors, screened by norms of segments.

A vector is stored beside a compressed form: 8-bit codes with a shift of its own, and for each segment of 8 components
the norm of what the codes leave out. By Cauchy and Schwarz, segment by segment, its inner product with a centroid is at
most the codes' product plus the sum of those norms times the centroid's own segment norms, so its squared distance has a
lower bound. The centroid with the least bound gets an exact distance, then only those whose bound isn't above the best
so far. Norms are rounded up to integers and all else is exact, so a centroid as near as the best is never screened off.

A round reads the stored vectors once; each task adds its vectors up by cluster, and k x dims sums come to the driver,
however many vectors there are. No row is shuffled, so a hot key is of no matter.

Vectors that are null, have another number of components, or a null or non-finite one, are left out. Null ids take part
but never start a centroid (where none has an id, no row comes out). Repeated rows count each. Fewer vectors than centroids: as many centroids as vectors; an
empty table gives no row. Ties go to the smaller centroid; starts with equal hashes (repeated ids) are ordered by their
components. Integers of 2 ** 27 or more raise ValueError, since squared distances would not fit a long. Columns other
than the id and the vector are ignored. There are no texts here.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import discard, materialise, small_batches, tidy

SEGMENT, MOST = 8, 1 << 27
STORED = "vec_id long, q array<int>, codes binary, shift int, errors array<int>, norm long"


def norms_up(x: np.ndarray) -> np.ndarray:
    """Norms of the rows' segments, rounded up."""
    padded = np.pad(x, ((0, 0), (0, -x.shape[1] % SEGMENT)))
    squares = (padded.reshape(len(x), -1, SEGMENT) ** 2).sum(2)
    out = np.ceil(np.sqrt(squares)).astype(np.int64)
    return out + (out * out < squares)


def compress(q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of 8 bits, the shift of each row, and the segment norms of the rest. A code stands for the middle of its range."""
    most = np.maximum(q.max(1), -q.min(1) - 1)
    shift = np.maximum(0, np.ceil(np.log2(most + 1.0)).astype(np.int64) - 7)
    codes = q >> shift[:, None]
    return codes.astype(np.int8), shift, norms_up(q - (codes << shift[:, None]) - ((1 << shift) >> 1)[:, None])


def lower_bounds(codes: np.ndarray, shift: np.ndarray, errors: np.ndarray, norm: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Of the squared distances, rows by centroids. Products stay below 2 ** 53, where doubles are exact."""
    dots = (codes.astype(np.float64) @ centroids.T.astype(np.float64)).astype(np.int64) << shift[:, None]
    dots += ((1 << shift) >> 1)[:, None] * centroids.sum(1)
    dots += (errors.astype(np.float64) @ norms_up(centroids).T.astype(np.float64)).astype(np.int64)
    return norm[:, None] + (centroids**2).sum(1) - 2 * dots


def nearest(q: np.ndarray, low: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The nearest centroid of each row, its squared distance, and how many exact distances that took."""
    own = low.argmin(1)
    best = ((q - centroids[own]) ** 2).sum(1)
    first, taken = own.copy(), np.ones(len(q), np.int64)
    for j, c in enumerate(centroids):
        rows = np.flatnonzero((low[:, j] <= best) & (first != j))
        taken[rows] += 1
        d = ((q[rows] - c) ** 2).sum(1)
        closer = (d < best[rows]) | ((d == best[rows]) & (j < own[rows]))
        own[rows[closer]], best[rows[closer]] = j, d[closer]
    return own, best, taken


def prepare(vectors: DataFrame, scale: int = 1024, dims: int = 64) -> DataFrame:
    """The integer vectors with their compressed forms, written once."""
    finite = lambda v: F.abs(v) < F.lit(float("inf"))  # noqa: E731 - false for NaN, null for null
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"))
    rows = rows.where((F.size("x") == dims) & F.forall("x", finite))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = np.floor(batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims) * scale)
            if not (np.abs(x) < MOST).all():
                raise ValueError(f"a component times {scale} is {MOST} or more")
            q = x.astype(np.int64)
            codes, shift, errors = compress(q)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(q.astype(np.int32)), pa.list_(pa.int32())), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(shift, pa.int32()), pa.array(list(errors.astype(np.int32)), pa.list_(pa.int32())), pa.array((q**2).sum(1))], names=["vec_id", "q", "codes", "shift", "errors", "norm"])

    small_batches(vectors.sparkSession)
    return materialise(rows.mapInArrow(tidy(run), STORED))


def _assigned(batches: Iterator[pa.RecordBatch], centroids: np.ndarray) -> Iterator[tuple[pa.RecordBatch, np.ndarray, tuple]]:
    """Each batch of stored vectors with its integers and what `nearest` says."""
    dims = centroids.shape[1]
    table = lambda column, kind: column.flatten().to_numpy().astype(kind).reshape(len(column), -1)
    for batch in batches:
        if batch.num_rows:
            _, q, codes, shift, errors, norm = batch.columns
            q = table(q, np.int64)
            codes = np.frombuffer(b"".join(codes.to_pylist()), np.int8).reshape(-1, dims)
            low = lower_bounds(codes, shift.to_numpy().astype(np.int64), table(errors, np.int64), norm.to_numpy(), centroids)
            yield batch, q, nearest(q, low, centroids)


def moved(stored: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The centroids after a round: floors of their vectors' means. Those without vectors stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for _, q, (own, _, _) in _assigned(batches, centroids):
            for j in np.unique(own):
                sums[j] += q[own == j].sum(0)
                counts[j] += (own == j).sum()
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(counts[some]), pa.array(list(sums[some]), pa.list_(pa.int64()))], names=["cluster", "n", "sums"])

    parts = stored.mapInArrow(tidy(run), "cluster int, n long, sums array<long>").select("cluster", "n", F.posexplode("sums").alias("dim", "part"))
    out = centroids.copy()
    for r in parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("total")).collect():  # k x dims rows
        out[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]
    return out


def train(stored: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3) -> np.ndarray:
    """Centroids, started from the k vectors whose `seed:vec_id` has the least SHA-256."""
    drawn = stored.select(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256).alias("draw"), "q").where("draw is not null")
    start = [r["q"] for r in drawn.orderBy("draw", "q").limit(k).collect()]
    centroids = np.array(start, np.int64) if start else np.zeros((0, 1), np.int64)
    for _ in range(rounds if start else 0):
        centroids = moved(stored, centroids)
    return centroids


def assign(stored: DataFrame, centroids: np.ndarray) -> DataFrame:
    """vec_id, cluster, distance (squared), exact (how many exact distances were taken). Without centroids no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, _, (own, best, taken) in _assigned(batches, centroids):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(own, pa.int32()), pa.array(best), pa.array(taken, pa.int32())], names=["vec_id", "cluster", "distance", "exact"])

    stored = stored if len(centroids) else stored.where("false")
    return stored.mapInArrow(tidy(run), "vec_id long, cluster int, distance long, exact int")


def cluster(vectors: DataFrame, k: int = 8, rounds: int = 10, seed: int = 3, scale: int = 1024, dims: int = 64) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256, exact."""
    spark = vectors.sparkSession
    stored = prepare(vectors, scale, dims)
    centroids = train(stored, k, rounds, seed)
    out = materialise(assign(stored, centroids))
    discard(stored)
    sums = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows
    facts = [(j, s, sum(sums.values()), hashlib.sha256(",".join(map(str, centroids[j].tolist())).encode()).hexdigest()) for j, s in sums.items()]
    by = spark.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(by), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256", "exact")


def sql(k: int = 8, rounds: int = 10, seed: int = 3, scale: int = 1024, dims: int = 64) -> str:
    """The same rows but for `exact`: each round is two common table expressions."""
    squares = "list_sum(list_transform(list_zip(q, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    parts = [
        f"v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * {scale})::BIGINT) AS q FROM embeddings WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: isfinite(x))) = {dims})",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS j, q AS c FROM v ORDER BY sha256('{seed}:' || vec_id) LIMIT {k})",
    ]
    near = lambda i: f"a{i} AS MATERIALIZED (SELECT vec_id, q, arg_min(j, (d, j)) AS j, min(d) AS d FROM (SELECT vec_id, q, j, {squares} AS d FROM v, c{i}) GROUP BY vec_id, q)"
    for i in range(rounds):
        parts.append(near(i))
        means = f"SELECT j, list(m ORDER BY dim) AS c FROM (SELECT j, dim, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m FROM (SELECT j, unnest(q) AS x, unnest(range({dims})) AS dim FROM a{i}) GROUP BY j, dim) GROUP BY j"
        parts.append(f"c{i + 1} AS MATERIALIZED (SELECT j, coalesce(n.c, o.c) AS c FROM c{i} o LEFT JOIN ({means}) n USING (j))")
    parts.append(near(rounds))
    return f"""WITH {", ".join(parts)}
SELECT vec_id, j::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY j)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
  sha256(array_to_string(c, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} USING (j)"""


SQL = sql()
