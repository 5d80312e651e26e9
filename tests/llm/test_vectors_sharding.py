"""Centroids, hard negatives and sharding against brute force, with nulls, ties, repeats, odd sizes and empty tables."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from casebook.llm import centroids, negatives, sharding
from casebook.llm.common import table

DATA = "/root/testdata/sf0.01"
KIND = "vec_id long, embedding array<float>, label int, cluster string, rid string, q string, bucket string, rank int"


def vectors(spark, n=700, dims=64, odd=True):
    """Clustered vectors with exact copies and near ties; `odd` adds rows that take no part, and repeats."""
    r = np.random.default_rng(5)
    middles = r.normal(size=(6, dims))
    rows = [(i, (middles[i % 6] * 0.3 + r.normal(size=dims) * (0.02 if i % 5 else 0.3)).astype(np.float32).tolist(), i % 10) for i in range(n)]
    rows += [(n + i, rows[7][1], i % 3) for i in range(60)]
    if odd:
        nan, inf = float("nan"), float("inf")
        rows += [(9000, None, 1), (9100, [nan] * dims, 1), (9200, [inf] * dims, 1), (9300, [None, *rows[0][1][1:]], 1), rows[3], rows[100], rows[100]]
    return spark.createDataFrame([(*x, "c", "r", "q", "b", 1) for x in rows], KIND).repartition(5)


def plain_clusters(rows, k=8, rounds=10):
    kept = [(i, [int(np.floor(x * 1024)) for x in v]) for i, v in rows if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted((hashlib.sha256(f"3:{i}".encode()).hexdigest(), q) for i, q in kept if i is not None)[:k]
    q, c = np.array([q for _, q in kept]), np.array([q for _, q in start])
    for turn in range(rounds + 1):
        d = ((q[:, None] - c[None]) ** 2).sum(2)
        own = d.argmin(1)
        for j in range(len(c) if turn < rounds else 0):
            if (own == j).any():
                c[j] = [int(x) // int((own == j).sum()) for x in q[own == j].sum(0)]
    low = d.min(1)
    names = [hashlib.sha256(",".join(map(str, x)).encode()).hexdigest() for x in c.tolist()]
    return sorted((i or -1, int(j), int(x), int(low[own == j].sum()), int(low.sum()), names[j]) for (i, _), j, x in zip(kept, own, low, strict=True))


def test_clusters_as_brute_force(spark):
    some = vectors(spark).unionByName(spark.createDataFrame([(None, [0.5] * 64, None), (5001, [0.25] * 63, 2)], "vec_id long, embedding array<float>, label int"), allowMissingColumns=True)
    got = sorted((r.vec_id or -1, *r[1:6]) for r in centroids.cluster(some).collect())
    assert got == plain_clusters([(r.vec_id, r.embedding) for r in some.collect()])
    few = some.where("vec_id < 3")
    assert {r.distance for r in centroids.cluster(few).collect()} == {0}
    assert centroids.cluster(some.limit(0)).count() == 0


def test_bounds_hold_and_screen():
    r = np.random.default_rng(2)
    for size in (3, 700, 100_000_000):
        q = r.integers(-size, size, (400, 64))
        c = np.concatenate([q[:4] + 1, r.integers(-size, size, (4, 64))])
        codes, shift, errors = centroids.compress(q)
        exact = ((q[:, None].astype(object) - c[None].astype(object)) ** 2).sum(2)
        low = centroids.lower_bounds(codes, shift, errors, (q**2).sum(1), c)
        assert (low <= exact).all()
        own, best, taken = centroids.nearest(q, low, c)
        assert (own == exact.argmin(1)).all() and (best == exact.min(1)).all() and taken.min() == 1
    assert centroids.norms_up(np.array([[1 << 26, 1, *[0] * 6, *[0] * 8]])).tolist() == [[(1 << 26) + 1, 0]]


def test_most_centroids_are_screened(spark):
    out = centroids.cluster(table(spark, DATA, "embeddings"))
    assert out.agg(F.avg("exact")).first()[0] < 2


def test_large_components_are_refused(spark):
    with pytest.raises(Exception, match="or more"):
        centroids.cluster(spark.createDataFrame([(1, [3e8] * 64)], "vec_id long, embedding array<double>")).count()


def plain_negatives(rows):
    held = [(i, lab, [int(np.floor(x * 256)) for x in v]) for i, v, lab in rows if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max((len(q) for *_, q in held), default=0)
    q = np.array([x + [0] * (width - len(x)) for *_, x in held]).reshape(-1, width)
    out = []
    for a, (anchor, label, _) in enumerate(held):
        if anchor is None or anchor % 100:
            continue
        s = (q @ q[a]).tolist()
        order = sorted((b for b in range(len(held)) if b != a), key=lambda b: (-s[b], held[b][0] is None, held[b][0]))
        for p in [b for b in order if held[b][1] == label][:5]:
            inside = [b for b in order if held[b][1] != label and 30 * s[p] <= 100 * s[b] <= 90 * s[p]][:10]
            out += [(anchor, held[p][0] or -1, k + 1, held[b][0] or -1, s[p], s[b]) for k, b in enumerate(inside)]
    return sorted(out)


@pytest.mark.parametrize("dims", [64, 7])
def test_negatives_as_brute_force(spark, monkeypatch, dims):
    monkeypatch.setattr(negatives, "ROWS", 150)
    monkeypatch.setattr(negatives, "ANCHORS", 3)
    more = [(None, [0.2] * dims, 3), (200000, [], 1), (300000, [0.1] * (dims - 2), None), (400000, [0.3] * (dims - 2), 4)]
    some = vectors(spark, dims=dims).unionByName(spark.createDataFrame(more, "vec_id long, embedding array<float>, label int"), allowMissingColumns=True)
    got = negatives.mine(some, F.col("vec_id") % 100 == 0)
    want = plain_negatives([(r.vec_id, r.embedding, r.label) for r in some.collect()])
    assert want and sorted((r.anchor_id, r.positive_id or -1, r["rank"], r.negative_id or -1, r.positive_score, r.negative_score) for r in got.collect()) == want
    assert negatives.mine(some.limit(0), F.col("vec_id") % 100 == 0).count() == 0
    assert negatives.mine(some.where("vec_id = 100").limit(1), F.col("vec_id") % 100 == 0).count() == 0


def test_copies_of_anchors_are_not_broadcast(spark, capsys):
    """Their size is anchors times buckets, which Spark's estimate doesn't see, so the driver ran out of memory."""
    stored = spark.range(4).select(F.col("id").cast("int").alias("bucket"), F.lit(b"r").alias("ids"))
    met = negatives.met(stored, spark.range(2).select(F.lit(b"a").alias("a_ids")), 4)
    met.explain()
    assert "Broadcast" not in capsys.readouterr().out
    assert met.count() == 8 and negatives.BUCKETS <= 64


def test_few_rows_are_scored_exactly():
    """Of the rows looked up, few get an exact score, and all that may enter do."""
    r = np.random.default_rng(1)
    q = (r.normal(size=(4000, 64)) * 30 + 40 * r.normal(size=(10, 64))[np.arange(4000) % 10]).astype(np.int64)
    cells = negatives.Cells(np.quantile(q, np.arange(1, 16) / 16, axis=0, method="lower").T.astype(np.int64), q.min(0), q.max(0))
    codes = cells.codes(q)
    low, up = (negatives.looked_up(t, codes) for t in cells.bounds(q[5]))
    exact = q @ q[5]
    assert (low <= exact).all() and (exact <= up).all()
    rows = {"ids": np.arange(4000), "named": np.ones(4000, bool), "labels": np.arange(4000) % 10, "rids": np.arange(4000), "q": q, "codes": codes}
    best = np.sort(exact[5::10])[-6:-1][::-1]
    anchors = {"a_ids": np.array([5]), "a_labels": np.array([5]), "a_rids": np.array([5]), "a_q": q[5:6], "a_scores": np.array([5, *best]), "a_positives": np.arange(5), "a_named": np.ones(5, bool)}
    seen = [0, 0]
    rows_out = list(negatives.negatives_in(cells, 5, 10, 30, 90, seen)(rows, anchors))
    assert seen[0] == 4000 and 0 < seen[1] < 800 and len(rows_out) <= 5


def jump(key: int, n: int) -> int:
    """The published algorithm, in plain numbers."""
    b, j, key = -1, 0, key % (1 << 64)
    while j < n:
        b = j
        key = (key * 2862933555777941757 + 1) % (1 << 64)
        j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
    return b


def test_jumps_as_published(spark):
    r = np.random.default_rng(3)
    keys = [0, 1, -1, 2**63 - 1, -(2**63), *range(2, 300), *r.integers(-(2**63), 2**63 - 1, 500).tolist()]
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    for n in (1, 2, 8, 100, 5000):
        got = {r.k: (r.j.now, r.j.grown) for r in rows.select("k", sharding.jumps(F.col("k"), n).alias("j")).collect()}
        assert got == {k: (jump(k, n), jump(k, n + 1)) for k in keys}


ODD = "doc_id long, text string, shard string, slot string, rid string, `a.b` int"


def odd_docs(spark):
    rows = [(None, "x"), (None, None), (3, None), (4, ""), (5, "é☃" * 100_000), *[(7, "same")] * 400, *[(i, f"text {i}") for i in range(10, 400)]]
    return spark.createDataFrame([(*x, "a", "b", "c", 1) for x in rows], ODD).repartition(6)


def test_shards(spark):
    docs = odd_docs(spark)
    rows = sharding.shard(docs).collect()
    texts = sorted((r.doc_id or 0, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert sorted((r.doc_id or 0, r.size, r.text_crc32) for r in rows) == texts
    for s in range(8):
        own = sorted((r.slot, r.doc_id or 0) for r in rows if r.shard == s)
        assert [x for x, _ in own] == list(range(len(own))) and [x for _, x in own] == sorted(x for _, x in own)
    assert all(r.shard == jump(r.doc_id or 0, 8) and r.grown_shard in (r.shard, 8) and r.law == "key" for r in rows)
    assert any(r.grown_shard == 8 for r in rows) and sharding.shard(docs.limit(0)).count() == 0


def test_written_shards_and_growth(spark, tmp_path):
    docs = odd_docs(spark).drop("shard")
    sharding.write_shards(docs, f"{tmp_path}/s", 8)
    back = spark.read.parquet(f"{tmp_path}/s")
    assert back.count() == docs.count() and back.where("text is null").count() == 2
    assert all(r.shard == jump(r.doc_id or 0, 8) for r in back.select("doc_id", "shard").collect())
    left = sharding.leaving(docs, 8, 10).collect()
    assert left and {r.new_shard for r in left} <= {8, 9} and all(r.old_shard == jump(r.doc_id or 0, 8) for r in left)
    with pytest.raises(ValueError, match="column shard"):
        sharding.write_shards(odd_docs(spark), f"{tmp_path}/t", 8)
    by_name = docs.withColumn("name", F.when(F.col("doc_id") > 20, F.concat(F.lit("n"), F.col("doc_id").cast("string"))))
    assert by_name.select(sharding.shard_of(by_name, "name", 8).alias("s")).distinct().count() == 8


@pytest.mark.parametrize("call", [lambda d: sharding.shard(d)])
def test_sharding_runs_no_python(spark, call):
    plan = call(table(spark, DATA, "documents"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "InArrow" not in plan and "InPandas" not in plan
