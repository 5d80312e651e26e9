"""A search index that grows by segments.

A batch of upserts writes one segment, an index of the batch's documents, and for each older segment the ids that the batch
replaces in it; nothing that was written is touched. Segments of one size tier are merged once there are FAN of them, so a
row is rewritten about log FAN (rows) times. The manifest is a table with a row a segment, partitioned by version; a
reader takes the greatest version, so it sees a batch whole or not at all.

Reading is a union of the segments less their replaced ids. Documents and tokens are summed when a batch is written. What
replaced rows had added to the terms' levels is written as negative counts, so that top-k search knows a term's documents
without reading its list. Batches come one after another; an empty batch makes no segment. Of rows of one id in a batch
the last by the order given counts. Null ids can't be replaced, so they are refused.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.operators import search as fts
from casebook.operators.relational import latest

FAN = 4
MANIFEST = "segment string, docs long, tokens long, live_docs long, live_tokens long, stem boolean"


def manifest(spark: SparkSession, path: str) -> tuple[int, list[dict]]:
    """The newest version (0: none) and its segments, oldest first: a row each."""
    try:
        rows = spark.read.schema(f"{MANIFEST}, version int").parquet(f"{path}/manifest")
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return 0, []
    version = rows.agg(F.max("version")).first()[0] or 0
    return version, [r.asDict() for r in rows.where(F.col("version") == version).orderBy("segment").collect()]


def _publish(spark: SparkSession, path: str, version: int, segments: list[dict]) -> None:
    rows = [tuple(s[c.split()[0]] for c in MANIFEST.split(", ")) for s in segments]
    spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{path}/manifest/version={version}")


def _replaced(spark: SparkSession, path: str, segments: list[dict]) -> DataFrame:
    """segment, id: what later batches replaced, of these segments."""
    names = [s["segment"] for s in segments]
    if all(s["docs"] == s["live_docs"] for s in segments):
        kind = spark.read.parquet(f"{path}/{names[0]}/lengths").schema["id"].dataType.simpleString()
        return spark.createDataFrame([], f"segment string, id {kind}")
    return spark.read.parquet(f"{path}/replaced").where(F.col("segment").isin(names)).select("segment", "id")


def _live(spark: SparkSession, path: str, segments: list[dict], table: str) -> DataFrame:
    """Rows of a table of the segments without those of replaced ids."""
    parts = []
    for s in segments:
        at = f"{path}/{s['segment']}"
        rows = read(spark, at) if (read := {"postings": fts.postings, "frequencies": fts.frequencies}.get(table)) else spark.read.parquet(f"{at}/{table}")
        if s["docs"] != s["live_docs"]:
            rows = rows.join(_replaced(spark, path, [s]).select("id"), "id", "left_anti")
        parts.append(rows)
    return reduce(DataFrame.unionByName, parts)


def _index(spark: SparkSession, path: str, segments: list[dict]) -> fts.Index:
    docs, tokens = (sum(s[c] for s in segments) for c in ("live_docs", "live_tokens"))
    mean = tokens / docs if docs else None
    # impacts of a segment hold for its own mean, the least of which bounds them all
    built = min((s["tokens"] / s["docs"] for s in segments if s["tokens"]), default=mean)
    levels = reduce(DataFrame.unionByName, (spark.read.parquet(f"{path}/{s['segment']}/levels") for s in segments))
    if any(s["docs"] != s["live_docs"] for s in segments):
        taken = spark.read.parquet(f"{path}/taken").where(F.col("segment").isin([s["segment"] for s in segments]))
        levels = levels.unionByName(taken.select("term", F.lit(-1).alias("level"), (-F.col("rows")).alias("rows")))
    stats = spark.createDataFrame([(docs, mean, built)], "docs long, mean double, built double")
    held = _live(spark, path, segments, "postings")
    return fts.Index(fts.occurring(held), _live(spark, path, segments, "lengths"), segments[0]["stem"], stats, _live(spark, path, segments, "frequencies"), levels, grouped=held)


def opened(spark: SparkSession, path: str) -> fts.Index:
    """The index of all live documents; statistics are sums over the segments."""
    version, segments = manifest(spark, path)
    if not version:
        raise FileNotFoundError(f"no index at {path}")
    return _index(spark, path, segments)


def upsert(docs: DataFrame, path: str, key: str, columns: list[str], order: list[Column] | None = None, stem: bool = False) -> int:
    """Add a batch as a segment, taking back older rows of its ids; merge what is due. Returns the new version."""
    spark = docs.sparkSession
    version, segments = manifest(spark, path)
    name = f"s{version + 1:09d}"
    batch = latest(docs, [key], order) if order else docs
    fts.build(batch, key, columns, stem).written(f"{path}/{name}")
    lengths = spark.read.parquet(f"{path}/{name}/lengths")
    facts = lengths.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count_if(F.col("id").isNull()).alias("nulls"), F.count_distinct("id").alias("ids")).first()
    if facts["nulls"] or facts["ids"] < facts["docs"]:
        raise ValueError("ids of a batch must be there and differ (or an order must say which row is the last)")
    if not facts["docs"]:
        return version
    ids = lengths.select("id")
    old = []
    for s in segments:
        hit = _live(spark, path, [s], "lengths").join(ids, "id", "left_semi")
        target = f"{path}/replaced/segment={s['segment']}/by={name}"
        hit.select("id", "n").write.mode("overwrite").parquet(target)
        gone = spark.read.schema(hit.schema).parquet(target)
        n = gone.agg(F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
        if n["docs"]:
            lists = fts.frequencies(spark, f"{path}/{s['segment']}").join(gone.select("id"), "id", "left_semi")
            lists.groupBy("term").agg(F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{path}/taken/segment={s['segment']}/by={name}")
        old.append(s | {"live_docs": s["live_docs"] - n["docs"], "live_tokens": s["live_tokens"] - n["tokens"]})
    new = {"segment": name, "docs": facts["docs"], "tokens": facts["tokens"], "live_docs": facts["docs"], "live_tokens": facts["tokens"], "stem": stem}
    _publish(spark, path, version + 1, [*(s for s in old if s["live_docs"]), new])
    return merge(spark, path)


def tier(docs: int) -> int:
    out = 0
    while docs >= FAN:
        docs, out = docs // FAN, out + 1
    return out


def merge(spark: SparkSession, path: str) -> int:
    """Merge segments as long as a tier of documents written, live or replaced, holds FAN of them. So replaced rows are let go
    no later than if they were live. Returns the version."""
    version, segments = manifest(spark, path)
    while due := next((same for s in segments if len(same := [x for x in segments if tier(x["docs"]) == tier(s["docs"])]) >= FAN), None):
        name = f"s{version + 1:09d}"
        live = _index(spark, path, due)
        fts.Index(live.postings, live.lengths, live.stem, grouped=live.grouped).written(f"{path}/{name}")
        docs, tokens = (sum(s[c] for s in due) for c in ("live_docs", "live_tokens"))
        version, segments = version + 1, [*(s for s in segments if s not in due), {"segment": name, "docs": docs, "tokens": tokens, "live_docs": docs, "live_tokens": tokens, "stem": live.stem}]
        _publish(spark, path, version, segments)
    return version
