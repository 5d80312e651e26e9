"""Fetch, normalise, enrich and index: the stages from sources to an index, under one root folder.

`snapshots/` holds what was fetched, `documents/<source>` and `refs/<source>` JSON lines, `checkpoints/<source>` marks,
`index/` the tables and the search index. Each stage but the first is a pure function of the folder before it.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.functions import text as T
from casebook.functions import urn as U
from casebook.operators import near, segments
from casebook.operators import relational as R
from casebook.sources import policy, registry, store
from casebook.sources.shared import stored

#: Snapshots that are held on the driver before they are written.
HELD_BYTES = 64 << 20


class _Sink:
    """Snapshots and marks of finished units, written in groups; a unit is marked after its snapshots are."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.root, self.name, self.rows, self.marks, self.size = spark, root, name, [], [], 0

    def add(self, key: str, snapshots: list[tuple], note: str | None = None) -> None:
        now = datetime.now(timezone.utc).replace(tzinfo=None)
        self.rows += [(url, now, status, json.dumps(params), self.name, body) for url, body, status, params in snapshots]
        self.marks.append((key, now, note))
        self.size += sum(len(x[1]) for x in snapshots)
        if self.size > HELD_BYTES:
            self.flush()

    def flush(self) -> None:
        if self.rows:
            rows = self.spark.createDataFrame(self.rows, "url string, retrieved_at timestamp, status int, params string, adapter string, body binary")
            store.put(self.spark, f"{self.root}/snapshots", rows)
        if self.marks:
            store.write_marks(self.spark.createDataFrame(self.marks, store.CHECKPOINT).drop("at"), f"{self.root}/checkpoints/{self.name}")
        self.rows, self.marks, self.size = [], [], 0


def fetch(spark: SparkSession, root: str, name: str, since: str | None = None, until: str | None = None, limit: int | None = None, min_interval: float | None = None, client=None, **options) -> dict[str, int]:
    """Fetch what the source plans and isn't marked; then, in further rounds, what the new snapshots make known.

    A unit that fails stays pending; one that gives nothing, or that robots.txt forbids, is marked with the reason; at
    the cap of requests the run stops. Requests are made one by one, so units are drawn on the driver as they are due.
    """
    source = registry.get(name)
    client = client or policy.Client(policy.POLICIES[name].merge(min_interval))
    sink = _Sink(spark, root, name)
    counts = dict.fromkeys(("fetched", "failures", "skipped", "empty"), 0)
    failed: set[str] = set()

    def run(units: DataFrame) -> bool:
        """False if the run must stop."""
        done = store.read_checkpoint(spark, f"{root}/checkpoints/{name}").select("key").distinct()
        units = units.dropDuplicates(["key"])
        counts["skipped"] += R.finished(units, done, ["key"]).count()
        for unit in R.pending(units, done, ["key"]).orderBy("key").toLocalIterator():
            if limit is not None and counts["fetched"] >= limit:
                return False
            if unit.key in failed:
                continue
            try:
                found = list(source.fetch(json.loads(unit.payload), client, **{k: v for k, v in options.items() if k in source.fetch.__code__.co_varnames}))
            except policy.Disallowed:
                sink.add(unit.key, [], "empty: robots_disallowed")
                continue
            except policy.CapReached:
                return False
            except Exception as e:  # noqa: BLE001 - whatever a source does, its unit stays pending
                counts["failures"] += 1
                failed.add(unit.key)
                print(f"{unit.key} stays pending: {e}")
                continue
            sink.add(unit.key, found, None if found else "empty: no_data")
            counts["fetched" if found else "empty"] += 1
        return True

    def snapshots() -> DataFrame:
        sink.flush()
        return store.read_snapshots(spark, f"{root}/snapshots", name)

    on = run(source.plan(spark, since, until, **options))
    if on and name == "elitigation":
        from casebook.plans import judgments

        first = snapshots().withColumn("p", F.from_json("params", judgments.PARAMS)).where("p.kind = 'listing' and p.page = 1")
        latest = R.latest(first.select(F.col("p.filter").alias("filter"), F.col("p.year").alias("year"), "retrieved_at", "sha256", "body"), ["filter", "year"], [F.desc("retrieved_at"), F.col("sha256")])
        last = {(r["filter"], r["year"]): r["n"] for r in latest.select("filter", "year", judgments.listing(F.decode("body", "UTF-8"))["pages"].alias("n")).collect()}  # one row a filter and year
        on = run(source.plan(spark, since, until, last=last))
    if on and source.units is not None:
        run(source.units(snapshots(), since=since, until=until, **options))
    sink.flush()
    return counts | {"requests": client.requests, "snapshots_total": store.count_snapshots(spark, f"{root}/snapshots", name)}


def normalise(spark: SparkSession, root: str, name: str, stale_only: bool = False) -> dict[str, int]:
    """Parse all snapshots of a source again, or those that no document of the current revision comes from."""
    source = registry.get(name)
    snaps = store.read_snapshots(spark, f"{root}/snapshots", name)
    path = f"{root}/documents/{name}"
    if stale_only:
        old = store.read_documents(spark, path)
        fresh = old.where(F.col("provenance.parser_rev") >= source.revision)
        kept = fresh.select("provenance.snapshot_sha256").distinct()
        snaps = snaps.join(kept, snaps.sha256 == kept.snapshot_sha256, "left_anti")
        docs = fresh.unionByName(source.parse(snaps))
        store.write_jsonl(docs, f"{path}.new")
        store.write_jsonl(store.read_documents(spark, f"{path}.new"), path)
    else:
        store.write_jsonl(source.parse(snaps), path)
    return {"snapshots": snaps.count(), "documents": store.read_documents(spark, path).count(), "failures": source.failures(snaps).count(), "parser_rev": source.revision}


def enrich(docs: DataFrame) -> DataFrame:
    """An extension: edges of kind cites from the citations in texts. Judgments cited resolve to their urn, reports and statutes stay raw.

    Confidence is 1 for an indexed judgment, 0.5 for another, 0 for what isn't resolved.
    """
    found = None
    for resolver, pattern in (("neutral", T.NEUTRAL), ("report", T.REPORT), ("statute", T.STATUTE_IN_ACT)):
        own = R.citations(docs, "urn", "text", pattern).select(F.col("urn").alias("from_urn"), "raw", F.lit(resolver).alias("resolver"))
        found = own if found is None else found.unionByName(own)
    found = found.distinct().withColumn("to_urn", F.when(F.col("resolver") == "neutral", U.from_neutral_citation(F.col("raw")))).where("to_urn is null or to_urn <> from_urn")
    known = docs.select(F.col("urn").alias("to_urn"), F.lit(True).alias("known")).distinct()
    rows = found.join(known, "to_urn", "left")
    return rows.select("from_urn", "to_urn", F.lit("cites").alias("kind"), "raw", F.when(F.col("known"), 1.0).when(F.col("to_urn").isNotNull(), 0.5).otherwise(0.0).alias("confidence"), "resolver")


def write_refs(refs: DataFrame, path: str) -> None:
    store.write_jsonl(refs.withColumnsRenamed({"from_urn": "from", "to_urn": "to"}), path)


SEARCHED = ["title", "citation", "text"]


def index(spark: SparkSession, root: str, names: list[str] | None = None, update: bool = False) -> dict[str, object]:
    """Tables of all documents and edges of the sources, the search index, near citations, and the statistics. With
    `update`, documents that the index has from the same snapshot and revision stay as they are, and so do those that no
    source has now; the others are added to the tables, and to the search index as a segment."""
    names = names or list(registry.REGISTRY)
    place = f"{root}/index"
    store.init(spark, place)
    docs = refs = None
    for name in names:
        for kind, read in (("documents", store.read_documents), ("refs", store.read_refs)):
            rows = read(spark, f"{root}/{kind}/{name}")
            if kind == "documents":
                docs = rows if docs is None else docs.unionByName(rows)
            else:
                refs = rows if refs is None else refs.unionByName(rows)
    if update:
        at = ["urn", "provenance.snapshot_sha256", "provenance.parser_rev"]
        had = store.connect(spark, place)["documents"].select(*at).toDF("urn", "sha", "rev")
        docs = stored(docs.join(had, (docs.urn == had.urn) & docs.provenance.snapshot_sha256.eqNullSafe(had.sha) & docs.provenance.parser_rev.eqNullSafe(had.rev), "left_anti"))
        store.upsert_documents(docs, f"{place}/documents")
        docs = docs.join(store.connect(spark, place)["documents"].select(*at).toDF("urn", "sha", "rev").withColumnRenamed("urn", "u"), (F.col("urn") == F.col("u")) & F.col("provenance.snapshot_sha256").eqNullSafe(F.col("sha")) & F.col("provenance.parser_rev").eqNullSafe(F.col("rev")), "left_semi")
    else:
        store.insert_documents(docs, f"{place}/documents")
        store.remove(spark, f"{place}/search")
        docs = store.connect(spark, place)["documents"]
    segments.upsert(docs, f"{place}/search", "urn", SEARCHED, [F.desc("provenance.retrieved_at"), F.col("provenance.snapshot_sha256")], stem=True)
    store.insert_refs(refs, f"{place}/refs")
    tables = store.connect(spark, place)
    near.index(tables["documents"], "citation").repartitionByRange("part").sortWithinPartitions("part").write.mode("overwrite").parquet(f"{place}/near")
    R.corpus_meta(tables["documents"]).coalesce(1).write.mode("overwrite").parquet(f"{place}/corpus_meta")
    return {"documents": tables["documents"].count(), "refs": tables["refs"].count(), "index": place}


def stale(docs: DataFrame) -> DataFrame:
    """Documents that an older revision of their source's parser made."""
    now = F.create_map(*(F.lit(x) for s in registry.REGISTRY.values() for x in (s.name, s.revision)))
    return docs.where(F.col("provenance.parser_rev") < F.try_element_at(now, F.col("provenance.adapter")))


def freshness(docs: DataFrame, cadence_days: dict[str, int], today: str) -> DataFrame:
    """corpus, latest, age_days, overdue: the newest document of each corpus against the days within which one is due."""
    due = F.create_map(*(F.lit(x) for kv in cadence_days.items() for x in kv))
    age = F.date_diff(F.lit(today).cast("date"), F.col("latest"))
    rows = docs.groupBy("corpus").agg(F.max("issued").alias("latest"))
    return rows.select("corpus", "latest", age.alias("age_days"), F.coalesce(age > F.try_element_at(due, F.col("corpus")), F.lit(False)).alias("overdue"))
