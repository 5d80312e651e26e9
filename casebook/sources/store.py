"""Snapshots, JSON lines, checkpoints, and the tables of an index: readers and sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from casebook.operators.relational import latest
from casebook.schema import CHECKPOINT, DOCUMENT, REF
from casebook.sources.shared import stored

MANIFEST = "sha256 string, url string, retrieved_at timestamp, status int, params string, headers map<string,string>, adapter string, bytes long"
SNAPSHOT = f"{MANIFEST}, body binary"


def exists(spark: SparkSession, path: str) -> bool:
    """By the file system that the path names."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it is there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


# ---- Snapshots


def read_exchange(spark: SparkSession, root: str, adapter: str) -> DataFrame:
    """Snapshots of an exchange folder, `<adapter>/aa/bb/<sha256>.json` and `.bin`, that have both files."""
    manifests = spark.read.schema(MANIFEST).option("recursiveFileLookup", True).option("multiLine", True).option("pathGlobFilter", "*.json").json(f"{root}/{adapter}")
    bodies = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.bin").load(f"{root}/{adapter}")
    bodies = bodies.select(F.regexp_extract("path", r"([0-9a-f]{64})\.bin$", 1).alias("sha256"), F.col("content").alias("body"))
    return manifests.join(bodies, "sha256")


def read_snapshots(spark: SparkSession, root: str, adapter: str | None = None) -> DataFrame:
    """Snapshots that `write_snapshots` wrote; an adapter prunes folders. A missing store is empty."""
    if not exists(spark, root):
        return spark.createDataFrame([], SNAPSHOT)
    rows = spark.read.schema(f"{SNAPSHOT}, bucket string").parquet(root)
    return (rows.where(F.col("adapter") == adapter) if adapter else rows).drop("bucket")


def in_hash_order(snapshots: DataFrame) -> DataFrame:
    return snapshots.orderBy("adapter", "sha256")


def get_snapshot(spark: SparkSession, root: str, adapter: str, sha256: str) -> DataFrame:
    """No row or one: the folders of adapter and hash prefix are all that is read."""
    return spark.read.schema(f"{SNAPSHOT}, bucket string").parquet(root).where((F.col("adapter") == adapter) & (F.col("bucket") == sha256[:2]) & (F.col("sha256") == sha256)).drop("bucket") if exists(spark, root) else read_snapshots(spark, root)


def count_snapshots(spark: SparkSession, root: str, adapter: str) -> int:
    return read_snapshots(spark, root, adapter).count()


def body_text(body: Column) -> Column:
    """UTF-8, what isn't that replaced."""
    return F.decode(body, "UTF-8")


def body_json(body: Column) -> Column:
    """As a variant; null where it isn't JSON."""
    return F.try_parse_json(F.decode(body, "UTF-8"))


def is_pdf(body: Column) -> Column:
    return F.coalesce(F.startswith(body, F.lit(b"%PDF")), F.lit(False))


def by_kind(snapshots: DataFrame, kinds: list[str], strict: bool = True) -> dict[str, DataFrame]:
    """Rows of each kind that their parameters name; with `strict`, an unknown kind stops whoever reads any of them."""
    kind = F.get_json_object("params", "$.kind")
    known = F.coalesce(kind.isin(kinds), F.lit(False))
    checked = F.when(known, kind).otherwise(F.raise_error(F.concat(F.lit("unknown snapshot kind: "), F.coalesce(kind, F.lit("none"))))) if strict else kind
    rows = snapshots.withColumn("kind", checked)
    return {k: rows.where(F.col("kind") == k).drop("kind") for k in kinds}


def new_snapshots(incoming: DataFrame, known: DataFrame) -> DataFrame:
    """Content-addressed: bodies not seen yet, the first writer of each hash wins."""
    key = ["adapter", "sha256"] if "adapter" in incoming.columns and "adapter" in known.columns else ["sha256"]
    hashed = incoming.withColumn("sha256", F.sha2("body", 256))
    return latest(hashed.join(known.select(*key), key, "left_anti"), key, [F.col("retrieved_at"), F.col("url")])


def write_snapshots(new: DataFrame, path: str) -> None:
    """Append rows, each with its manifest and body together, in folders by adapter and two digits of the hash."""
    have = set(new.columns)
    fill = {"status": F.lit(200), "params": F.lit("{}"), "headers": F.create_map().cast("map<string,string>"), "adapter": F.lit("unknown"), "bytes": F.length("body").cast("long")}
    rows = new.withColumns({k: v for k, v in fill.items() if k not in have}).select(*(x.split(" ")[0] for x in SNAPSHOT.split(", ")))
    rows.withColumn("bucket", F.substring("sha256", 1, 2)).hint("rebalance", "adapter", "bucket").write.mode("append").partitionBy("adapter", "bucket").parquet(path)


def put(spark: SparkSession, root: str, incoming: DataFrame) -> None:
    """Write the bodies that the store doesn't have yet."""
    write_snapshots(new_snapshots(incoming, read_snapshots(spark, root)), root)


# ---- JSON lines


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of documents; a bad line stops the read, a missing path is empty."""
    return spark.read.schema(DOCUMENT).option("mode", "FAILFAST").json(path) if exists(spark, path) else spark.createDataFrame([], DOCUMENT)


def read_refs(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of edges; a missing path is empty."""
    rows = spark.read.schema(REF).option("mode", "FAILFAST").json(path) if exists(spark, path) else spark.createDataFrame([], REF)
    return rows.withColumnsRenamed({"from": "from_urn", "to": "to_urn"})


def write_jsonl(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


# ---- Checkpoints


def read_checkpoint(spark: SparkSession, path: str) -> DataFrame:
    """Torn or invalid lines are skipped; a missing path is empty."""
    if not exists(spark, path):
        return spark.createDataFrame([], CHECKPOINT)
    return spark.read.schema(CHECKPOINT).option("mode", "DROPMALFORMED").json(path).where("key is not null")


def mark(done: DataFrame, keys: DataFrame) -> DataFrame:
    """Checkpoint rows to append: keys not marked yet, once each."""
    return keys.dropDuplicates(["key"]).join(done.select("key"), "key", "left_anti")


def mark_empty(done: DataFrame, keys: DataFrame, reason: str) -> DataFrame:
    """Rows for units that rightly gave nothing, with the reason, so that they aren't asked for again."""
    return mark(done, keys.select("key").withColumn("note", F.lit(f"empty: {reason}")))


def write_marks(rows: DataFrame, path: str, at: Column | None = None) -> None:
    have = rows if "note" in rows.columns else rows.withColumn("note", F.lit(None).cast("string"))
    have.select("key", (F.current_timestamp() if at is None else at).alias("at"), "note").write.mode("append").json(path)


# ---- Tables of an index

TABLES = {
    "documents": DOCUMENT + ", canonical_urn string, level string, year int",
    "refs": "from_urn string, to_urn string, kind string, raw string, confidence double, resolver string",
    "aliases": "alias string, urn string, kind string",
    "near": "part string, name string, urn string",
    "corpus_meta": "corpus string, document_count long, earliest date, latest date, last_fetch timestamp, coverage_pct double, adapter_version string, parser_rev int, quality string",
}
PARTITIONS = {"documents": ["corpus", "year"]}


def init(spark: SparkSession, root: str) -> None:
    """Create the tables that aren't there yet, empty; running it again changes nothing."""
    for name, columns in TABLES.items():
        if not exists(spark, f"{root}/{name}"):
            spark.createDataFrame([], columns).write.partitionBy(*PARTITIONS.get(name, [])).parquet(f"{root}/{name}")


def connect(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of an index, for reading; FileNotFoundError if there is none."""
    if not exists(spark, f"{root}/documents"):
        raise FileNotFoundError(f"no index in {root}")
    return {name: spark.read.schema(columns).parquet(f"{root}/{name}") if exists(spark, f"{root}/{name}") else spark.createDataFrame([], columns) for name, columns in TABLES.items()}


def promoted(docs: DataFrame) -> DataFrame:
    """What filters ask for as columns of their own, so that it reaches the scan: canonical urn, level, year."""
    return docs.withColumn("canonical_urn", F.get_json_object("meta", "$.canonical_urn")).withColumn("level", F.get_json_object("meta", "$.level")).withColumn("year", F.year("issued"))


def insert_documents(docs: DataFrame, path: str) -> None:
    """Parquet by corpus and year of issue, so that filters on either prune folders; rows of a urn once (the latest
    retrieved, then by hash). `docs` is all there is: folders that it has no row for go."""
    once = latest(promoted(docs), ["urn"], [F.desc("provenance.retrieved_at"), F.col("provenance.snapshot_sha256")])
    once.hint("rebalance", "corpus", "year").sortWithinPartitions("corpus", "year", "urn").write.mode("overwrite").partitionBy("corpus", "year").parquet(path)


write_corpus = insert_documents


def upsert_documents(docs: DataFrame, path: str) -> None:
    """Rows replace those of their urn, the last retrieved of a urn's rows wins, and what isn't given stays. Only folders
    that gain, change or lose a row are written again; one that loses all its rows goes."""
    spark = docs.sparkSession
    once = stored(latest(promoted(docs), ["urn"], [F.desc("provenance.retrieved_at"), F.col("provenance.snapshot_sha256")]))
    old = spark.read.schema(TABLES["documents"]).parquet(path)
    gone = old.join(once.select("urn"), "urn", "left_semi").select("corpus", "year")
    touched = stored(gone.unionByName(once.select("corpus", "year")).distinct())
    here = (F.col("o.corpus") == F.col("t.corpus")) & F.col("o.year").eqNullSafe(F.col("t.year"))
    kept = old.alias("o").join(touched.alias("t"), here, "left_semi").join(once.select("urn"), "urn", "left_anti")
    rows = stored(kept.unionByName(once.select(*kept.columns)))
    rows.hint("rebalance", "corpus", "year").sortWithinPartitions("corpus", "year", "urn").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("corpus", "year").parquet(path)
    left = rows.select("corpus", "year").distinct().alias("o")
    for r in touched.alias("t").join(left, here, "left_anti").collect():  # folders, at most one a corpus and year
        remove(spark, f"{path}/corpus={r['corpus']}/year={'__HIVE_DEFAULT_PARTITION__' if r['year'] is None else r['year']}")


def insert_refs(refs: DataFrame, path: str) -> None:
    """Edges, each once."""
    refs.select("from_urn", "to_urn", "kind", "raw", "confidence", "resolver").dropDuplicates().write.mode("overwrite").parquet(path)
