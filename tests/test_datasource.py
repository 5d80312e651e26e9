"""The source `casebook` against the readers that Spark has."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from casebook.schema import DOCUMENT
from casebook.sources import datasource, store


@pytest.fixture(scope="module")
def source(spark):
    datasource.register(spark)
    return lambda kind, path, **more: spark.read.format("casebook").options(kind=kind, **more).load(str(path))


def snapshots(spark, n=40):
    rows = spark.range(n).select(F.concat(F.lit("body é "), F.col("id").cast("string")).cast("binary").alias("body"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("url"), F.timestamp_seconds(F.col("id") + 1600000000).alias("retrieved_at"), F.lit(200).alias("status"), F.lit('{"kind": "page"}').alias("params"), F.create_map(F.lit("a"), F.lit("b")).alias("headers"), F.when(F.col("id") % 3 == 0, "sso").otherwise("pdpc").alias("adapter"))
    return rows.repartition(3)


def test_exchange_round_trip(spark, source, tmp_path):
    rows = snapshots(spark)
    for _ in range(2):
        rows.unionByName(rows.limit(5)).write.format("casebook").option("kind", "exchange").mode("append").save(str(tmp_path))
    back = source("exchange", tmp_path)
    assert back.count() == 40 and back.where("sha2(body, 256) <> sha256 or length(body) <> bytes").isEmpty()
    assert sorted(r.url for r in back.collect()) == sorted(r.url for r in rows.collect())
    plain = store.read_exchange(spark, str(tmp_path), "pdpc").select(*(c for c in back.columns))
    own = source("exchange", tmp_path, adapter="pdpc")
    key = lambda df: sorted((r.sha256, r.url, r.retrieved_at, r.status, r.params, r.headers["a"], r.adapter, r.bytes, bytes(r.body)) for r in df.collect())
    assert key(own) == key(plain) and own.rdd.getNumPartitions() > 4
    next(tmp_path.glob("pdpc/*/*/*.bin")).unlink()
    assert source("exchange", tmp_path).count() == 39
    assert source("exchange", tmp_path / "none").count() == 0


def test_json_lines(spark, source, tmp_path):
    docs = spark.createDataFrame([("urn:sg:act:A", "act", "T", ["a", "b"], '{"x": 1}'), ("urn:sg:act:B", "act", None, None, None)], "urn string, corpus string, title string, parts array<string>, meta string").withColumn("issued", F.lit("2020-01-02").cast("date"))
    docs = docs.withColumn("provenance", F.struct(F.lit("u").alias("source_url"), F.timestamp_seconds(F.lit(0)).alias("retrieved_at"), F.lit("s").alias("snapshot_sha256"), F.lit("a").alias("adapter"), F.lit("1").alias("adapter_version"), F.lit(3).alias("parser_rev")))
    store.write_jsonl(docs, str(tmp_path / "d"))
    assert source("documents", tmp_path / "d").schema == spark.createDataFrame([], DOCUMENT).schema
    assert sorted(map(str, source("documents", tmp_path / "d").collect())) == sorted(map(str, store.read_documents(spark, str(tmp_path / "d")).collect()))
    (tmp_path / "r.jsonl").write_text('{"from": "a", "to": "b", "kind": "cites", "raw": "x", "confidence": 0.5, "resolver": "r"}\n')
    assert tuple(source("refs", tmp_path / "r.jsonl").first()) == ("a", "b", "cites", "x", 0.5, "r")
    (tmp_path / "bad.jsonl").write_text('{"urn": "a"}\n\n{"urn": \n')
    with pytest.raises(Exception, match=r"bad.jsonl:3"):
        source("documents", tmp_path / "bad.jsonl").count()
    with pytest.raises(Exception, match="one of"):
        spark.read.format("casebook").schema("a int").option("kind", "nothing").load(str(tmp_path)).count()


def test_torn_checkpoints(source, tmp_path):
    (tmp_path / "c.jsonl").write_text('{"key": "a", "at": "2020-01-01T00:00:00+00:00"}\n7\n{"at": null}\n{"key": "b", "at": "2020')
    assert [(r.key, r.note) for r in source("checkpoint", tmp_path / "c.jsonl").collect()] == [("a", None)]


def test_stream_of_new_files(spark, source, tmp_path):
    def run():
        rows = spark.readStream.format("casebook").option("kind", "documents").load(str(tmp_path / "in"))
        rows.select("urn").writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start().awaitTermination(120)
        return sorted(r.urn for r in spark.read.schema("urn string").parquet(str(tmp_path / "out")).collect())

    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.jsonl").write_text(json.dumps({"urn": "a"}) + "\n")
    assert run() == ["a"]
    assert run() == ["a"]
    (tmp_path / "in/b.jsonl").write_text(json.dumps({"urn": "b"}) + "\n" + json.dumps({"urn": "c"}) + "\n")
    assert run() == ["a", "b", "c"]
