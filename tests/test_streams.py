"""Keyed state: restarts, repeated and late keys, failed batches, forgetting."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from casebook.streaming import incremental, keyed

SCHEMA = "key string, n long, at timestamp"


def put(spark, path, rows):
    frame = spark.createDataFrame(rows, "key string, n long").withColumn("at", F.timestamp_seconds(F.col("n")))
    frame.coalesce(1).write.mode("append").parquet(path)


def run(spark, tmp_path, make):
    keyed.written_once(make(keyed.read_files(spark, f"{tmp_path}/in", SCHEMA, 1)), f"{tmp_path}/out", f"{tmp_path}/ck").awaitTermination(120)
    return sorted((r.key or "", r.n) for r in spark.read.schema(SCHEMA).parquet(f"{tmp_path}/out").collect())


def test_units_once_over_restarts(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [("a", 2), ("a", 1), ("b", 3), (None, 4)])
    once = lambda rows: keyed.once_per_key(rows, ["key"], ["n"])
    assert run(spark, tmp_path, once) == [("", 4), ("a", 1), ("b", 3)]
    put(spark, f"{tmp_path}/in", [("a", 0), ("c", 5)])
    put(spark, f"{tmp_path}/in", [("b", -9), ("c", 6), (None, 0)])
    assert run(spark, tmp_path, once) == [("", 4), ("a", 1), ("b", 3), ("c", 5)]


def test_a_failed_batch_stays_pending(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [("a", 1)])
    broken = lambda rows: keyed.once_per_key(rows.withColumn("n", F.when(F.col("key") == "a", F.raise_error(F.lit("no such unit")).cast("long")).otherwise(F.col("n"))), ["key"])
    with pytest.raises(Exception, match="no such unit"):
        run(spark, tmp_path, broken)
    assert run(spark, tmp_path, lambda rows: keyed.once_per_key(rows, ["key"])) == [("a", 1)]


def test_keys_are_forgotten_in_time(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [("a", 1)])
    once = lambda rows: keyed.once_per_key(rows, ["key"], ttl_ms=1000)
    assert run(spark, tmp_path, once) == [("a", 1)]
    time.sleep(1.5)
    put(spark, f"{tmp_path}/in", [("a", 2)])
    assert run(spark, tmp_path, once) == [("a", 1), ("a", 2)]


def test_newest_versions(spark, tmp_path):
    newest = lambda rows: keyed.newest_per_key(rows, ["key"], "n")
    put(spark, f"{tmp_path}/in", [("a", 1), ("a", 3), ("b", 1), ("b", None)])
    assert run(spark, tmp_path, newest) == [("a", 3), ("b", 1)]
    put(spark, f"{tmp_path}/in", [("a", 2), ("b", 2)])
    assert run(spark, tmp_path, newest) == [("a", 3), ("b", 1), ("b", 2)]


def test_dedupe_within_the_watermark(spark, tmp_path):
    put(spark, f"{tmp_path}/in", [("a", 10), ("a", 20), ("b", 30)])
    got = run(spark, tmp_path, lambda rows: incremental.dedupe_stream(rows, ["key"], "at", "1 hour"))
    assert [k for k, _ in got] == ["a", "b"]
