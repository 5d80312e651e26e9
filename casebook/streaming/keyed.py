"""Keyed state for streams: each unit or body once, and the newest version of each key.

State is kept a key in RocksDB, so a batch touches its own keys alone, whatever came before, and a restart goes on from the
checkpoint: a batch that fails is run again with the state that it began with, and its units stay pending until then. With a
time to live, keys that were quiet for so long are forgotten, which bounds the state; without one they are kept for good.

Rows with a null key are one key's rows. Of rows of one batch the first in the order given counts (all columns, if none is).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StructField, StructType

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class First(StatefulProcessor):
    """Gives the first row of a key, once."""

    def __init__(self, order: list[str], ttl_ms: int | None):
        self.order, self.ttl_ms = order, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", StructType([StructField("n", LongType())]), self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        known, first = self.seen.exists(), None
        for pdf in rows:
            if not known:
                pdf = pdf if first is None else pd.concat([first, pdf])  # noqa: PLW2901
                first = pdf.sort_values(self.order, kind="stable", na_position="last").head(1)
        if first is not None:
            self.seen.update((1,))
            yield first

    def close(self) -> None:
        pass


class Newest(StatefulProcessor):
    """Gives a key's row whenever it is newer, by a whole number, than what was given before."""

    def __init__(self, version: str, ttl_ms: int | None):
        self.version, self.ttl_ms = version, ttl_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.last = handle.getValueState("last", StructType([StructField("version", LongType())]), self.ttl_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        last, top = (self.last.get()[0] if self.last.exists() else None), None
        for pdf in rows:
            best = pdf.dropna(subset=[self.version]).nlargest(1, self.version)
            if len(best) and (top is None or best[self.version].iloc[0] > top[self.version].iloc[0]):
                top = best
        if top is not None and (last is None or top[self.version].iloc[0] > last):
            self.last.update((int(top[self.version].iloc[0]),))
            yield top

    def close(self) -> None:
        pass


def _stateful(rows: DataFrame, key: list[str], processor: StatefulProcessor, ttl_ms: int | None) -> DataFrame:
    rows.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return rows.groupBy(*key).transformWithStateInPandas(processor, rows.schema, "Append", "ProcessingTime" if ttl_ms else "None")


def once_per_key(rows: DataFrame, key: list[str], order: list[str] | None = None, ttl_ms: int | None = None) -> DataFrame:
    """The stream's rows, the first of each key alone."""
    return _stateful(rows, key, First(order or rows.columns, ttl_ms), ttl_ms)


def first_bodies(snapshots: DataFrame, ttl_ms: int | None = None) -> DataFrame:
    """Snapshots with a new body: the first retrieved of each hash, however late its copies come (within the time to live)."""
    return once_per_key(snapshots, ["sha256"], ["retrieved_at", "url"], ttl_ms)


def newest_per_key(rows: DataFrame, key: list[str], version: str, ttl_ms: int | None = None) -> DataFrame:
    """Rows that are newer than all that came before of their key; a batch gives a key once. Null versions are passed over."""
    return _stateful(rows, key, Newest(version, ttl_ms), ttl_ms)


def written_once(rows: DataFrame, table: str, checkpoint: str):
    """A run over what is there now, appended to a Parquet table: files of a batch count once it is whole."""
    return rows.writeStream.format("parquet").option("path", table).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def read_files(spark: SparkSession, path: str, schema, files: int = 1000) -> DataFrame:
    """A stream of the Parquet files of a folder, or of a pattern of paths, so many a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)
