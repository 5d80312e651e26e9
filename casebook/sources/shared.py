"""Folders that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the one that spark.checkpoint.dir names. Where none is named, a local session has one of its own;
    on a cluster that is an error, since executors share no local folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="casebook-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/{uuid.uuid4().hex}"


def stored(df: DataFrame, path: str | None = None) -> DataFrame:
    """The rows written as Parquet in the shared folder and read again: what is used more than once is made once, and a lost
    executor loses none of it."""
    path = path or shared_dir(df.sparkSession)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def removed(spark: SparkSession, path: str) -> None:
    """Delete a folder that no result reads any more."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def spread(rows: DataFrame, *keys: str | Column, least: int = 0) -> DataFrame:
    """The rows dealt out by `keys` to more tasks than there are cores (and `least` of them), for passes whose work outweighs
    their bytes: a file of one row group would else be one task."""
    spark = rows.sparkSession
    return rows.repartition(max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")), least), *keys)


#: Rows that a task sorts or aggregates of a large table.
TASK_ROWS = 250_000


def dealt(rows: DataFrame, size: int, *keys: str | Column) -> DataFrame:
    """Rows of a table of about `size`, dealt out by `keys` to tasks of some TASK_ROWS each; left as they are where Spark's own
    number of partitions is enough. So a task's memory doesn't grow with the table."""
    parts = -(-size // TASK_ROWS)
    return rows.repartition(parts, *keys) if parts > int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")) else rows
