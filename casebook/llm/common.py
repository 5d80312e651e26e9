"""Helpers that the training-data operators share."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch, whichever is reached first; one very long text is a batch of its own size.
ARROW_ROWS, ARROW_BYTES = 1000, 4 << 20
#: Bytes of batches after which a worker gives back the memory that they left free.
TRIM = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(names: list[str]) -> str:
    """A prefix for further columns, with which none of the names begins."""
    prefix = "__"
    while any(x.startswith(prefix) for x in names):
        prefix += "_"
    return prefix


def quoted(names: list[str]) -> list[Column]:
    """Columns by their names as they are, dots and backticks included."""
    return [F.col("`" + x.replace("`", "``") + "`") for x in names]


class Memo(dict):
    """What was made of words before, bounded by bytes: where a script has no blanks, a word may be a whole text."""

    def __init__(self, most: int):
        super().__init__()
        self.most, self.bytes = most, 0

    def keep(self, key, value, size: int):
        """size: bytes of the value; the key's and some 200 of the entry are added."""
        self[key] = value
        self.bytes += size + 4 * len(key) + 200
        return value

    def make_room(self) -> None:
        if self.bytes > self.most:
            self.clear()
            self.bytes = 0


def small_batches(spark: SparkSession) -> None:
    """Bound what one Arrow batch holds."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))


def _trim() -> None:
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


_resident: dict = {}


def resident(key: tuple, make: Callable[[], object]):
    """What a worker keeps from task to task: one object, so another operator's is let go."""
    if key not in _resident:
        let_go()
        _resident[key] = make()
    return _resident[key]


def let_go() -> None:
    if _resident:
        _resident.clear()
        _trim()


def tidy(run: Callable[[Iterator], Iterator], holds: bool = False) -> Callable[[Iterator], Iterator]:
    """`run` for mapInArrow; the worker, which is used again, gives back free memory now and then and at a task's end.
    Unless `run` holds a resident object, what an earlier operator left there goes first."""

    def out(batches: Iterator) -> Iterator:
        if not holds:
            let_go()

        def each() -> Iterator:
            seen = 0
            for batch in batches:
                yield batch
                seen += batch.nbytes
                if seen > TRIM:
                    seen = 0
                    _trim()

        try:
            yield from run(each())
        finally:
            _trim()

    return out


def shared_dir(spark: SparkSession) -> str:
    """A new folder under the shared folder that the cluster names. Where none is named, a local session has one of its
    own; on a cluster that is an error, since executors share no local folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="casebook-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base}/{uuid.uuid4().hex}"


def materialise(df: DataFrame, path: str | None = None) -> DataFrame:
    """Cut the lineage: write the rows as Parquet to the shared folder and read them again.

    Lost executors lose nothing that was written.
    """
    spark = df.sparkSession
    path = path or shared_dir(spark)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that `materialise` wrote and that no result reads any more."""
    for df in tables:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def join_by_size(left: DataFrame, right: DataFrame, on: list[str], how: str, right_rows: int, max_rows: int = 500_000) -> DataFrame:
    """Broadcast `right` only when its counted rows are within the bound; beyond it, shuffle (and let AQE split skew)."""
    return left.join(F.broadcast(right) if right_rows <= max_rows else right, on, how)
