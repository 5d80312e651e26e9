"""The source `casebook`: exchange folders of snapshots, JSON lines of documents and edges, and checkpoints.

    register(spark)
    spark.read.format("casebook").option("kind", "exchange").option("adapter", "pdpc").load(root)
    rows.write.format("casebook").option("kind", "exchange").mode("append").save(root)
    spark.readStream.format("casebook").option("kind", "documents").load(folder)

Kinds: `exchange` (`<adapter>/aa/bb/<sha256>.json` and `.bin`; a partition for each folder `aa`), `documents` and `refs` (a
partition a file; a bad line is an error that names path:line), `checkpoint` (torn and invalid lines are left out). Files
are opened where they are read, by the file system that the path names (local, or one that Arrow knows), so the paths must
be there for all executors. A missing path is empty.

Streams take files by time of change: an offset is the latest time seen with the names that had it, so files of one instant
are neither lost nor read twice; a file that is put in later with an older time of change isn't seen. A body without its
manifest, or a manifest without its body, isn't there yet.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, DataSourceWriter, InputPartition, WriterCommitMessage
from pyspark.sql.types import DataType, DateType, StructType, TimestampType

from casebook.schema import CHECKPOINT, DOCUMENT, REF

SNAPSHOT = "sha256 string, url string, retrieved_at timestamp, status int, params string, headers map<string,string>, adapter string, bytes long, body binary"
KINDS = {"exchange": SNAPSHOT, "documents": DOCUMENT, "refs": REF, "checkpoint": CHECKPOINT}


def _fs(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _files(path: str, suffixes: tuple[str, ...]) -> list:
    """Files below a path, or the path if it is one."""
    from pyarrow import fs

    system, place = _fs(path)
    info = system.get_file_info(place)
    if info.type == fs.FileType.NotFound:
        return []
    found = [info] if info.type == fs.FileType.File else system.get_file_info(fs.FileSelector(place, recursive=True))
    return sorted((x for x in found if x.type == fs.FileType.File and (x is info or x.path.endswith(suffixes))), key=lambda x: x.path)


def _read(path: str, name: str) -> bytes:
    with _fs(path)[0].open_input_stream(name) as f:
        return f.read()


def typed(value: object, kind: DataType) -> object:
    """A JSON value as a column's: dates and times from text, structures by their fields; ValueError if it isn't one."""
    if value is None:
        return None
    if isinstance(kind, StructType):
        if not isinstance(value, dict):
            raise ValueError(f"not an object: {value!r}")
        return tuple(typed(value.get(f.name), f.dataType) for f in kind)
    if isinstance(kind, TimestampType):
        return datetime.fromisoformat(value)
    if isinstance(kind, DateType):
        return date.fromisoformat(value)
    if kind.typeName() == "string":
        return value if isinstance(value, str) else json.dumps(value, ensure_ascii=False)
    return value


def lines(path: str, name: str, schema: StructType, strict: bool) -> Iterator[tuple]:
    """Rows of a file of JSON lines; a bad one is an error or, unless strict, left out."""
    for at, line in enumerate(_read(path, name).split(b"\n"), 1):
        if not line.strip():
            continue
        try:
            row = typed(json.loads(line), schema)
        except (ValueError, TypeError) as e:
            if strict:
                raise ValueError(f"{name}:{at}: {e}") from e
            continue
        if strict or row[0] is not None:
            yield row


@dataclass
class Names(InputPartition):
    """Files that a task reads: of an exchange folder the manifests."""

    names: list[str]


class Reader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.schema, self.kind, self.path = schema, options["kind"], options.get("path", "")
        if self.kind not in KINDS:
            raise ValueError(f"kind must be one of {', '.join(KINDS)}")
        self.root = f"{self.path.rstrip('/')}/{options['adapter']}" if self.kind == "exchange" and "adapter" in options else self.path

    def found(self) -> list:
        suffixes = (".json", ".bin") if self.kind == "exchange" else (".jsonl", ".json")
        return [x for x in _files(self.root, suffixes) if not x.base_name.startswith((".", "_"))]

    def parts(self, files: list) -> list[Names]:
        if self.kind != "exchange":
            return [Names([x.path]) for x in files]
        bodies, by = {x.path for x in files if x.path.endswith(".bin")}, {}
        for x in files:
            if x.path.endswith(".json") and f"{x.path[:-5]}.bin" in bodies:
                by.setdefault(x.path.rsplit("/", 2)[0], []).append(x.path)  # <adapter>/aa
        return [Names(v) for _, v in sorted(by.items())]

    def partitions(self) -> list[Names]:
        return self.parts(self.found())

    def read(self, partition: Names | None) -> Iterator[tuple]:
        for name in partition.names if partition else []:  # without files Spark still starts a task
            if self.kind == "exchange":
                yield (*typed(json.loads(_read(self.path, name)), StructType(self.schema.fields[:-1])), _read(self.path, f"{name[:-5]}.bin"))
            else:
                yield from lines(self.path, name, self.schema, self.kind != "checkpoint")


class Stream(Reader, DataSourceStreamReader):
    def initialOffset(self) -> dict:  # noqa: N802
        return {"at": -1, "names": []}

    def _complete(self) -> list:
        """Each unit with the time at which it is whole: that of the later file."""
        files = self.found()
        if self.kind != "exchange":
            return [(x.mtime_ns, x.path, [x]) for x in files]
        pair: dict[str, list] = {}
        for x in files:
            pair.setdefault(x.path.rpartition(".")[0], []).append(x)
        return [(max(x.mtime_ns for x in two), name, two) for name, two in pair.items() if len(two) == 2]

    def latestOffset(self) -> dict:  # noqa: N802
        units = self._complete()
        at = max((x[0] for x in units), default=-1)
        return {"at": at, "names": sorted(name for when, name, _ in units if when == at)}

    def partitions(self, start: dict, end: dict) -> list[Names]:  # type: ignore[override]
        after = lambda when, name, o: when > o["at"] or (when == o["at"] and name not in o["names"])
        new = [files for when, name, files in self._complete() if after(when, name, start) and not after(when, name, end)]
        return self.parts([x for files in new for x in files])

    def commit(self, end: dict) -> None:
        pass


@dataclass
class Written(WriterCommitMessage):
    new: int


class Writer(DataSourceWriter):
    """Content-addressed: a body that is there stays as it is. Files get their names once they are whole."""

    def __init__(self, schema: StructType, options: dict):
        if options["kind"] != "exchange":
            raise ValueError("only exchange folders are written; JSON lines are Spark's own")
        self.names, self.path = [f.name for f in schema], options["path"].rstrip("/")

    def write(self, rows: Iterator) -> Written:
        from pyarrow import fs
        from pyspark import TaskContext

        system, root = _fs(self.path)
        new, own = 0, f"part{TaskContext.get().taskAttemptId()}"
        for row in rows:
            x = dict(zip(self.names, row, strict=True))
            body = bytes(x.pop("body"))
            sha = hashlib.sha256(body).hexdigest()
            place = f"{root}/{x.get('adapter') or 'unknown'}/{sha[:2]}/{sha[2:4]}"
            if system.get_file_info(f"{place}/{sha}.json").type == fs.FileType.File:
                continue
            system.create_dir(place, recursive=True)
            facts = x | {"sha256": sha, "bytes": len(body), "retrieved_at": x["retrieved_at"].isoformat() if x.get("retrieved_at") else None}
            for suffix, data in ((".bin", body), (".json", json.dumps(facts, default=dict).encode())):
                with system.open_output_stream(f"{place}/.{own}{suffix}") as f:
                    f.write(data)
                system.move(f"{place}/.{own}{suffix}", f"{place}/{sha}{suffix}")
            new += 1
        return Written(new)

    def commit(self, messages: list) -> None:
        pass

    def abort(self, messages: list) -> None:
        pass


class CorpusSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "casebook"

    def schema(self) -> str:
        return KINDS[self.options.get("kind", "documents")]

    def _options(self) -> dict:
        return {"kind": "documents"} | dict(self.options)

    def reader(self, schema: StructType) -> Reader:
        return Reader(schema, self._options())

    def streamReader(self, schema: StructType) -> Stream:  # noqa: N802
        return Stream(schema, self._options())

    def writer(self, schema: StructType, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("snapshots are only added")
        return Writer(schema, self._options())


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CorpusSource)
