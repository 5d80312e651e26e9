"""Token files: patched frame-of-reference blocks.

A shard file holds whole documents in ascending doc_id order: a header, a table of documents, an index of block
starts, then blocks of 512 ids. A block has the ids less their minimum, packed at the bit width that the 90th
percentile of its ids needs; ids that need more bits stand in its exception list. Each file is the `file` cell of a
Parquet row, so that any store that Spark reaches can hold it and a lost executor leaves no half file behind.

Documents with null text are empty (only the end id). Null doc_ids come first. Equal doc_ids are ordered by text, so
repeated rows are kept, each with its own place. An empty table gives no shard. Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.common import materialise, small_batches, tidy
from casebook.llm.tokens import WordIds

BLOCK, PERCENTILE = 512, 90
SHARD_IDS, SHARD_DOCS = 1 << 20, 1 << 16
HEAD = struct.Struct("<4sHHIQI")
SHARD = "part int, seq long, before long, n_docs long, n_ids long, file binary"
OUT = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _bits(x: np.ndarray) -> np.ndarray:
    return np.ceil(np.log2(x.astype(np.float64) + 1)).astype(np.int64)


def encode_blocks(ids: np.ndarray) -> tuple[np.ndarray, bytes]:
    """Starts of the blocks, and the blocks."""
    n = len(ids)
    nb = -(-n // BLOCK)
    if not nb:
        return np.zeros(0, "<u4"), b""
    full = np.full(nb * BLOCK, ids[-1], np.uint32)
    full[:n] = ids
    full = full.reshape(nb, BLOCK)
    low = full.min(1)
    rest = full - low[:, None]
    width = _bits(np.percentile(rest, PERCENTILE, axis=1, method="higher"))
    over = rest >= (np.uint64(1) << width.astype(np.uint64))[:, None]
    packed: list[bytes] = [b""] * nb
    for w in np.unique(width):
        if w:
            rows = np.flatnonzero(width == w)
            for at in range(0, len(rows), 256):
                some = rows[at : at + 256]
                raw = np.unpackbits(np.ascontiguousarray(rest[some], "<u4").view(np.uint8).reshape(len(some), BLOCK, 4), axis=2, bitorder="little")[:, :, :w]
                for r, line in zip(some, np.packbits(raw.reshape(len(some), -1), axis=1, bitorder="little"), strict=True):
                    packed[r] = line.tobytes()
    out, starts, at = [], np.zeros(nb, "<u4"), 0
    for i in range(nb):
        where = np.flatnonzero(over[i]).astype("<u2")
        block = struct.pack("<IBH", int(low[i]), int(width[i]), len(where)) + packed[i] + where.tobytes() + rest[i][where].astype("<u4").tobytes()
        starts[i] = at
        at += len(block)
        out.append(block)
    return starts, b"".join(out)


def decode_blocks(n: int, starts: np.ndarray, blob: bytes) -> np.ndarray:
    nb = len(starts)
    heads = [struct.unpack_from("<IBH", blob, int(s)) for s in starts]
    out = np.zeros((nb, BLOCK), np.uint32)
    width = np.array([h[1] for h in heads], np.int64)
    for w in np.unique(width):
        if w:
            rows, size = np.flatnonzero(width == w), int(w) * BLOCK // 8
            for at in range(0, len(rows), 256):
                some = rows[at : at + 256]
                raw = np.frombuffer(b"".join(blob[(s := int(starts[r]) + 7) : s + size] for r in some), np.uint8).reshape(len(some), size)
                bits = np.zeros((len(some), BLOCK, 32), np.uint8)
                bits[:, :, :w] = np.unpackbits(raw, axis=1, bitorder="little").reshape(len(some), BLOCK, w)
                out[some] = np.packbits(bits, axis=2, bitorder="little").view("<u4")[:, :, 0]
    for i, (low, w, n_over) in enumerate(heads):
        if n_over:
            at = int(starts[i]) + 7 + int(w) * BLOCK // 8
            where = np.frombuffer(blob, "<u2", n_over, at)
            out[i, where] = np.frombuffer(blob, "<u4", n_over, at + 2 * n_over)
        out[i] += np.uint32(low)
    return out.reshape(-1)[:n]


def write_shard(doc_ids: list[int | None], docs: list[np.ndarray]) -> bytes:
    ids = np.concatenate(docs) if docs else np.zeros(0, np.uint32)
    starts, blob = encode_blocks(ids)
    return b"".join([
        HEAD.pack(b"PFOR", 1, BLOCK, len(docs), len(ids), len(starts)),
        np.array([x or 0 for x in doc_ids], "<i8").tobytes(), np.array([x is not None for x in doc_ids], np.uint8).tobytes(),
        np.array([len(x) for x in docs], "<u4").tobytes(), starts.tobytes(), blob,
    ])


def read_shard(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """doc_ids, which of them aren't null, ids of each document, all ids."""
    magic, version, block, n_docs, n_ids, nb = HEAD.unpack_from(data)
    if (magic, version, block) != (b"PFOR", 1, BLOCK):
        raise ValueError("not a token file")
    at = HEAD.size
    doc_ids = np.frombuffer(data, "<i8", n_docs, at)
    valid = np.frombuffer(data, np.uint8, n_docs, at := at + 8 * n_docs)
    sizes = np.frombuffer(data, "<u4", n_docs, at := at + n_docs)
    starts = np.frombuffer(data, "<u4", nb, at := at + 4 * n_docs)
    return doc_ids, valid, sizes, decode_blocks(n_ids, starts, data[at + 4 * nb :])


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int = 2, path: str | None = None) -> DataFrame:
    """Encode every text and write the shards, in ascending doc_id order over (part, seq). Returns them as read back.

    One shuffle: texts are ranged by doc_id, then encoded and packed in one pass; no id is shuffled.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, seq, before = TaskContext.get().partitionId(), 0, 0
        words, keys, held, n = WordIds.of(tokenizer), [], [], 0

        def shard() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *(pa.array([x], pa.int64()) for x in (seq, before, len(keys), n)), pa.array([write_shard(keys, held)], pa.binary())], names=["part", "seq", "before", "n_docs", "n_ids", "file"])

        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), words.encode(batch.column(1).to_pylist()), strict=True):
                ids = np.empty(len(raw) // 2 + 1, np.uint32)
                ids[:-1] = np.frombuffer(raw, "<u2")
                ids[-1] = end_id
                if keys and (n + len(ids) > SHARD_IDS or len(keys) >= SHARD_DOCS):
                    yield shard()
                    seq, before, keys, held, n = seq + 1, before + n, [], [], 0
                keys.append(key)
                held.append(ids)
                n += len(ids)
        if keys:
            yield shard()

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(F.col("doc_id").asc_nulls_first())
    return materialise(rows.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.col("text").asc_nulls_first()).mapInArrow(tidy(pack, holds=True), SHARD), path)


def read_tokens(shards: DataFrame) -> DataFrame:
    """Per document from the files: doc_id, start (ids before it), n_tokens, ids_crc32.

    What is broadcast has one row of 16 bytes for each writing task, whatever the number of documents.
    """

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for base, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                doc_ids, valid, sizes, ids = read_shard(data.as_py())
                ends = np.cumsum(sizes, dtype=np.int64)
                crc = [zlib.crc32(ids[e - s : e].astype("<u4").data) for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, mask=valid == 0), pa.array(base + ends - sizes), pa.array(sizes.astype(np.int64)), pa.array(crc, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    small_batches(shards.sparkSession)
    parts = shards.groupBy("part").agg(F.max(F.col("before") + F.col("n_ids")).alias("n"))
    bases = parts.select("part", (F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, 0)) - F.col("n")).alias("base"))
    return shards.join(F.broadcast(bases), "part").select((F.col("base") + F.col("before")).alias("base"), "file").mapInArrow(tidy(unpack), OUT)
