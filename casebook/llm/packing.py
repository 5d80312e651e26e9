"""Lexical retrieval packing: sharded BM25 indexes return unused neighbours of a seed, which fill its window.

1. Every text is encoded once; the ids are written with a min-hash signature.
2. Documents are ranged by signature, so that lexically close ones come to one partition; doc_id splits hot
   signatures, so copies never pile up in one task.
3. Each partition is read in index shards of about a million ids. A shard's BM25 index answers each seed with its
   unused neighbours by all of the seed's terms, best first; they fill the window, and the last one is cut where the window is full. What is left
   of it seeds the next window. A partition's last, unfilled window is cut into powers of two, so nothing is padded.

Null text counts as empty (the end id alone). Repeated rows are packed each; null doc_ids stay null. Equal scores go by
place in the shard. An empty table gives no piece. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import materialise, small_batches, tidy
from casebook.llm.tokens import WordIds, gather

WINDOW = 2048
K1, B = 1.2, 0.75
#: Ids and documents of an index shard; memory of a task is bounded by them and by the longest document.
SHARD_IDS, SHARD_DOCS = 1 << 20, 4096
#: Terms in over this share of a shard's documents have rows of weights instead of postings: at most SHARD_IDS / COMMON
#: numbers.
COMMON = 0.25
OUT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


def signature(ids: np.ndarray) -> int:
    """31 bits of min-hash over the ids, then 32 over pairs of neighbours."""
    if len(ids) < 2:
        return int(ids[0]) if len(ids) else 0
    x = ids.astype(np.uint64)
    one = (np.unique(x) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
    two = ((x[:-1] * np.uint64(65537) + x[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(32)
    return int(one.min()) << 32 | int(two.min())


class Bm25:
    """Inverted index of one shard: postings by term, with each posting's BM25 weight; common terms have dense rows."""

    def __init__(self, docs: list[np.ndarray]):
        n = self.n = len(docs)
        sizes = np.array([len(x) for x in docs], np.int64)
        keys, tf = np.unique(np.repeat(np.arange(n), sizes) << 16 | np.concatenate(docs).astype(np.int64), return_counts=True)
        doc, term = keys >> 16, keys & 0xFFFF
        df = np.bincount(term, minlength=1 << 16)
        idf = np.log1p((n - df + 0.5) / (df + 0.5))
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[doc] / max(1.0, sizes.mean())))
        shared = df[term] > 1
        doc, term, weight = doc[shared], term[shared], weight[shared]
        self.first, self.term = np.searchsorted(doc, np.arange(n + 1)), term
        common = np.flatnonzero(df > max(2, COMMON * n))
        self.row = np.full(1 << 16, -1)
        self.row[common] = np.arange(len(common))
        dense = self.row[term] >= 0
        self.rows = np.zeros((len(common), n))
        self.rows[self.row[term[dense]], doc[dense]] = weight[dense]
        doc, term, weight = doc[~dense], term[~dense], weight[~dense]
        order = np.argsort(term, kind="stable")
        self.post_doc, self.post_weight = doc[order], weight[order]
        self.at = np.searchsorted(term[order], np.arange((1 << 16) + 1))

    def neighbours(self, seed: int, free: np.ndarray) -> np.ndarray:
        """Free documents that share a term with the seed, best first. All of the seed's terms are asked for."""
        terms = self.term[self.first[seed] : self.first[seed + 1]]
        row = self.row[terms]
        score = self.rows[row[row >= 0]].sum(0)
        rare = terms[row < 0]
        begin, n = self.at[rare], self.at[rare + 1] - self.at[rare]
        if len(rare):
            score += np.bincount(gather(self.post_doc, begin, n), gather(self.post_weight, begin, n), self.n)
        hit = np.flatnonzero(free & (score > 0))
        return hit[np.argsort(-score[hit], kind="stable")]


class Packer:
    """Windows of one partition; an open window lives on from shard to shard."""

    def __init__(self, first_sequence: int, window: int = WINDOW):
        self.sequence, self.window, self.used = first_sequence, window, 0
        self.open: list[tuple] = []
        self.out: list[tuple] = []

    def add(self, key: int | None, ids: np.ndarray) -> bool:
        """Put all of a document in; True if it ended a window and goes on in (or ends with) the next."""
        start, cut = 0, False
        while start < len(ids):
            n = min(len(ids) - start, self.window - self.used)
            self.open.append((key, start, n, zlib.crc32(ids[start : start + n].astype("<u4").data), len(ids), self.sequence, self.used, ids))
            start, self.used = start + n, self.used + n
            if self.used == self.window:
                self.out += [x[:7] for x in self.open]
                self.open, self.used, self.sequence, cut = [], 0, self.sequence + 1, True
        return cut

    def shard(self, keys: list[int | None], docs: list[np.ndarray]) -> None:
        index, free, following = Bm25(docs), np.ones(len(docs), bool), 0
        seed = None
        while True:
            if seed is None:
                while following < len(docs) and not free[following]:
                    following += 1
                if following == len(docs):
                    return
                seed, free[following] = following, False
                if self.add(keys[seed], docs[seed]) and not self.used:
                    seed = None
                    continue
            last, seed = seed, None
            for d in index.neighbours(last, free).tolist():
                free[d] = False
                if self.add(keys[d], docs[d]):
                    seed = d if self.used else None
                    break

    def close(self) -> None:
        """Cut the last window into powers of two."""
        size, room = [1 << b for b in range(self.window.bit_length(), -1, -1) if self.used >> b & 1], 0
        at = -1
        for key, start, n, _, total, _, _, ids in self.open:
            end = start + n
            while start < end:
                if not room:
                    at, self.sequence = at + 1, self.sequence + 1
                    room = size[at]
                n = min(end - start, room)
                self.out.append((key, start, n, zlib.crc32(ids[start : start + n].astype("<u4").data), total, self.sequence, size[at] - room))
                start, room = start + n, room - n
        self.open, self.used = [], 0


def encode(docs: DataFrame, tokenizer: str, end_id: int = 1) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = WordIds.of(tokenizer), np.array([end_id], "<u2").tobytes()
        for batch in batches:
            raw = [x + end for x in words.encode(batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary()), pa.array([signature(np.frombuffer(x, "<u2")) for x in raw], pa.int64())], names=["doc_id", "ids", "signature"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run, holds=True), "doc_id long, ids binary, signature long")


def pack(docs: DataFrame, tokenizer: str, end_id: int = 1, window: int = WINDOW) -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer = Packer(TaskContext.get().partitionId() << 36, window)
        keys, held, n = [], [], 0

        def rows() -> pa.RecordBatch:
            out, packer.out = packer.out, []
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (zip(*out, strict=True) if out else [[]] * 7)], names=NAMES)

        for batch in batches:
            for key, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.frombuffer(raw, "<u2")
                if keys and (n + len(ids) > SHARD_IDS or len(keys) >= SHARD_DOCS):
                    packer.shard(keys, held)
                    keys, held, n = [], [], 0
                    yield rows()
                keys.append(key)
                held.append(ids)
                n += len(ids)
        if keys:
            packer.shard(keys, held)
        packer.close()
        yield rows()

    ids = materialise(encode(docs, tokenizer, end_id))
    ranged = ids.repartitionByRange("signature", "doc_id").sortWithinPartitions("signature", "doc_id")
    return ranged.select("doc_id", "ids").mapInArrow(tidy(run), OUT)
