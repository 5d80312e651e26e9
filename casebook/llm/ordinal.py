"""Quality classifier: ordinal cumulative-link regression on graded ratings over hashed text features.

P(grade <= k) = sigmoid(threshold_k - score): one weight vector for all grades, ordered thresholds. A document's
features are those present in its distinct words (the word, its first 4, 5 and 6 letters, the marks after it) and
banded shares of repeated neighbours, distinct words, marks and capitals; hashed to 30 bits. Weights are fitted on a
bounded sample of labelled documents (SAMPLE, the first by a hash of doc_id) and kept for features in at least LEAST
sampled documents. Every document is scored whole.

Grades: 0 toxic, 1 of low quality, 2 good. Null text counts as empty. Labels of null or unknown documents are ignored;
a document with several labels takes its worst grade; without usable labels (or with one grade only) all documents get
the prior. Repeated rows are scored each; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import Memo, fresh, quoted, small_batches, tidy

GRADES = 3
SAMPLE, LEAST, BITS = 8000, 8, 30
RIDGE, ROUNDS, CUT = 3e-2, 100, 0.6
#: Bytes of remembered words.
MEMO = 80 << 20
TOKEN = re.compile(r"^([\W_]*)(.*?)([\W_]*)$", re.S)
OUT = "doc_id long, expected_grade double, tail_prob double, grade int, kept boolean"


def hashed(feature: str) -> int:
    return xxhash.xxh32_intdigest(feature) >> 32 - BITS


class Features:
    """Features of texts as sorted arrays of hashes; words are remembered."""

    def __init__(self):
        self.memo = Memo(MEMO)

    def word(self, token: str) -> bytes:
        _, core, tail = TOKEN.match(token).groups()
        core = core.lower()
        names = {"w" + core, *(f"{n}{core[:n]}" for n in (4, 5, 6) if len(core) >= n), "t" + (tail if core else token)[:4]}
        return np.array([hashed(x) for x in names], "<u4").tobytes()

    def of(self, text: str | None) -> np.ndarray:
        words = (text or "").split()
        self.memo.make_room()
        memo, kinds = self.memo, set(words)
        for w in kinds:
            if w not in memo:
                memo.keep(w, made := self.word(w), len(made))
        n = max(1, len(words))
        marks = sum(text.count(c) for c in "#*$%&|<>!") if text else 0
        shares = {
            "adjacent": sum(map(str.__eq__, words, words[1:])) / n, "distinct": len(kinds) / n if n < 200 else min(1.0, len(kinds) / n * (n / 200) ** 0.5),
            "marks": min(1.0, marks / n), "capitals": sum(map(str.isupper, words)) / n,
        }
        bands = [hashed(f"b{k}{i}") for k, x in shares.items() for i in range(int(20 * x) + 1)]
        return np.unique(np.frombuffer(b"".join([memo[w] for w in kinds]) + np.array(bands, "<u4").tobytes(), "<u4"))


@dataclass
class Model:
    keys: np.ndarray  # sorted hashes
    weights: np.ndarray
    thresholds: np.ndarray  # ascending

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        """Of each grade."""
        score = 0.0
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, features), len(self.keys) - 1)
            score = float(self.weights[at[self.keys[at] == features]].sum())
        below = 1 / (1 + np.exp(np.clip(score - self.thresholds, -60, 60)))
        return np.diff(np.concatenate([[0.0], below, [1.0]]))


def fit(rows: list[tuple[np.ndarray, int]], grades: int = GRADES) -> Model:
    """Full-batch Adam on the ridged likelihood; the order of thresholds holds by exponential steps."""
    y = np.array([g for _, g in rows], np.int64)
    prior = (np.cumsum(np.bincount(y, minlength=grades))[:-1] + 0.5) / (len(y) + 1.0)
    theta = np.maximum.accumulate(np.log(prior / (1 - prior)) + 1e-6 * np.arange(grades - 1))
    empty = Model(np.zeros(0, np.uint32), np.zeros(0), theta)
    if len(np.unique(y)) < 2:
        return empty
    every = np.concatenate([f for f, _ in rows])
    keys, n = np.unique(every, return_counts=True)
    keys = keys[n >= LEAST]
    if not len(keys):
        return empty
    at = np.minimum(np.searchsorted(keys, every), len(keys) - 1)
    doc = np.repeat(np.arange(len(rows)), [len(f) for f, _ in rows])
    hit = keys[at] == every
    col, doc = at[hit], doc[hit]
    del every, at, hit
    x = np.concatenate([np.zeros(len(keys)), theta[:1], np.log(np.maximum(np.diff(theta), 1e-3))])
    m, v, k = np.zeros_like(x), np.zeros_like(x), len(keys)
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, ROUNDS + 1):
        gaps = np.exp(x[k + 1 :])
        cuts = np.concatenate([[-1e9], x[k] + np.concatenate([[0.0], np.cumsum(gaps)]), [1e9]])
        score = np.bincount(doc, x[:k][col], len(rows))
        hi, lo = sig(cuts[y + 1] - score), sig(cuts[y] - score)
        p = np.maximum(hi - lo, 1e-12)
        dhi, dlo = hi * (1 - hi) / p, lo * (1 - lo) / p
        g = np.empty_like(x)
        g[:k] = np.bincount(col, ((dhi - dlo) / len(rows))[doc], k) + RIDGE / 10 * x[:k]
        dcut = np.bincount(y, -dhi, grades)[: grades - 1] + np.bincount(y, dlo, grades)[1:]
        dcut = dcut / len(rows)
        g[k] = dcut.sum()
        g[k + 1 :] = [gap * dcut[i + 1 :].sum() for i, gap in enumerate(gaps)]
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        x -= 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Model(keys, x[:k], x[k] + np.concatenate([[0.0], np.cumsum(np.exp(x[k + 1 :]))]))


def grade_of(labels: DataFrame) -> DataFrame:
    """doc_id, grade."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("quality") >= 1, 2)
    return labels.select(F.col("doc_id").cast("long").alias("doc_id"), grade.alias("grade")).where("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.min("grade").alias("grade"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fit on at most `sample` labelled documents; their ids (and later their features) are all that is sent around."""
    small_batches(docs.sparkSession)
    chosen = grade_of(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([features.of(x).tobytes() for x in batch.column(2).to_pylist()], pa.binary())], names=["doc_id", "grade", "features"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(chosen), "doc_id")
    texts = texts.groupBy("doc_id").agg(F.first("grade").alias("grade"), F.min("text").alias("text"))
    rows = texts.select("doc_id", "grade", "text").mapInArrow(tidy(run), "doc_id long, grade int, features binary").toArrow()
    order = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
    found = [(np.frombuffer(rows["features"][i].as_py(), "<u4"), rows["grade"][i].as_py()) for i in order.tolist()]
    return fit(found)


def score(docs: DataFrame, model: Model, keep: list[str] | None = None, cut: float = CUT, prefix: str = "") -> DataFrame:
    """`keep` columns (text among them; doc_id unless named), expected_grade, tail_prob (of the best grade), grade, kept; these prefixed."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast((model.keys, model.weights, model.thresholds))  # bounded by SAMPLE documents' features
    rows = docs.select(*quoted(keep)) if keep else docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("__text"))
    n, at = (len(keep), keep.index("text")) if keep else (1, 1)
    rows = rows.toDF(*(f"c{i}" for i in range(len(rows.columns))))  # mapInArrow takes plain names alone

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, own = Features(), Model(*shared.value)
        for batch in batches:
            p = np.array([own.probabilities(features.of(x)) for x in batch.column(at).to_pylist()]).reshape(batch.num_rows, -1)
            new = [pa.array(p @ np.arange(p.shape[1]) if len(p) else np.zeros(0)), pa.array(p[:, -1] if len(p) else np.zeros(0)), pa.array(p.argmax(1).astype(np.int32) if len(p) else np.zeros(0, np.int32)), pa.array(p[:, -1] >= cut if len(p) else np.zeros(0, bool))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *new], names=[*batch.schema.names[:n], *(prefix + x for x in ("expected_grade", "tail_prob", "grade", "kept"))])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:n])
    out = rows.mapInArrow(tidy(run), f"{kept}, {prefix}expected_grade double, {prefix}tail_prob double, {prefix}grade int, {prefix}kept boolean")
    return out.toDF(*(keep or ["doc_id"]), *out.columns[n:])


def select(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, with their columns."""
    p = fresh(docs.columns)
    return score(docs, train(docs, labels), docs.columns, prefix=p).where(F.col(f"{p}kept")).select(*quoted(docs.columns))
