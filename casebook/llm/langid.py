"""Language ID: script ranges narrow candidates, then Viterbi over per-word scores labels spans.

A word's script, by code point ranges, admits the languages that training saw in that script. Each admitted language
scores the word by smoothed log-probabilities of its hashed n-grams of 1 to 4 letters and of the word itself. The best
path through the words pays a penalty for each change of language; its runs are the spans. The document takes the
language with most letters.

Trained on a bounded sample: hashes of doc_ids fall into narrow levels, and for each language the finest levels that
together hold at most PER_LANG rows are taken, whole texts (a doc_id of more rows than that is never sampled, nor what
falls in coarser levels). Null text, or text without letters, is `und` with score 0; without training rows everything
is. Words in scripts that training never saw tell no language from another. Repeated rows are labelled each; null
doc_ids are never trained on; other columns are ignored; an empty table gives no row. A very long text is labelled whole.
Equal letters, and equal paths, go to the language that sorts first.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import Memo, fresh, quoted, small_batches, tidy

#: Letters, and the marks that combine with the letter before them (vowel signs of many scripts).
MARKS = "".join(c for c in map(chr, range(0x110000)) if unicodedata.category(c) in ("Mn", "Mc"))
WORD = re.compile(rf"[^\W\d_]+(?:[{MARKS}]+[^\W\d_]*)*")
#: The same where there are no marks, all of which are beyond FAR.
SHORT, FAR = re.compile(r"[^\W\d_]+"), re.compile("[\u0300-\U0010ffff]")
#: First code points of scripts (fixed values of the Unicode blocks), in order.
STARTS = [(0x0, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"), (0x900, "devanagari"), (0x980, "bengali"), (0xA00, "indic"), (0xB80, "tamil"), (0xC00, "indic"), (0xE00, "thai"), (0xE80, "other"), (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, "other"), (0x2C60, "latin"), (0x2C80, "other"), (0x3040, "kana"), (0x3100, "other"), (0x3400, "han"), (0xA000, "other"), (0xA720, "latin"), (0xA800, "other"), (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "latin"), (0xFB50, "arabic"), (0xFE00, "other"), (0xFF21, "latin"), (0xFF66, "kana"), (0xFFA0, "other"), (0x20000, "han"), (0x32000, "other")]
POINTS, SCRIPTS = [a for a, _ in STARTS], [b for _, b in STARTS]
PER_LANG, BUCKETS = 1000, 1 << 16
#: A table of BUCKETS by languages is held by the driver and each worker; more languages than that are an error.
MOST_LANGS = 256
#: In nats: a change of language costs SWITCH; a word's score is shared out over its dependent n-grams.
SWITCH, SHARE, NOT_ADMITTED, SEEN = 10.0, 0.25, -30.0, 0.001
#: Bytes of remembered words and their scores.
MEMO = 128 << 20
#: Levels of hashes, a halving; texts labelled together; odd multipliers of the hashes.
LEVELS, TOGETHER = 16, 100
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


def word_pattern(text: str) -> re.Pattern:
    return WORD if not text.isascii() and FAR.search(text) else SHORT


def words_of(text: str | None) -> list[str]:
    """Words in lower case."""
    return list(map(str.lower, word_pattern(text).findall(text))) if text else []


def script_of(word: str) -> str:
    return SCRIPTS[bisect_right(POINTS, ord(word[len(word) // 2])) - 1]


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the n-grams of 1 to 4 letters (ends marked) and of each whole word, and the places of their words."""
    codes = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le"), "<u4").astype(np.uint64)
    size = np.fromiter(map(len, words), np.int64, len(words)) + 2
    end = np.cumsum(size)
    word = np.repeat(np.arange(len(words)), size)
    at = np.arange(len(codes))
    left = end[word] - at
    hashes, places = [], []
    for n in (1, 2, 3, 4):
        h = np.full(len(codes) - n + 1, n, np.uint64)
        for k in range(n):
            h = (h ^ codes[k : len(codes) - n + 1 + k]) * M1
        inside = left[: len(h)] >= n
        hashes.append(h[inside])
        places.append(word[: len(h)][inside])
    powers = np.cumprod(np.full(size.max(), M2))
    hashes.append(np.add.reduceat(codes * powers[at - (end - size)[word]], end - size))
    places.append(np.arange(len(words)))
    h = np.concatenate(hashes)
    h = (h ^ h >> np.uint64(32)) * M2
    return (h >> np.uint64(48)).astype(np.int64), np.concatenate(places)


@dataclass
class Model:
    langs: list[str]
    table: np.ndarray  # BUCKETS x langs, log-probabilities
    admitted: dict[str, np.ndarray]  # script: 0 or NOT_ADMITTED for each language


class Labeller:
    def __init__(self, model: Model):
        self.m, self.at, self.rows = model, Memo(MEMO), np.zeros((1024, len(model.langs)), np.float64)

    def _learn(self, words: list[str]) -> None:
        """Score new words."""
        first, langs = len(self.at), len(self.m.langs)
        for i, w in enumerate(words, first):
            self.at.keep(w, i, 8 * langs)
        while len(self.at) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        bucket, place = grams(words)
        s = SHARE * np.stack([np.bincount(place, self.m.table[bucket, k], len(words)) for k in range(langs)], 1)
        everywhere = np.zeros(langs)
        s += np.array([self.m.admitted.get(script_of(w), everywhere) for w in words])
        self.rows[first : first + len(words)] = s - s.max(1, keepdims=True)

    def path(self, s: np.ndarray) -> np.ndarray:
        """The best language of each word. One language throughout is best if even the best language of every word, with no
        price for changes, gains no more than one change costs; else Viterbi decides."""
        best = int(s.sum(0).argmax())
        if s.max(1).sum() - s[:, best].sum() <= SWITCH:
            return np.full(len(s), best)
        value, back = s[0].tolist(), []
        for row in s[1:].tolist():
            top = max(value)
            lead, low = value.index(top), top - SWITCH
            back.append([k if v >= low else lead for k, v in enumerate(value)])
            value = [(v if v >= low else low) + r for v, r in zip(value, row, strict=True)]
        at = value.index(max(value))
        out = [at]
        for line in reversed(back):
            at = line[at]
            out.append(at)
        return np.array(out[::-1])

    def label_all(self, texts: list[str | None], spans: bool = False) -> Iterator[tuple[str, float, list[tuple[int, int, str]]]]:
        """Language, score from 0 to 1 (its share of letters times its posterior), and spans by code points, of each text."""
        for i in range(0, len(texts), TOGETHER):
            some = texts[i : i + TOGETHER]
            words = [words_of(x) for x in some]
            self.at.make_room()
            if self.m.langs and (new := list({w for line in words for w in line if w not in self.at})):
                self._learn(new)
            for text, hits in zip(some, words, strict=True):
                yield self._label(text, hits, spans)

    def label(self, text: str | None, spans: bool = False) -> tuple[str, float, list[tuple[int, int, str]]]:
        return next(self.label_all([text], spans))

    def _label(self, text: str | None, hits: list[str], spans: bool) -> tuple[str, float, list[tuple[int, int, str]]]:
        if not self.m.langs or not any(c.isalpha() for w in hits for c in w):
            return "und", 0.0, []
        s = self.rows[list(map(self.at.__getitem__, hits))]
        path = self.path(s)
        letters = np.bincount(path, [len(w) for w in hits], len(self.m.langs))
        lang = int(letters.argmax())
        total = s.sum(0)
        posterior = 1 / np.exp(np.minimum(60.0, total - total[lang])).sum()
        out = []
        if spans:
            places = [x.span() for x in word_pattern(text).finditer(text)]
            cuts = [0, *(np.flatnonzero(np.diff(path)) + 1).tolist(), len(path)]
            out = [(places[a][0], places[b - 1][1], self.m.langs[path[a]]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        return self.m.langs[lang], float(letters[lang] / letters.sum() * posterior), out


def training_rows(docs: DataFrame) -> DataFrame:
    """What may be learnt from: a language, and a crc32 of doc_id whose remainder by 4 isn't 2."""
    return docs.where(F.col("lang").isNotNull() & (F.crc32(F.col("doc_id").cast("string")) % 4 != 2))


def level() -> Column:
    """Of a row by a hash of its doc_id: each LEVELS levels hold half the ids of the LEVELS before."""
    return F.floor(-LEVELS * F.log2((F.xxhash64("doc_id").bitwiseAND((1 << 53) - 1) + 1) / float(1 << 53))).cast("int")


def finest_levels(rows: list[tuple[str, int, int]], most: int) -> dict[str, int]:
    """For each language of (language, level, rows), the coarsest level down to which at most `most` rows lie."""
    out, whole = {}, defaultdict(int)
    for lang, at, n in sorted(rows, key=lambda r: -r[1]):
        whole[lang] += n
        out.setdefault(lang, at + 1)
        if whole[lang] <= most:
            out[lang] = at
    return out


def train(docs: DataFrame, per_lang: int = PER_LANG) -> Model:
    """Counts are summed on the executors; what comes to the driver is bounded: a row for each of the 850 levels of at most
    MOST_LANGS languages, then BUCKETS times MOST_LANGS counts. The sample is a filter on the scan, so nothing is ranked.
    """
    small_batches(docs.sparkSession)
    known = training_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "text")).where("doc_id is not null")
    most = [r.lang for r in known.select("lang").distinct().limit(MOST_LANGS + 1).collect()]
    if len(most) > MOST_LANGS:
        raise ValueError(f"more than {MOST_LANGS} labelled languages")
    if not most:
        return Model([], np.zeros((BUCKETS, 0), np.float32), {})
    levels = known.where(F.col("lang").isin(most)).groupBy("lang", level().alias("level")).agg(F.count("*").alias("n")).collect()
    least = finest_levels([tuple(r) for r in levels], per_lang)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count: dict[str, np.ndarray] = {}
        scripts: dict[tuple[str, str], int] = {}
        for batch in batches:
            seen: dict[str, Counter] = defaultdict(Counter)
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                seen[lang].update(words_of(text))
            for lang, words in seen.items():
                mine = count.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for word, n in words.items():
                    key = (lang, script_of(word))
                    scripts[key] = scripts.get(key, 0) + n
                if words:
                    bucket, place = grams(list(words))
                    mine += np.bincount(bucket, np.fromiter(words.values(), np.int64, len(words))[place], BUCKETS).astype(np.int64)
        for lang, mine in count.items():
            hit = np.flatnonzero(mine)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(hit), pa.string()), pa.array([""] * len(hit)), pa.array(hit.astype(np.int32)), pa.array(mine[hit])], names=["lang", "script", "bucket", "n"])
        if scripts:
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in scripts]), pa.array([k[1] for k in scripts]), pa.array([-1] * len(scripts), pa.int32()), pa.array(list(scripts.values()), pa.int64())], names=["lang", "script", "bucket", "n"])

    sampled = F.lit(False)
    for lang, at in least.items():
        sampled = sampled | ((F.col("lang") == lang) & (level() >= at))
    sums = known.where(sampled).select("lang", "text").mapInArrow(tidy(run), "lang string, script string, bucket int, n long").groupBy("lang", "script", "bucket").agg(F.sum("n").alias("n"))
    rows = sums.toArrow().to_pandas()
    langs = sorted(rows[rows.bucket < 0].lang.unique())
    place = {k: i for i, k in enumerate(langs)}
    table = np.zeros((BUCKETS, len(langs)))
    grams_ = rows[rows.bucket >= 0]
    table[grams_.bucket.to_numpy(int), [place[x] for x in grams_.lang]] = grams_.n
    total = table.sum(0)
    table = np.log((table + 0.5) / (total + 0.5 * BUCKETS)) if len(langs) else table
    admitted = {}
    for script, part in rows[rows.bucket < 0].groupby("script"):
        line = np.full(len(langs), NOT_ADMITTED)
        for lang, n in zip(part.lang, part.n, strict=True):
            whole = rows[(rows.bucket < 0) & (rows.lang == lang)].n.sum()
            line[place[lang]] = 0.0 if n >= SEEN * whole else NOT_ADMITTED
        if (line == 0).any():
            admitted[script] = line
    return Model(langs, table.astype(np.float32), admitted)


def label(docs: DataFrame, model: Model, keep: list[str] | None = None, spans: bool = False, prefix: str = "") -> DataFrame:
    """`keep` columns (text among them; doc_id unless named), lang_pred, score (prefixed); with spans also an array of (start, end, lang)."""
    spark = docs.sparkSession
    small_batches(spark)
    shared = spark.sparkContext.broadcast((model.langs, model.table, model.admitted))  # BUCKETS x MOST_LANGS at most
    rows = docs.select(*quoted(keep)) if keep else docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("__text"))
    n, at = (len(keep), keep.index("text")) if keep else (1, 1)
    rows = rows.toDF(*(f"c{i}" for i in range(len(rows.columns))))  # mapInArrow takes plain names alone
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = Labeller(Model(*shared.value))
        for batch in batches:
            out = list(labeller.label_all(batch.column(at).to_pylist(), spans))
            new = [pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())]
            if spans:
                new.append(pa.array([[{"start": a, "end": b, "lang": k} for a, b, k in x[2]] for x in out], span))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *new], names=[*batch.schema.names[:n], *(prefix + x for x in ("lang_pred", "score", "spans")[: len(new)])])

    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields[:n])
    out = rows.mapInArrow(tidy(run), f"{kept}, {prefix}lang_pred string, {prefix}score double" + f", {prefix}spans array<struct<start:int,end:int,lang:string>>" * spans)
    return out.toDF(*(keep or ["doc_id"]), *out.columns[n:])


def predict(docs: DataFrame) -> DataFrame:
    """The query: doc_id, held_out (null for a null doc_id), lang_pred, score."""
    out = label(docs, train(docs))
    return out.select("doc_id", (F.crc32(F.col("doc_id").cast("string")) % 4 == 2).alias("held_out"), "lang_pred", "score")


def select(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The documents in one known language, with their columns; `und` and unclear ones go."""
    p = fresh(docs.columns)
    return label(docs, train(docs), docs.columns, prefix=p).where((F.col(f"{p}lang_pred") != "und") & (F.col(f"{p}score") >= least)).select(*quoted(docs.columns))
