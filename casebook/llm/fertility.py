"""Quality rules by tokeniser fertility.

Public vocabularies measure each text, word by word: characters per token, share of byte tokens (byte fallback, or of
byte-level vocabularies single bytes beyond ASCII), entropy of the tokens. Each script has rejection bands for each
vocabulary, fitted to all labelled training rows of good quality: what lies between their TAIL
quantiles, widened by MARGIN of the width, is accepted by a band, and a text is kept if all vocabularies accept it. Rows
whose crc32 of doc_id has the remainder 2 by 4 are held out. Where a script has under LEAST_ROWS of them, the first
vocabulary has BANDS and the others none. Base counts come first: a text that fails them is rejected whatever its
tokens are.

Words are runs of anything but ASCII white space. Null text has none. Repeated rows are judged each; other columns are
ignored; an empty table gives no row.
"""

from __future__ import annotations

import base64
import math
import os.path
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from casebook.llm.common import discard, materialise, resident, small_batches, tidy
from casebook.llm.langid import SCRIPTS, script_of
from casebook.llm.tokens import ALPHABET, AT_ONCE, WordIds, gather

#: Scripts in the order of their names, after none.
KINDS = ["", *sorted({*SCRIPTS, "other"})]
PLACE = {k: i for i, k in enumerate(KINDS)}
LATIN = PLACE["latin"]
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MEMO = 500_000
LEAST_WORDS, MOST_REPEATED = 50, 50
LEAST_ROWS, TAIL, MARGIN = 50, 0.001, 0.05
#: Cells of a unit of a measure, by which values are counted before some are sorted.
CELLS = 4096
COUNTS = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
MEASURES = ("chars_per_token", "byte_share", "token_entropy")


@dataclass(frozen=True)
class Band:
    """What is accepted, ends included."""

    chars_per_token: tuple[float, float]
    byte_share: tuple[float, float]
    token_entropy: tuple[float, float]


#: Chosen by hand for the first vocabulary, wide of what ordinary prose measures. Scripts that aren't named take "other".
BANDS = {
    "latin": Band((1.3, 8.0), (0.0, 0.15), (4.0, 14.0)),
    "han": Band((0.3, 4.0), (0.0, 0.9), (3.0, 14.0)),
    "kana": Band((0.3, 4.0), (0.0, 0.9), (3.0, 14.0)),
    "hangul": Band((0.3, 4.0), (0.0, 0.9), (3.0, 14.0)),
    "other": Band((0.3, 8.0), (0.0, 0.95), (2.5, 14.0)),
}


def name_of(vocabulary: str) -> str:
    return os.path.basename(vocabulary).split(".")[0]


def _script(word: str) -> int:
    """Place of the script of a word's letters; 0 if it has none."""
    if word.isascii():
        return LATIN if word.lower() != word.upper() else 0
    letters = "".join(filter(str.isalpha, word))
    return PLACE[script_of(letters)] if letters else 0


def _flat(ids: list) -> tuple[np.ndarray, np.ndarray]:
    n = np.fromiter(map(len, ids), np.int64, len(ids))
    return np.fromiter(chain.from_iterable(ids), np.uint16, n.sum()), n


class Vocabulary:
    """Tokens of words by a file for sentencepiece (.model), tiktoken or tokenizers (.json): all ids, and each word's number."""

    def __init__(self, path: str):
        if path.endswith(".model"):
            import sentencepiece

            sp = sentencepiece.SentencePieceProcessor(model_file=path)
            self.encode = lambda words: _flat(sp.encode(words, num_threads=1))
            self.is_byte = np.array([sp.is_byte(i) for i in range(sp.get_piece_size())])
        elif path.endswith(".tiktoken"):
            import public_tokenizers
            import tiktoken

            with open(path, "rb") as f:
                ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
            own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
            self.encode = lambda words: _flat(list(map(own.encode_ordinary, words)))
            self.is_byte = np.zeros(max(ranks.values()) + 1, bool)
            self.is_byte[[i for x, i in ranks.items() if len(x) == 1 and x >= b"\x80"]] = True
        else:
            own = WordIds(path)
            library = own.tokenizer
            # Where blanks are dropped a word has the same ids alone as in a text, so its parts' ids can be remembered.
            self.encode = own.word_ids if own.drops_space else lambda words: _flat([x.ids for x in library.encode_batch_fast(words, add_special_tokens=False)])
            self.is_byte = np.zeros(library.get_vocab_size(), bool)
            high = [ALPHABET[x] + end for x in range(128, 256) for end in ("", "</w>")]
            self.is_byte[[i for i in map(library.token_to_id, high) if i is not None]] = True
        if len(self.is_byte) > 1 << 16:
            raise ValueError("ids of more than 16 bits")


class Words:
    """What several vocabularies make of words; each word is encoded once. Words are found by 128-bit hashes."""

    def __init__(self, paths: tuple[str, ...]):
        self.vocabularies = [Vocabulary(p) for p in paths]
        self.clear()

    @classmethod
    def of(cls, paths: tuple[str, ...]) -> Words:
        """One per worker process, from task to task."""
        return resident(("fertility", paths), lambda: cls(paths))

    def clear(self) -> None:
        n = len(self.vocabularies)
        self.high, self.low, self.place = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int32)  # in order of the first
        self.hashes, self.chars, self.scripts = np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(0, np.int8)
        self.begin, self.sizes, self.bytes = ([np.zeros(0, np.int32)] * n for _ in range(3))
        self.tokens, self.used = [np.zeros(1 << 12, np.uint16) for _ in range(n)], [0] * n

    def places(self, words: list[str]) -> np.ndarray:
        """Of distinct words; new ones are learnt. At most MEMO stay between calls."""
        if len(self.high) > MEMO:
            self.clear()
        h = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, words)), "<u8").reshape(-1, 2)
        at = np.searchsorted(self.high, h[:, 0])
        near = np.minimum(at, max(0, len(self.high) - 1))
        known = (self.high[near] == h[:, 0]) & (self.low[near] == h[:, 1]) if len(self.high) else np.zeros(len(h), bool)
        out = np.empty(len(h), np.int32)
        out[known] = self.place[near[known]]
        new = np.flatnonzero(~known)
        if len(new):
            out[new] = np.arange(len(self.chars), len(self.chars) + len(new))
            order = new[np.argsort(h[new, 0], kind="stable")]
            self._learn([words[i] for i in new.tolist()], h[new, 1])
            where = at[order]
            self.high, self.low, self.place = np.insert(self.high, where, h[order, 0]), np.insert(self.low, where, h[order, 1]), np.insert(self.place, where, out[order])
        return out

    def _learn(self, words: list[str], hashes: np.ndarray) -> None:
        self.hashes = np.concatenate([self.hashes, hashes])
        self.chars = np.concatenate([self.chars, np.fromiter(map(len, words), np.int32, len(words))])
        self.scripts = np.concatenate([self.scripts, np.fromiter(map(_script, words), np.int8, len(words))])
        for k, v in enumerate(self.vocabularies):
            flat, n = v.encode(words)
            ends = np.cumsum(n)
            while self.used[k] + len(flat) > len(self.tokens[k]):
                self.tokens[k] = np.concatenate([self.tokens[k], np.zeros_like(self.tokens[k])])
            self.tokens[k][self.used[k] : self.used[k] + len(flat)] = flat
            self.begin[k] = np.concatenate([self.begin[k], (self.used[k] + ends - n).astype(np.int32)])
            self.used[k] += len(flat)
            self.sizes[k] = np.concatenate([self.sizes[k], n.astype(np.int32)])
            high = np.concatenate([[0], np.cumsum(v.is_byte[flat])])
            self.bytes[k] = np.concatenate([self.bytes[k], (high[ends] - high[ends - n]).astype(np.int32)])


def entropies(docs: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Bits a token of each of `count` documents; docs are those of the ids, both below 65,536."""
    key = np.sort(docs.astype(np.uint32) << np.uint32(16) | ids)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    n = np.diff(np.append(starts, len(key))).astype(np.float64)
    doc = (key[starts] >> np.uint32(16)).astype(np.int64)
    total = np.bincount(doc, n, count)
    spread = np.bincount(doc, n * np.log2(n), count)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.maximum(0.0, np.where(total > 0, np.log2(total) - spread / total, 0.0))


def repeated_words(h: np.ndarray, doc: np.ndarray, count: int, window: int = 3) -> np.ndarray:
    """Of each document, words in windows that it has twice or more. Windows are compared by 64-bit hashes of hashes."""
    n = len(h) - window + 1
    if n < 2:
        return np.zeros(count, np.int64)
    mix = np.uint64(0x9E3779B97F4A7C15)
    key = (doc[:n].astype(np.uint64) + np.uint64(1)) * mix
    for i in range(window):
        key = (key ^ key >> np.uint64(29)) * mix + h[i : i + n]
    inside = doc[:n] == doc[window - 1 :]
    found = np.sort(key[inside])
    again = np.unique(found[1:][found[1:] == found[:-1]])
    covered = np.zeros(len(h), bool)
    if len(again):
        low = np.zeros(1 << 16, bool)  # most keys aren't found twice, which their last bits tell
        low[again & np.uint64(0xFFFF)] = True
        maybe = np.flatnonzero(inside & low[key & np.uint64(0xFFFF)])
        at = np.minimum(np.searchsorted(again, key[maybe]), len(again) - 1)
        twice = maybe[again[at] == key[maybe]]
        for i in range(window):
            covered[twice + i] = True
    return np.bincount(doc[covered], minlength=count)


def duplicate_lines(text: str) -> int:
    seen, n = set(), 0
    for line in text.split("\n"):
        if line in seen:
            n += 1
        elif line.strip(SPACES):
            seen.add(line)
    return n


def measure(docs: DataFrame, vocabulary: str | list[str], bands: dict[tuple[str, str], Band] | None = None) -> DataFrame:
    """One row a document: COUNTS, MEASURES of the first vocabulary, script, and MEASURES of the others with their names.
    `bands` are by vocabulary's name and script."""
    paths = (vocabulary,) if isinstance(vocabulary, str) else tuple(vocabulary)
    names, bands = [name_of(p) for p in paths], bands or {}
    others = [f"{x}_{name}" for name in names[1:] for x in MEASURES]
    schema = ", ".join([COUNTS, *(f"{x} double" for x in MEASURES), "script string", *(f"{x} double" for x in others)])

    def group(words: Words, texts: list[str]) -> list[pa.Array]:
        lists = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))
        flat, ends = lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
        some = pc.greater(pc.binary_length(flat), 0)
        d, doc = len(texts), np.repeat(np.arange(len(texts)), np.diff(ends))[some.to_numpy(zero_copy_only=False)]
        found = pc.dictionary_encode(flat.filter(some))
        w = words.places(found.dictionary.to_pylist())[found.indices.to_numpy()]
        n, chars = np.bincount(doc, minlength=d), np.bincount(doc, words.chars[w], d).astype(np.int64)
        repeats = repeated_words(words.hashes[w], doc, d)
        failed = (n < LEAST_WORDS) | (100 * repeats > MOST_REPEATED * n)
        seen = np.bincount(doc * len(KINDS) + words.scripts[w], minlength=d * len(KINDS)).reshape(d, -1)[:, 1:]
        script = np.where(seen.any(1), np.array(KINDS[1:])[seen.argmax(1)], "other")
        measures, good = [], ~failed
        for k, name in enumerate(names):
            sizes = words.sizes[k][w]
            total = np.bincount(doc, sizes, d)
            one = np.maximum(total, 1)
            own = [np.where(total > 0, chars / one, 0.0), np.bincount(doc, words.bytes[k][w], d) / one, entropies(np.repeat(doc, sizes), gather(words.tokens[k], words.begin[k][w], sizes), d)]
            measures.append(own)
            for kind in np.unique(script).tolist():
                b = bands.get((name, kind)) or (None if k else BANDS.get(kind, BANDS["other"]))
                if b is not None:
                    inside = np.logical_and.reduce([(lo <= x) & (x <= hi) for x, (lo, hi) in zip(own, (b.chars_per_token, b.byte_share, b.token_entropy), strict=True)])
                    good &= inside | (script != kind)
        counts = [n, chars, np.array([sum(map(x.count, SYMBOLS)) for x in texts], np.int64), np.array(list(map(duplicate_lines, texts)), np.int64), repeats]
        return [*(pa.array(x.astype(np.int64)) for x in counts), pa.array(failed), pa.array(good), *map(pa.array, measures[0]), pa.array(script.tolist(), pa.string()), *map(pa.array, chain.from_iterable(measures[1:]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words.of(paths)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            ends = np.cumsum([len(x) for x in texts]) // AT_ONCE
            cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(texts)]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if a < b:
                    yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], *group(words, texts[a:b])], names=[x.split()[0] for x in schema.split(", ")])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run, holds=True), schema)


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % 4 == 2


def quantiles(rows: DataFrame, columns: list[str], at: tuple[float, ...]) -> dict[tuple[str, str], tuple[float, ...]]:
    """Exact quantiles by (script, column) of scripts with LEAST_ROWS or more, between ranks as `percentile` has them.

    Values are counted by cells first; only the cells that hold a wanted rank are sorted, so no task holds a column.
    """
    many = {r["script"]: r["n"] for r in rows.groupBy("script").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= LEAST_ROWS).collect()}
    if not many:
        return {}
    places = {script: [q * (n - 1) for q in at] for script, n in many.items()}
    ranks = [(script, rank) for script, own in places.items() for rank in sorted({f(x) for x in own for f in (math.floor, math.ceil)})]
    wanted = F.broadcast(rows.sparkSession.createDataFrame(ranks, "script string, rank long"))
    each = rows.where(F.col("script").isin(*many)).select("script", F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns)))).withColumn("cell", F.floor(F.col("value") * CELLS))
    upto = F.sum("n").over(Window.partitionBy("script", "column").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0))
    cells = each.groupBy("script", "column", "cell").agg(F.count(F.lit(1)).alias("n")).withColumn("upto", upto)
    held = cells.join(wanted, "script").where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))).groupBy("script", "column", "cell", (F.col("upto") - F.col("n")).alias("before")).agg(F.collect_list("rank").alias("ranks"))
    own = F.row_number().over(Window.partitionBy("script", "column", "cell").orderBy("value")) - 1
    found = each.join(F.broadcast(held), ["script", "column", "cell"]).withColumn("rank", F.col("before") + own).where(F.array_contains("ranks", F.col("rank")))
    values = {(r["script"], r["column"], r["rank"]): r["value"] for r in found.select("script", "column", "rank", "value").collect()}

    def between(script: str, column: str, place: float) -> float:
        lo, hi = math.floor(place), math.ceil(place)
        low, high = values[script, column, lo], values[script, column, hi]
        return low if lo == hi or low == high else (hi - place) * low + (place - lo) * high

    return {(script, c): tuple(between(script, c, x) for x in places[script]) for script in many for c in columns}


def fitted(measured: DataFrame, labels: DataFrame, vocabularies: list[str]) -> dict[tuple[str, str], Band]:
    """Bands by vocabulary's name and script, of all labelled training rows of `measure` that are good and not toxic."""
    good = labels.where((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).select(F.col("doc_id").cast("long").alias("doc_id")).where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).distinct()
    columns = {(name_of(v), x): x if k == 0 else f"{x}_{name_of(v)}" for k, v in enumerate(vocabularies) for x in MEASURES}
    ends = quantiles(measured.where("not base_failed").join(good, "doc_id"), list(columns.values()), (TAIL, 1 - TAIL))

    def wide(lo: float, hi: float) -> tuple[float, float]:
        return lo - MARGIN * (hi - lo), hi + MARGIN * (hi - lo)

    return {(name, script): Band(*(wide(*ends[script, columns[name, x]]) for x in MEASURES)) for script in sorted({k for k, _ in ends}) for name in map(name_of, vocabularies)}


def fit(docs: DataFrame, labels: DataFrame, vocabularies: list[str]) -> dict[tuple[str, str], Band]:
    """`fitted` for documents that haven't been measured."""
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    measured = materialise(measure(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi"), vocabularies))
    bands = fitted(measured, labels, vocabularies)
    discard(measured)
    return bands


def judged(measured: DataFrame, vocabularies: list[str], bands: dict[tuple[str, str], Band]) -> DataFrame:
    """Rows of `measure` with the verdicts that `measure` gives with these bands; no text is read again."""
    good = ~F.col("base_failed")
    for k, v in enumerate(vocabularies):
        name = name_of(v)
        own = {script: bands.get((name, script)) or (None if k else BANDS.get(script, BANDS["other"])) for script in KINDS[1:]}
        for script, b in own.items():
            if b is not None:
                inside = [F.col(x if k == 0 else f"{x}_{name}").between(*ends) for x, ends in zip(MEASURES, (b.chars_per_token, b.byte_share, b.token_entropy), strict=True)]
                good &= (F.col("script") != script) | (inside[0] & inside[1] & inside[2])
    return measured.withColumn("kept", good)


def measure_and_judge(docs: DataFrame, labels: DataFrame, vocabularies: list[str]) -> DataFrame:
    """Every document measured once, bands fitted to all labelled training rows of them, then judged."""
    measured = materialise(measure(docs, vocabularies))
    return judged(measured, vocabularies, fitted(measured, labels, vocabularies))
