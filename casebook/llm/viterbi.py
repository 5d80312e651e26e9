"""SentencePiece vocabularies: streaming Viterbi encoding, and decoding.

The best segmentation has the greatest sum of piece scores; a character that no piece covers is spelt in byte pieces.
The encoder holds only the places from which a piece may still run on (at most the longest piece's length) and the
backpointers since the last commit. Once the window is as long as the longest piece, it looks after each character
whether the paths of all these places meet in one boundary; if so, the ids up to it are final. Equal sums go to the
shorter last piece.

Texts are cut where convergence is certain: before a run of blanks (no piece has a blank after another character) and
around line ends that no piece contains. Cuts are encoded once per worker and memo, those of a group of texts in order: a
cut shorter than the longest piece goes on from where it first differs from the one before it.

Null text counts as empty and has no ids. Blanks, line ends and U+2581 come back exactly. Repeated rows are encoded
each; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from itertools import chain, filterfalse

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casebook.llm.common import Memo, resident, small_batches, tidy

BLANK = "▁"
#: Bytes of remembered cuts.
MEMO = 80 << 20
#: Characters of the texts whose new cuts are encoded together.
AT_ONCE = 1 << 20
OUT = "doc_id long, n_ids long, n_byte_ids long, ids_crc32 long, decoded_sha256 string, round_trip boolean"


class Vocabulary:
    """Pieces with blanks as blanks, as a trie; byte pieces."""

    def __init__(self, pieces: list[tuple[str, float]], bytes_: dict[int, int], size: int):
        self.ids = {p: (i, s) for i, (p, s) in enumerate(pieces) if p}
        self.trie: dict[str, list] = {}  # by character: what follows, the id of the piece that ends here or -1, its score
        for p, (i, score) in self.ids.items():
            node = self.trie
            for ch in p[:-1]:
                node = node.setdefault(ch, [{}, -1, 0.0])[0]
            node.setdefault(p[-1], [{}, -1, 0.0])[1:] = i, score
        self.longest = max(map(len, self.ids), default=0)
        self.bytes, self.size = bytes_, size
        self.byte_of = {i: b for b, i in bytes_.items()}
        self.byte_cost = min((s for _, s in self.ids.values()), default=0.0) - 10
        self.text = {i: p.encode() for p, (i, _) in self.ids.items()} | {i: bytes([b]) for b, i in bytes_.items()}

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        plain = lambda i: not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))
        pieces = [(sp.id_to_piece(i).replace(BLANK, " ") if plain(i) else "", sp.get_score(i)) for i in range(n)]
        return cls(pieces, {int(sp.id_to_piece(i)[1:-1], 16): i for i in range(n) if sp.is_byte(i)}, n)


class StreamingEncoder:
    """Feed characters; ids come out as soon as they are final."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.restart()

    def restart(self) -> None:
        self.best: list[float] = [0.0]  # of each boundary since the last commit
        self.back: list[tuple[int, int | str]] = [(0, "")]  # the boundary before, and a piece's id or a character to spell
        self.live: list[tuple[int, dict]] = [(0, self.v.trie)]  # boundaries from which a piece may still run on, last first
        self.widest = 0

    @property
    def held(self) -> list[tuple[int, int | str]]:
        """Backpointers of the characters since the last commit."""
        return self.back[1:]

    def _path(self, boundary: int) -> list[int]:
        parts = []
        while boundary:
            boundary, part = self.back[boundary]
            parts.append(part)
        out = []
        for part in reversed(parts):
            if isinstance(part, str):
                out += [self.v.bytes[b] for b in part.encode()]
            else:
                out.append(part)
        return out

    def _commit(self) -> list[int]:
        """If all live paths meet, the ids up to the boundary where they do."""
        paths = {x for x, _ in self.live}
        while len(paths) > 1:
            last = max(paths)
            paths.remove(last)
            paths.add(self.back[last][0])
        at = paths.pop()
        if not at:
            return []
        ids = self._path(at)
        self.best = self.best[at:]
        self.back = [(0, ""), *((b - at, i) for b, i in self.back[at + 1 :])]
        self.live = [(x - at, node) for x, node in self.live]
        return ids

    def feed(self, text: str) -> list[int]:
        out: list[int] = []
        root, cost, longest = self.v.trie, self.v.byte_cost, self.v.longest
        best, back, live, widest = self.best, self.back, self.live, self.widest
        for ch in text:
            end = len(best)
            score, step = best[-1] + (cost if ch < "\x80" else cost * len(ch.encode())), (end - 1, ch)
            ahead = [(end, root)]
            for start, node in live:  # shortest piece first
                hit = node.get(ch)
                if hit is not None:
                    follow, i, own = hit
                    if follow:
                        ahead.append((start, follow))
                    if i >= 0 and (total := best[start] + own) > score:
                        score, step = total, (start, i)
            best.append(score)
            back.append(step)
            live = ahead
            if end - live[-1][0] > widest:
                widest = end - live[-1][0]
            if end >= longest:
                self.live = live
                if ids := self._commit():
                    out += ids
                    best, back, live = self.best, self.back, self.live
        self.live, self.widest = live, widest
        return out

    def finish(self) -> list[int]:
        ids = self._path(len(self.best) - 1)
        self.restart()
        return ids

    def in_order(self, cuts: list[str]) -> Iterator[list[int]]:
        """Ids of each of several sorted cuts, as by `feed` and `finish`. Places are kept for the characters that a cut has in
        common with the one before it; longer ones are fed, so what is held stays as small."""
        root, cost, longest, spelt = self.v.trie, self.v.byte_cost, self.v.longest, self.v.bytes
        best, back, lives, last = [0.0], [(0, "")], [[(0, root)]], ""
        for cut in cuts:
            if len(cut) >= longest:
                yield self.feed(cut) + self.finish()
                continue
            end, most = 0, min(len(cut), len(last))
            while end < most and cut[end] == last[end]:
                end += 1
            del best[end + 1 :], back[end + 1 :], lives[end + 1 :]
            live, last = lives[end], cut
            for ch in cut[end:]:
                score, step = best[end] + (cost if ch < "\x80" else cost * len(ch.encode())), (end, ch)
                end += 1
                ahead = [(end, root)]
                for start, node in live:  # shortest piece first
                    hit = node.get(ch)
                    if hit is not None:
                        follow, i, own = hit
                        if follow:
                            ahead.append((start, follow))
                        if i >= 0 and (total := best[start] + own) > score:
                            score, step = total, (start, i)
                best.append(score)
                back.append(step)
                lives.append(ahead)
                live = ahead
            ids = []
            while end:
                end, part = back[end]
                if part.__class__ is str:
                    ids += [spelt[b] for b in reversed(part.encode())]
                else:
                    ids.append(part)
            yield ids[::-1]


class Codec:
    """Whole texts to ids and back, with the memo of cuts."""

    def __init__(self, vocabulary: Vocabulary):
        self.v, self.encoder, self.memo = vocabulary, StreamingEncoder(vocabulary), Memo(MEMO)
        inner = any(" " in p.lstrip(" ") for p in vocabulary.ids)
        lines = any("\n" in p for p in vocabulary.ids)
        self.cut = (lambda x: [x]) if inner else re.compile(" +[^ ]*|[^ ]+" if lines else " +[^ \n]*|\n|[^ \n]+").findall

    @classmethod
    def of(cls, path: str) -> Codec:
        """One per worker process, from task to task."""
        return resident(("viterbi", path), lambda: cls(Vocabulary.load(path)))

    def encode(self, text: str | None) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of each text. Texts go in groups of AT_ONCE characters; a longer text is a group of its own."""
        groups = np.cumsum([len(x or "") for x in texts]) // AT_ONCE
        bounds = [0, *(np.flatnonzero(np.diff(groups)) + 1).tolist(), len(texts)]
        return list(chain.from_iterable(self._encode(texts[a:b]) for a, b in zip(bounds[:-1], bounds[1:], strict=True)))

    def _encode(self, texts: list[str | None]) -> list[np.ndarray]:
        self.memo.make_room()
        memo, parts = self.memo, [self.cut(" " + x) if x else [] for x in texts]
        new = sorted(set(filterfalse(memo.__contains__, chain.from_iterable(parts))))
        for p, ids in zip(new, self.encoder.in_order(new), strict=True):
            memo.keep(p, np.array(ids, "<u4").tobytes(), 4 * len(ids))
        return [np.frombuffer(b"".join(map(memo.__getitem__, x)), "<u4") for x in parts]

    def decode(self, ids) -> str:
        return b"".join(map(self.v.text.__getitem__, ids)).decode()[1:]


def digest(docs: DataFrame, model: str) -> DataFrame:
    """Encode every whole text, decode it again: OUT."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(model)
        is_byte = np.zeros(codec.v.size, bool)
        is_byte[list(codec.v.byte_of)] = True
        for batch in batches:
            out = []
            texts = batch.column(1).to_pylist()
            for text, ids in zip(texts, codec.encode_all(texts), strict=True):
                back = codec.decode(ids.tolist())
                out.append((len(ids), int(is_byte[ids].sum()), zlib.crc32(ids.data), hashlib.sha256(back.encode()).hexdigest(), back == (text or "")))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_()]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [[]] * 5, kinds, strict=True))], names=[x.split()[0] for x in OUT.split(", ")])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run, holds=True), OUT)


def encode(docs: DataFrame, model: str) -> DataFrame:
    """doc_id, ids (array of int) of every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.astype(np.int32) for x in codec.encode_all(batch.column(1).to_pylist())], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(tidy(run, holds=True), "doc_id long, ids array<int>")


def decode(rows: DataFrame, model: str) -> DataFrame:
    """doc_id, text of rows of ids; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec.of(model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([None if x is None else codec.decode(x) for x in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    small_batches(rows.sparkSession)
    return rows.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(tidy(run, holds=True), "doc_id long, text string")
