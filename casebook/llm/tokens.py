"""Exact, memoised encoding with the `tokenizers` library.

The two vocabularies never merge across white space, so a text's ids are its words' ids joined. Each distinct word
is encoded once per worker and memo, by the library's model where its characters leave no doubt about the cuts, else by
the whole library. Texts with unusual white space go to the library whole.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

from casebook.llm.common import resident

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Bytes that each of a worker's two memos, of chunks and of the words within them, may hold. This bounds memory, not
#: results.
MEMO_BYTES = 32 << 20
#: Characters of the texts that are encoded together: arrays of some 40 times as many bytes are held meanwhile.
AT_ONCE = 1 << 20
#: Characters whose cuts are plain: ASCII but for the apostrophe, and precomposed Latin letters whose lower case is one
#: letter too (U+0130 has two).
LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f"
MARKS = "!-&(-/:-@\\[-`{-~"
#: White space other than single blanks and single line ends between words.
UNUSUAL = r"[ \n][ \n]|^[ \n]|[ \n]\z|[\t\x0b-\r\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
ODD_SPACE = re.compile(r"[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
PLAIN = re.compile(f" ?[0-9{LETTERS}{MARKS}]+")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for code points from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return {b: chr(b) if b in shown else chr(next(hidden)) for b in range(256)}


ALPHABET = _byte_letters()


def gather(ids: np.ndarray, at: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Runs of ids, one after another: n from each place."""
    ends = np.cumsum(n)
    return ids[np.repeat(at - ends + n, n) + np.arange(ends[-1] if len(ends) else 0)]


class _Table:
    """Runs of ids by 128-bit hashes: 28 bytes an entry, and two an id."""

    def __init__(self):
        self.high, self.low = np.zeros(0, np.uint64), np.zeros(0, np.uint64)  # in order of the first
        self.at, self.n = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids, self.used = np.zeros(1 << 12, "<u2"), 0

    def size(self) -> int:
        return 28 * len(self.high) + 2 * self.used

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place and length of each hash's run; length -1 for unknown ones."""
        if not len(self.high):
            return np.zeros(len(h), np.int64), np.full(len(h), -1)
        where = np.minimum(np.searchsorted(self.high, h[:, 0]), len(self.high) - 1)
        known = (self.high[where] == h[:, 0]) & (self.low[where] == h[:, 1])
        return self.at[where], np.where(known, self.n[where], -1)

    def add(self, h: np.ndarray, ids: np.ndarray, n: np.ndarray) -> np.ndarray:
        """The places of new runs."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        at = self.used + np.cumsum(n) - n
        self.used += len(ids)
        order = np.argsort(h[:, 0], kind="stable")
        where = np.searchsorted(self.high, h[order, 0])
        self.high, self.low = np.insert(self.high, where, h[order, 0]), np.insert(self.low, where, h[order, 1])
        self.at, self.n = np.insert(self.at, where, at[order]), np.insert(self.n, where, n[order])
        return at


class _Memo:
    """What `make` gives for distinct keys, in two generations of half the bytes each: a full young one becomes the old
    one, whose entries come back when they are asked for. So frequent entries stay and rare ones go."""

    def __init__(self, make, most: int):
        self.make, self.half, self.young, self.old = make, most // 2, _Table(), _Table()

    def __call__(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All keys' ids, and how many each has."""
        h = np.frombuffer(b"".join(map(xxhash.xxh3_128_digest, keys)), "<u8").reshape(-1, 2)
        if self.young.size() > self.half:
            self.young, self.old = _Table(), self.young
        at, n = self.young.find(h)
        absent = np.flatnonzero(n < 0)
        if len(absent):
            old_at, old_n = self.old.find(h[absent])
            back = old_n >= 0
            new = absent[~back]
            ids, sizes = self.make([keys[i] for i in new.tolist()])
            which, sizes = np.concatenate([absent[back], new]), np.concatenate([old_n[back], sizes])
            at[which] = self.young.add(h[which], np.concatenate([gather(self.old.ids, old_at[back], old_n[back]), ids]), sizes)
            n[which] = sizes
        return gather(self.young.ids, at, n), n


class WordIds:
    """Token ids of whole texts, as bytes of little-endian 16-bit ids."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of more than 16 bits")
        self.model = self.tokenizer.model
        self.drops_space = self._ids("a b c") == [i for x in "abc" for i in self._ids(x)]
        digits, blank = ("[0-9]", "") if self.drops_space else (" ?[0-9]+", " ?")
        self.cut = re.compile(f"{blank}[{LETTERS}]+|{digits}|{blank}[{MARKS}]+").findall
        self.words, self.chunks = _Memo(self._words, MEMO_BYTES), _Memo(self._chunks, MEMO_BYTES)
        self.line_end = self._ids("\n")

    @classmethod
    def of(cls, path: str) -> WordIds:
        """One per worker process, from task to task."""
        return resident(("tokens", path), lambda: cls(path))

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _word(self, word: str) -> list[int]:
        """A line end, a chunk (marked by a zero) that the library cuts, or one pre-token for the library's model alone, on
        the byte-level alphabet."""
        if word == "\n":
            return self.line_end
        if word[0] == "\0":
            return self._ids(word[1:])
        if not word.isascii() or " " in word:
            word = word.encode().decode("latin-1").translate(ALPHABET)
        return [x.id for x in self.model.tokenize(word)]

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = list(map(self._word, words))
        n = np.fromiter(map(len, ids), np.int64, len(ids))
        return np.fromiter(chain.from_iterable(ids), "<u2", n.sum()), n

    def _cut(self, chunk: str) -> list[str]:
        """What stands between white space, with what stood before it: a line end, or else a blank (which then belongs to
        it). Unless its characters are plain and the cuts lose none, the library cuts it."""
        line = chunk[0] == "\n"
        if self.drops_space:
            chunk = chunk[1:] if line else chunk
            low = chunk.lower()
        else:
            low = chunk = chunk[1:] if line else " " + chunk
        words = self.cut(low) if PLAIN.fullmatch(chunk) else []
        if sum(map(len, words)) != len(low):
            words = ["\0" + chunk]
        return ["\n", *words] if line and not self.drops_space else words

    def _chunks(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        cuts = list(map(self._cut, chunks))
        place: dict[str, int] = {}
        at = np.array([place.setdefault(w, len(place)) for cut in cuts for w in cut], np.int64)
        ids, n = self.words(list(place))
        begin = np.cumsum(n) - n
        many = np.fromiter(map(len, cuts), np.int64, len(cuts))
        ends = np.concatenate([[0], np.cumsum(n[at])])[np.cumsum(many)]
        return gather(ids, begin[at], n[at]), np.diff(ends, prepend=0)

    def word_ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of words without white space, and how many each has; for vocabularies that drop blanks."""
        odd = [i for i, w in enumerate(words) if ODD_SPACE.search(w)]
        if not odd:
            return self._chunks(words)
        ids, n = self._chunks(["a" if ODD_SPACE.search(w) else w for w in words])
        lists = np.split(ids, np.cumsum(n)[:-1])
        for i in odd:
            lists[i] = np.array(self._ids(words[i]), "<u2")
        return np.concatenate(lists), np.fromiter(map(len, lists), np.int64, len(lists))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Null counts as the empty text. Texts go in groups of AT_ONCE characters; a longer text is a group of its own."""
        ends = np.cumsum([len(x or "") for x in texts]) // AT_ONCE
        cuts = [0, *(np.flatnonzero(np.diff(ends)) + 1).tolist(), len(texts)]
        return list(chain.from_iterable(self._encode(texts[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)))

    def _encode(self, texts: list[str | None]) -> list[bytes]:
        """Arrow finds the distinct chunks of the texts; ids are gathered at once."""
        column = pa.array([x or "" for x in texts], pa.large_string())
        odd = pc.or_(pc.match_substring_regex(column, UNUSUAL), pc.equal(column, "")).to_numpy(zero_copy_only=False)
        out: list[bytes] = [np.array(self._ids(x), "<u2").tobytes() if o and x else b"" for x, o in zip(texts, odd, strict=True)]
        plain = np.flatnonzero(~odd)
        if not len(plain):
            return out
        lists = pc.split_pattern(pa.array(["\n" + texts[i].replace("\n", " \n") for i in plain.tolist()], pa.large_string()), " ")
        chunks = pc.dictionary_encode(lists.flatten())
        distinct = pc.binary_join(pa.ListArray.from_arrays([0, len(chunks.dictionary)], chunks.dictionary.cast(pa.string())), " ")[0].as_py().split(" ")
        ids, sizes = self.chunks(distinct)
        at = chunks.indices.to_numpy()
        n = sizes[at]
        raw = gather(ids, (np.cumsum(sizes) - sizes)[at], n).tobytes()
        bounds = np.concatenate([[0], np.cumsum(n)])[lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist()
        skip = 0 if self.drops_space else len(self.line_end)  # the line end that was put before each text
        for i, a, b in zip(plain.tolist(), bounds[:-1], bounds[1:], strict=True):
            out[i] = raw[2 * (a + skip) : 2 * b]
        return out
