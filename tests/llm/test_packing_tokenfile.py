from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from casebook.llm import packing, tokenfile, tokens
from casebook.llm.tokens import WordIds

WORD, BYTE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))
TEXTS = ["", "a", None, "The quick brown fox.\nJumps  over\t\tit \n\n x", " lead", "trail \n", "it's 12345 | a|b || c", "naïve ŒUVRE ﬁ ☃☃", "<|endoftext|> x", "a   b", "x\u00a0y\u2003z\x1cq", "same words again", "same words again", "long " * 30_000]
DOCS = [(i, x, "s") for i, x in enumerate(TEXTS)] + [(None, "no id", "s"), (3, "again id 3", "s")]
SCHEMA = "doc_id long, text string, ids string"  # a clashing name


def ids(path: str, text: str | None) -> list[int]:
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_word_ids_equal_the_library(path):
    assert WordIds(path).encode(TEXTS) == [np.array(ids(path, x), "<u2").tobytes() for x in TEXTS]


@pytest.mark.parametrize("path", [WORD, BYTE])
def test_word_ids_equal_the_library_over_all_of_unicode(path):
    rng = np.random.default_rng(7)
    points = np.array([c for c in range(1, 0x30000) if not 0xD800 <= c < 0xE000])
    each = ["".join(map(chr, points[i : i + 3].tolist())) + " x" + chr(points[i]) + "y" for i in range(0, len(points), 40)]
    latin = ["".join(map(chr, rng.integers(32, 0x250, 60).tolist())) for _ in range(1500)]
    mixed = ["".join(map(chr, rng.choice(points, 12).tolist())) + " ab's" for _ in range(500)]
    texts = ["İstanbul İ I\u0307 ı", *(f"a{chr(c)}b {chr(c)}" for c in range(1, 0x250)), *each, *latin, *mixed]
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    want = [x.ids for x in t.encode_batch(texts, add_special_tokens=False)]
    got = WordIds(path).encode(texts)
    assert [np.frombuffer(x, "<u2").tolist() for x in got] == want


def test_memos_are_bounded_and_do_not_change_ids(monkeypatch):
    monkeypatch.setattr(tokens, "MEMO_BYTES", 1 << 12)
    small, texts = WordIds(BYTE), [f"word{i} same {i * 7}" for i in range(500)]
    for i in range(0, 500, 50):
        assert small.encode(texts[i : i + 50]) == [np.array(ids(BYTE, x), "<u2").tobytes() for x in texts[i : i + 50]]
        assert small.chunks.old.size() < 1 << 13


def test_neighbours_are_those_of_plain_bm25_over_all_terms():
    """Every term of the seed counts, frequent and rare ones; used documents are left out."""
    rng = np.random.default_rng(3)
    docs = [np.append(np.minimum(rng.zipf(1.3, rng.integers(1, 90)), 300), 1).astype("<u2") for _ in range(60)]
    docs += [docs[4].copy(), docs[4].copy(), np.array([1], "<u2"), np.append(np.arange(301, 400), 1).astype("<u2")]
    index, n = packing.Bm25(docs), len(docs)
    size = [len(x) for x in docs]
    mean, sets = sum(size) / n, [set(x.tolist()) for x in docs]
    df = {t: sum(t in s for s in sets) for t in set().union(*sets)}

    def bm25(seed: int, d: int) -> float:
        out = 0.0
        for t in sets[seed] & sets[d]:
            tf = docs[d].tolist().count(t)
            if df[t] > 1:
                out += np.log(1 + (n - df[t] + 0.5) / (df[t] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * size[d] / mean))
        return out

    free = rng.random(n) < 0.8
    for seed in range(n):
        got = index.neighbours(seed, free).tolist()
        want = {d: bm25(seed, d) for d in range(n) if free[d]}
        assert sorted(got) == sorted(d for d, x in want.items() if x > 0)
        scores = [want[d] for d in got]
        assert all(a >= b - 1e-9 for a, b in zip(scores, scores[1:]))


def test_windows_are_filled_greedily_by_a_plain_version():
    """Seeds in order, then the last document's best unused neighbours, cut where the window is full."""
    rng = np.random.default_rng(5)
    docs = [np.append(rng.integers(2, 60, rng.integers(1, 40)), 1).astype("<u2") for _ in range(80)]
    p = packing.Packer(0, 32)
    p.shard(list(range(80)), docs)
    p.close()
    index, free, order, seed = packing.Bm25(docs), np.ones(80, bool), [], None
    used = 0
    while free.any():
        if seed is None:
            seed = int(np.flatnonzero(free)[0])
            free[seed] = False
            order.append(seed)
            ended, used = used + len(docs[seed]) >= 32, (used + len(docs[seed])) % 32
            if ended and not used:
                seed = None
                continue
        last, seed = seed, None
        for d in index.neighbours(last, free).tolist():
            free[d] = False
            order.append(d)
            ended, used = used + len(docs[d]) >= 32, (used + len(docs[d])) % 32
            if ended:
                seed = d if used else None
                break
    assert [x[0] for x in p.out if x[1] == 0] == order
    whole = np.concatenate([docs[d] for d in order])
    pieces = [x for x in p.out if x[5] < len(whole) // 32]
    assert all(x[6] + x[2] <= 32 for x in pieces) and sum(x[2] for x in p.out) == len(whole)


def test_packing(spark):
    rows = packing.pack(spark.createDataFrame(DOCS, SCHEMA), WORD).toPandas()
    want = sorted((k is not None, k or 0, len(ids(WORD, x)) + 1) for k, x, _ in DOCS)
    whole = rows[rows.start == 0]
    assert sorted((k == k, 0 if k != k else int(k), n) for k, n in zip(whole.doc_id, whole.doc_tokens)) == want
    assert rows.length.sum() == sum(n for *_, n in want)
    for _, g in rows.groupby("sequence_id"):
        g = g.sort_values("offset")
        assert g.offset.tolist() == [0, *g.length.cumsum()[:-1]]
        n = g.length.sum()
        assert n <= 2048 and n & (n - 1) == 0
    long = np.array(ids(WORD, TEXTS[-1]) + [1], "<u4")
    g = rows[rows.doc_id == len(TEXTS) - 1].sort_values("start")
    assert g.start.tolist() == [0, *g.length.cumsum()[:-1]]
    assert g.ids_crc32.tolist() == [zlib.crc32(long[s : s + n].tobytes()) for s, n in zip(g.start, g.length)]


def test_packing_brings_copies_together():
    rng = np.random.default_rng(1)
    themes = [rng.integers(1000 * k, 1000 * k + 300, 400).astype("<u2") for k in range(8)]
    docs = [np.where(rng.random(400) < 0.05, rng.integers(0, 9999, 400), themes[i % 8]).astype("<u2") for i in range(64)]
    packer = packing.Packer(0)
    packer.shard(list(range(64)), docs)
    packer.close()
    same = [len({k % 8 for k, *_, s, _ in packer.out if s == q}) for q in {x[5] for x in packer.out}]
    assert np.mean(same) < 2.5


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert packing.pack(empty, WORD).count() == 0
    assert tokenfile.read_tokens(tokenfile.write_tokens(empty, BYTE)).count() == 0


def test_token_files(spark):
    rows = tokenfile.read_tokens(tokenfile.write_tokens(spark.createDataFrame(DOCS, SCHEMA), BYTE)).collect()
    order = sorted(DOCS, key=lambda d: (d[0] is not None, d[0] or 0, d[1] is not None, (d[1] or "").encode()))
    at = 0
    for r, (k, x, _) in zip(sorted(rows, key=lambda r: r.start), order, strict=True):
        want = np.array([*ids(BYTE, x), 2], "<u4")
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (k, at, len(want), zlib.crc32(want.tobytes()))
        at += len(want)


def test_blocks_round_trip():
    rng = np.random.default_rng(0)
    for ids_ in (np.zeros(0, np.uint32), np.full(700, 9, np.uint32), rng.integers(0, 50_000, 5000).astype(np.uint32), np.where(rng.random(3000) < 0.05, 2**32 - 1, 3).astype(np.uint32), np.array([0, 2**32 - 1], np.uint32)):
        starts, blob = tokenfile.encode_blocks(ids_)
        assert tokenfile.decode_blocks(len(ids_), starts, blob).tolist() == ids_.tolist()
    skewed = np.where(rng.random(51_200) < 0.03, 40_000, rng.integers(0, 64, 51_200)).astype(np.uint32)
    assert len(tokenfile.encode_blocks(skewed)[1]) < 1.3 * len(skewed)  # outliers don't widen their block
