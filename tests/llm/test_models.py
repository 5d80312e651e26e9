from __future__ import annotations

import hashlib
import itertools
import re
import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from casebook.llm import fertility, langid, ordinal, viterbi
from casebook.llm.common import table

MODEL = public_tokenizers.path("piece_bpe_32k.model")
DATA = "/root/testdata/sf0.01"
TEXTS = ["", None, "a", "  two  blanks ", "line\n\nline\n", "▁ marks ▁▁", "ﬁ ☃ naïve 漢字かな", "x" * 3000, "\t tab", "the internationalisation of things", "same", "same"]


# ---- SentencePiece


def whole_viterbi(v, text):
    """Ids by the plain table over the whole text."""
    text = " " + text
    best, back = [0.0], [None]
    for end in range(1, len(text) + 1):
        raw = tuple(v.bytes[b] for b in text[end - 1].encode())
        score, step = best[end - 1] + v.byte_cost * len(raw), (end - 1, raw)
        for start in range(end - 1, max(0, end - v.longest) - 1, -1):
            if (hit := v.ids.get(text[start:end])) and best[start] + hit[1] > score:
                score, step = best[start] + hit[1], (start, (hit[0],))
        best.append(score)
        back.append(step)
    out, at = [], len(text)
    while at:
        at, ids = back[at]
        out.append(ids)
    return [i for ids in reversed(out) for i in ids], best[-1]


def test_streaming_equals_the_whole_table():
    codec = viterbi.Codec(viterbi.Vocabulary.load(MODEL))
    for text in filter(None, TEXTS):
        want, _ = whole_viterbi(codec.v, text)
        e = viterbi.StreamingEncoder(codec.v)
        early = e.feed(" " + text)
        assert early + e.finish() == want == codec.encode(text).tolist()
        assert codec.decode(want) == text
    e = viterbi.StreamingEncoder(codec.v)
    e.feed(" some words that are long enough to commit " * 50)
    assert len(e.held) <= 2 * codec.v.longest and e.widest <= codec.v.longest


def test_best_of_all_segmentations():
    v = viterbi.Vocabulary([("a", -3.0), ("ab", -4.0), ("b", -2.0), ("ba", -3.5), ("aba", -4.5), (" ", -1.0), (" a", -2.5)], {b: 100 + b for b in range(256)}, 400)
    for text in ("".join(x) for n in range(1, 6) for x in itertools.product("ab c"[:3], repeat=n)):
        full, best = " " + text, -1e9
        for cuts in itertools.product([0, 1], repeat=len(full) - 1):
            parts = "".join(c + "|" * k for c, k in zip(full, (*cuts, 0))).split("|")
            if all(p in v.ids for p in parts):
                best = max(best, sum(v.ids[p][1] for p in parts))
        ids = viterbi.Codec(v).encode(text).tolist()
        score = {i: s for i, s in v.ids.values()}
        assert sum(score[i] for i in ids) == best


def test_cuts_in_order(monkeypatch):
    """Cuts of several texts share what they begin with; ids are those of each cut alone, whatever the groups and the memo."""

    class Counting(dict):
        asked = 0

        def get(self, key):
            Counting.asked += 1
            return super().get(key)

    v = viterbi.Vocabulary.load(MODEL)
    rng = random.Random(6)
    texts = [None, "", *(" ".join("".join(rng.choice("abé\u4e00 \n-") for _ in range(rng.choice([2, 5, 14, 15, 16, 17, 40]))) for _ in range(9)) for _ in range(60))]
    want = [whole_viterbi(v, x)[0] if x else [] for x in texts]
    for most, memo in ((1 << 20, 80 << 20), (50, 80 << 20), (50, 1000)):
        monkeypatch.setattr(viterbi, "AT_ONCE", most)
        monkeypatch.setattr(viterbi, "MEMO", memo)
        codec = viterbi.Codec(v)
        assert [x.tolist() for x in codec.encode_all(texts) + codec.encode_all(texts)] == want + want
    monkeypatch.setattr(viterbi, "AT_ONCE", 1 << 20)
    v.trie = Counting(v.trie)
    words = [f"abcdefgh{i:03d}" for i in range(500)]
    codec = viterbi.Codec(v)
    assert [codec.decode(x.tolist()) for x in codec.encode_all(words[:250] + [" ".join(words[250:])])] == [*words[:250], " ".join(words[250:])]
    assert Counting.asked < 4 * len(words)  # 12 characters each


def test_viterbi_query(spark):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)] + [(None, "same", 1)], "doc_id long, text string, n_ids int")
    rows = viterbi.digest(docs, MODEL).collect()
    v = viterbi.Vocabulary.load(MODEL)
    assert len(rows) == len(TEXTS) + 1 and all(r.round_trip for r in rows)
    for r in rows:
        text = TEXTS[r.doc_id] if r.doc_id is not None else "same"
        ids = whole_viterbi(v, text)[0] if text else []
        assert (r.n_ids, r.ids_crc32, r.decoded_sha256) == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), hashlib.sha256((text or "").encode()).hexdigest())
    back = viterbi.decode(viterbi.encode(docs, MODEL), MODEL)
    assert {r.doc_id: r.text for r in back.collect() if r.doc_id is not None} == {i: t or "" for i, t in enumerate(TEXTS)}
    assert viterbi.digest(docs.limit(0), MODEL).count() == 0


# ---- Quality rules


def brute_counts(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, g in enumerate(grams) if grams.count(g) > 1 for j in range(i, i + 3)}
    lines = text.split("\n")
    dup = sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) and x in lines[:i] for i, x in enumerate(lines))
    n = len(words)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), n < 50 or 100 * len(covered) > 50 * n


def test_fertility(spark):
    texts = ["", None, "a b c a b c a", "x y z\x1c\x0b\n\n \n \nsame\nsame\n same\n#*<>", "word " * 80, " ".join(f"Ordinary{i} prose" for i in range(60)), "漢字 " * 9]
    docs = spark.createDataFrame([(i, t, True) for i, t in enumerate(texts)] + [(None, "a", True)], "doc_id long, text string, kept boolean")
    docs = docs.unionByName(table(spark, "/root/testdata/sf0.001", "documents").limit(60).selectExpr("doc_id + 100 AS doc_id", "text", "true AS kept"))
    text = {r.doc_id: r.text for r in docs.collect()}
    rows = fertility.measure(docs, MODEL).collect()
    assert len(rows) == len(text)
    for r in rows:
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == brute_counts(text[r.doc_id])
        assert not (r.base_failed and r.kept)
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    r = next(r for r in rows if r.doc_id == 5)
    ids = [i for w in texts[5].split() for i in sp.encode(w)]
    p = np.unique(ids, return_counts=True)[1] / len(ids)
    assert r.chars_per_token == pytest.approx(r.word_chars / len(ids)) and r.token_entropy == pytest.approx(-(p * np.log2(p)).sum())
    assert fertility.measure(docs.limit(0), MODEL).count() == 0


def test_fertility_equals_brute_force(spark):
    """Counts, measures, script and verdict of every text by the libraries alone, word by word; repeated rows and a very long text."""
    import base64
    from collections import Counter

    import sentencepiece
    import tiktoken
    from tokenizers import Tokenizer

    paths = [public_tokenizers.path(x) for x in ("piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_multi_50k.tiktoken")]
    sp = sentencepiece.SentencePieceProcessor(model_file=paths[0])
    word = Tokenizer.from_file(paths[1])
    word.encode_special_tokens = True
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(paths[2], "rb"))}
    tik = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encode = [sp.encode, lambda w: word.encode(w, add_special_tokens=False).ids, tik.encode_ordinary]
    texts = ["", None, "a", "same text twice", "same text twice", "İstanbul d'Été x\u00a0y 12,5", "漢字かな " * 30, "слово ещё " * 40, "!!! ... 12", "long word " * 60_000]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    docs = docs.unionByName(table(spark, "/root/testdata/sf0.001", "documents").limit(60).selectExpr("doc_id + 100 AS doc_id", "text"))
    bands = {(n, "latin"): fertility.Band((1.2, 2.6), (0.0, 0.2), (3.0, 7.0)) for n in map(fertility.name_of, paths)}
    text = {r.doc_id: r.text or "" for r in docs.collect()}
    rows = fertility.measure(docs, paths, bands).collect()
    assert len(rows) == len(text)
    verdicts = set()
    for r in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text[r.doc_id])
        scripts = Counter(langid.script_of("".join(filter(str.isalpha, w))) for w in words if any(map(str.isalpha, w)))
        top = max(scripts.values(), default=0)
        script = min((k for k, n in scripts.items() if n == top), default="other")
        kept = not r.base_failed
        for k, (enc, path) in enumerate(zip(encode, paths)):
            ids = [i for w in words for i in enc(w)]
            p = np.array(list(Counter(ids).values())) / max(1, len(ids))
            want = (sum(map(len, words)) / len(ids), -(p * np.log2(p)).sum()) if ids else (0.0, 0.0)
            end = "" if k == 0 else "_" + fertility.name_of(path)
            assert (r["chars_per_token" + end], r["token_entropy" + end]) == pytest.approx(want)
            b = bands.get((fertility.name_of(path), script)) or (fertility.BANDS.get(script, fertility.BANDS["other"]) if k == 0 else None)
            kept &= b is None or (b.chars_per_token[0] <= want[0] <= b.chars_per_token[1] and b.byte_share[0] <= r["byte_share" + end] <= b.byte_share[1] and b.token_entropy[0] <= want[1] + 1e-12 and want[1] <= b.token_entropy[1])
        assert (r.script, r.kept) == (script, kept)
        verdicts.add((r.base_failed, r.kept))
    assert verdicts == {(True, False), (False, True), (False, False)}


# ---- Language ID


def exact_path(s):
    value, paths = s[0].copy(), [[k] for k in range(s.shape[1])]
    for row in s[1:]:
        new = [max((value[j] - langid.SWITCH * (j != k), -(j != k), -j) for j in range(len(row))) for k in range(len(row))]
        paths = [[*paths[-x[2]], k] for k, x in enumerate(new)]
        value = np.array([x[0] for x in new]) + row
    return value.max()


def score_of(s, path):
    return sum(s[i, k] for i, k in enumerate(path)) - langid.SWITCH * sum(a != b for a, b in zip(path, path[1:]))


def test_path_is_the_best():
    rng = np.random.default_rng(0)
    lab = langid.Labeller(langid.Model(["a", "b", "c"], np.zeros((1, 3)), {}))
    for n in [1, 2, 5, 40] * 40:
        s = rng.normal(0, rng.choice([0.5, 4, 9]), (n, 3))
        s -= s.max(1, keepdims=True)
        assert score_of(s, lab.path(s)) == pytest.approx(exact_path(s))


def test_language_id(spark):
    docs = table(spark, DATA, "documents")
    rows = langid.predict(docs).collect()
    true = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert {r.doc_id: r.held_out for r in rows} == {k: zlib.crc32(str(k).encode()) % 4 == 2 for k in true}
    held = [r for r in rows if r.held_out]
    assert np.mean([r.lang_pred == true[r.doc_id] for r in held]) > 0.97 and all(0 <= r.score <= 1 for r in rows)
    # Labels of held-out documents are never read.
    other = docs.selectExpr("doc_id", "text", "CASE WHEN crc32(cast(doc_id AS string)) % 4 = 2 THEN 'xx' ELSE lang END AS lang")
    assert sorted(map(tuple, langid.predict(other).collect())) == sorted(map(tuple, rows))
    odd = spark.createDataFrame([(1, None, "en", 0.5), (2, "", None, 0.5), (3, "123 _ !", "en", 0.5), (None, "the", "en", 0.5), (5, "the thing", "en", 0.5)], "doc_id long, text string, lang string, score double")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.predict(odd).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0) and len(got) == 5
    assert langid.predict(odd.limit(0)).count() == 0


def test_spans_of_mixed_text(spark):
    docs = table(spark, DATA, "documents")
    model = langid.train(docs)
    en, fr = (docs.where(f"lang = '{k}' AND length(text) BETWEEN 300 AND 900").orderBy("doc_id").first().text for k in ("en", "fr"))
    row = langid.label(spark.createDataFrame([(1, en + "\n" + fr)], "doc_id long, text string"), model, spans=True).first()
    assert {s.lang for s in row.spans} >= {"en", "fr"}
    turn = min(s.start for s in row.spans if s.lang == "fr")
    assert abs(turn - len(en)) < 60
    assert langid.script_of("Привет") == "cyrillic" and langid.script_of("漢字") == "han"


# ---- Quality classifier


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(600):
        g = int(rng.integers(0, 3))
        f = np.unique(np.concatenate([rng.integers(0, 50, 20), [100 + g, 100 + g]])).astype("<u4")
        rows.append((f, g))
    m = ordinal.fit(rows)
    assert m.thresholds[0] < m.thresholds[1]
    assert np.mean([m.probabilities(f).argmax() == g for f, g in rows]) > 0.95
    assert m.probabilities(rows[0][0]).sum() == pytest.approx(1)


def test_gradient_by_differences():
    """One step of the fit lowers the likelihood's loss, so rounds more fit better."""
    rng = np.random.default_rng(1)
    rows = [(np.unique(rng.integers(0, 30, 8)).astype("<u4"), int(rng.integers(0, 3))) for _ in range(300)]
    loss = lambda m: -np.mean([np.log(m.probabilities(f)[g]) for f, g in rows])
    prior = ordinal.Model(np.zeros(0, np.uint32), np.zeros(0), ordinal.fit([(np.zeros(0, "<u4"), g) for _, g in rows]).thresholds)
    assert loss(ordinal.fit(rows)) < loss(prior)


def test_held_out_accuracy(spark):
    large = "/root/testdata/sf0.1"  # the smaller ones have a few hundred labels
    docs, labels = table(spark, large, "documents"), table(spark, large, "labels")
    model = ordinal.train(docs, labels.where("doc_id % 3 <> 0"))
    true = {r.doc_id: r.grade for r in ordinal.grade_of(labels.where("doc_id % 3 = 0")).collect()}
    got = {r.doc_id: r for r in ordinal.score(docs, model).collect()}
    assert len(got) == docs.count()
    good = [got[k].kept == (g == 2) for k, g in true.items()]
    clean = [got[k].kept for k, g in true.items() if g == 2]
    print(np.mean(good), np.mean(clean), len(good))
    assert np.mean(good) > 0.95 and np.mean(clean) > 0.98
    assert all(0 <= r.expected_grade <= 2 and r.kept == (r.tail_prob >= ordinal.CUT) for r in got.values())


def test_ordinal_without_labels(spark):
    docs = spark.createDataFrame([(1, None, 3), (None, "a b", 3), (1, "x", 3)], "doc_id long, text string, grade int")
    labels = spark.createDataFrame([(None, 1, 0), (9, None, None)], "doc_id long, quality int, toxic int")
    assert ordinal.score(docs, ordinal.train(docs, labels)).count() == 3
    assert ordinal.select(docs, labels).columns == docs.columns
    assert ordinal.score(docs.limit(0), ordinal.train(docs.limit(0), labels.limit(0))).count() == 0


def test_langid_sample_is_bounded_and_grams_stand_alone():
    rows = [("a", 0, 5), ("a", 3, 4), ("a", 9, 2), ("b", 1, 2), ("c", 7, 90)]
    assert langid.finest_levels(rows, 6) == {"a": 3, "b": 1, "c": 8}
    words = ["a", "über", "漢字", "a" * 300]
    bucket, place = langid.grams(words)
    assert bucket.min() >= 0 and bucket.max() < langid.BUCKETS
    for i, w in enumerate(words):
        assert sorted(bucket[place == i]) == sorted(langid.grams([w])[0])


def test_fertility_bands_reject_bad_texts(spark):
    """Held-out labelled texts of 50 words or more: nearly all good ones are kept, most bad ones aren't."""
    large = "/root/testdata/sf0.1"
    docs, labels = table(spark, large, "documents"), table(spark, large, "labels").where("toxic = 0")
    paths = [public_tokenizers.path(x) for x in ("piece_bpe_32k.model", "word_bpe_49k.json", "byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken")]
    bands = fertility.fit(docs, labels, paths)
    assert {k for k, _ in bands} == set(map(fertility.name_of, paths))
    held = docs.join(labels.where("crc32(cast(doc_id AS string)) % 4 = 2"), "doc_id")
    quality = {r.doc_id: r.quality for r in held.select("doc_id", "quality").collect()}
    for v in (paths, *([x] for x in paths)):
        rows = [r for r in fertility.measure(held, v, bands).collect() if r.n_words >= 50]
        kept = [np.mean([r.kept for r in rows if quality[r.doc_id] == q]) for q in (0, 1)]
        print([fertility.name_of(x) for x in v], kept, [sum(quality[r.doc_id] == q for r in rows) for q in (0, 1)])
        assert kept[1] > 0.98 and kept[0] < (0.5 if len(v) > 1 else 0.6)


def test_the_same_vocabulary_measures_alike(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents").limit(80)
    a, b = (sorted(fertility.measure(docs, public_tokenizers.path(f"byte_bpe_50k.{x}")).select("doc_id", "chars_per_token", "byte_share", "token_entropy").collect()) for x in ("json", "tiktoken"))
    assert np.array(a) == pytest.approx(np.array(b)) and max(r.byte_share for r in a) > 0


def test_two_small_gains_beat_one_language():
    lab = langid.Labeller(langid.Model(["a", "b", "c"], np.zeros((1, 3)), {}))
    s = np.array([[0.0, -20, -9], [-20, 0, -9]])
    assert lab.path(s).tolist() == [0, 1] and score_of(s, lab.path(s)) == exact_path(s) == -10
    rng = np.random.default_rng(4)
    for n in [2, 3, 5, 8] * 100:
        s = -rng.integers(0, 12, (n, 4)).astype(float)
        s -= s.max(1, keepdims=True)
        assert score_of(s, lab.path(s)) == pytest.approx(exact_path(s))


def test_every_labelled_language_is_learnt(spark, monkeypatch):
    langs = [f"l{i}" for i in range(90)]
    words = {k: " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}{chr(97 + j)}q" * 2 for j in range(9)) for i, k in enumerate(langs)}
    docs = spark.createDataFrame([(100 * j + i, words[k], k) for i, k in enumerate(langs) for j in range(4)], "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert set(model.langs) == {r.lang for r in langid.training_rows(docs).select("lang").distinct().collect()} and len(model.langs) > 64
    monkeypatch.setattr(langid, "MOST_LANGS", 64)
    with pytest.raises(ValueError, match="64 labelled"):
        langid.train(docs)


def test_words_keep_combining_marks():
    """Vowel signs and accents stay with their letters; texts without marks are cut as by letters alone."""
    assert langid.words_of("\u0939\u093f\u0928\u094d\u0926\u0940 \u0e17\u0e35\u0e48 e\u0301te\u0301 A_b c3D \u2019x") == ["\u0939\u093f\u0928\u094d\u0926\u0940", "\u0e17\u0e35\u0e48", "e\u0301te\u0301", "a", "b", "c", "d", "x"]
    assert langid.words_of(None) == langid.words_of("") == langid.words_of("12 \u0301") == []
    for text in ("na\u00efve caf\u00e9s_x 9y", "\u2018quoted\u2019 \u4e2d\u6587"):
        assert langid.WORD.findall(text) == langid.SHORT.findall(text)
