"""Text functions: cleaning, language, attribution, penalties, obligations, citations in running text."""

from __future__ import annotations

import html
import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf, pandas_udf

from casebook.functions.repair import repaired

# Patterns and word lists of the sources.
ROLE_HINT = r"(?i)Minister|Speaker|Secretary|Chairman|Leader|Whip|President|Attorney|Ambassador|Mayor"
OBLIGATIONS = ["Consent", "Purpose Limitation", "Notification", "Access and Correction", "Accuracy", "Protection", "Retention Limitation", "Transfer Limitation", "Accountability"]
SECTION_TYPES = {"OA": "Oral Answer", "WA": "Written Answer", "WANA": "Written Answer (not answered)", "OS": "Oral Statement", "BP": "Bill Proceedings"}
PENALTY_PHRASE = r"(?i)(?:financial\s+penalt(?:y|ies)\s+of\s+|penalty\s+of\s+)((?:S?\$[\d,]+(?:\.\d{2})?)(?:\s+and\s+S?\$[\d,]+(?:\.\d{2})?)*)"
AMOUNT = r"\$([\d,]+(?:\.\d{2})?)"
NO_PENALTY = [("no further action", "nfa"), ("no breach", "no_breach"), ("not in breach", "no_breach"), ("warning", "warning")]
NEUTRAL = r"\[(\d{4})\]\s+(SG[A-Z]+(?:\([A-Z]+\))?)\s+(\d+)"
REPORT = r"\[(\d{4})\]\s+(\d+)\s+(SLR|SGLR|MLJ)(?:\(R\))?\s+(\d+)"
STATUTE_HEAD = r"(?i)\b(?:section|sections|s|ss)\s*(\d+[A-Z]*(?:\([^)]{1,8}\))*)"
STATUTE_IN_ACT = STATUTE_HEAD + r"(?:\s+of\s+the\s+([A-Z][A-Za-z ()'-]{3,80}?\s+Act(?:\s+\d{4})?))?"
OFFICE_FIRST = r"^(The\s+.+?)\s*\(([^)]+)\)\s*$"
NAME_FIRST = r"^([^(]+?)(?:\s*\(([^)]+)\))?\s*$"


def cleaned(text: str | None) -> str:
    if text and text.isascii() and "&" not in text:  # without control characters there is nothing to repair or to compose
        return " ".join((text if text.isprintable() else repaired(text)).split())
    return " ".join(unicodedata.normalize("NFC", repaired(html.unescape(text))).replace("\xa0", " ").split()) if text else ""


def clean(text: Column) -> Column:
    """Unescape HTML, repair what was decoded wrongly, compose (NFC), blank for no-break space, one blank for white space,
    trim; null is empty."""
    return pandas_udf(lambda texts: texts.map(cleaned), "string")(text)


def squeeze(text: Column) -> Column:
    """What `clean` does to white space, without leaving generated code."""
    return F.trim(F.regexp_replace(text, r"[\s ]+", " "))


def language_by_script(text: Column) -> Column:
    return F.when(text.rlike("[஀-௿]"), "ta").when(text.rlike("[一-鿿]"), "zh").otherwise("ms")


def split_attribution(label: Column) -> Column:
    """struct(name, role, seat) of a speaker's label."""
    label = F.trim(F.regexp_replace(squeeze(label), ":+$", ""))
    office, plain = OFFICE_FIRST, NAME_FIRST
    none = F.lit(None).cast("string")
    of = lambda name, role, seat: F.struct(name.alias("name"), role.alias("role"), seat.alias("seat"))
    get = lambda rx, i: F.nullif(F.trim(F.regexp_extract(label, rx, i)), F.lit(""))
    paren = get(plain, 2)
    return (
        F.when(F.coalesce(label, F.lit("")) == "", of(none, none, none))
        .when(label.rlike(office), of(get(office, 2), get(office, 1), none))
        .when(~label.rlike(plain), of(label, none, none))
        .otherwise(of(get(plain, 1), F.when(paren.rlike(ROLE_HINT), paren), F.when(~paren.rlike(ROLE_HINT), paren)))
    )


def penalty(summary: Column, types: Column) -> Column:
    """struct(amount long, stated, reason): amounts in penalty phrases, summed if all are whole; else why there is none."""
    phrases = F.regexp_extract_all(summary, F.lit(PENALTY_PHRASE), F.lit(1))
    amounts = F.transform(F.regexp_extract_all(F.array_join(phrases, " "), F.lit(AMOUNT), F.lit(1)), lambda x: F.translate(x, ",", "").cast("double"))
    whole = (F.size(phrases) > 0) & F.forall(amounts, lambda x: x == F.floor(x))
    low = F.lower(summary)
    none = F.lit(None)
    of = lambda a, s, r: F.struct(a.cast("long").alias("amount"), s.cast("string").alias("stated"), r.cast("string").alias("reason"))
    out = F.when(whole, of(F.aggregate(amounts, F.lit(0.0), lambda a, x: a + x), F.array_join(phrases, "; "), none))
    free = ~F.coalesce(F.array_contains(types, "Financial Penalty"), F.lit(False))
    for marker, reason in NO_PENALTY:
        out = out.when(free & F.contains(low, F.lit(marker)), of(F.lit(0), none, F.lit(reason)))
    directed = F.coalesce(F.array_contains(types, "Directions"), F.lit(False)) | low.rlike("directions (?:were )?(?:issued|imposed)")
    return out.when(free & directed, of(F.lit(0), none, F.lit("directions_only"))).otherwise(of(none, none, none))


def obligations(text: Column) -> Column:
    return F.filter(F.array(*map(F.lit, OBLIGATIONS)), lambda x: F.rlike(text, F.concat(F.lit(r"(?i)\b"), x, F.lit(r"\b"))))


def obligations_of(tags: Column, title: Column) -> Column:
    """Obligations that the tags name if any of them is one, else those that the title names; Openness counts as Accountability."""
    known = F.arrays_overlap(tags, F.array(*map(F.lit, OBLIGATIONS)))
    evidence = F.when(known, F.array_join(tags, " ")).otherwise(title)
    found = obligations(evidence)
    return F.when(F.contains(evidence, F.lit("Openness")) & ~F.array_contains(found, "Accountability"), F.array_append(found, F.lit("Accountability"))).otherwise(found)


def counsel(raw: Column) -> Column:
    """struct(raw, names_and_firms, side, firms): the side follows the last ' for '."""
    has = F.contains(raw, F.lit(" for "))
    return F.struct(raw.alias("raw"), F.when(has, F.regexp_extract(raw, r"(?s)^(.*) for ", 1)).otherwise(raw).alias("names_and_firms"), F.when(has, F.regexp_replace(F.substring_index(raw, " for ", -1), "[.;]+$", "")).alias("side"), F.regexp_extract_all(raw, F.lit(r"\(([^)]+)\)"), F.lit(1)).alias("firms"))


def case_name(title: Column) -> Column:
    hit = F.regexp_extract(title, r"(?i)\bby\s+(.+)$", 1)
    return F.when(hit != "", F.concat(F.lit("Re "), F.trim(hit))).otherwise(title)


def parties(title: Column) -> Column:
    return F.split(title, r"\s+v\s+", 2)


def court_authority(court: Column) -> Column:
    return F.when(court.isin("SGDC", "SGMC"), "STATECT").when(court.isin("SGFC", "SGHCF"), "FAMCT").otherwise("SUPCT")


def section_label(code: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in SECTION_TYPES.items() for x in kv)), code)


def heading(title: Column, subtitle: Column, index: Column) -> Column:
    some = F.concat_ws(" - ", F.nullif(title, F.lit("")), F.nullif(subtitle, F.lit("")))
    return F.coalesce(F.nullif(some, F.lit("")), F.concat(F.lit("Section "), index.cast("string")))


def is_question(number: Column, kind: Column) -> Column:
    return number.isNotNull() | F.coalesce(kind.isin("WA", "WANA", "OA"), F.lit(False))


# ---- Search terms


_KINDS = bytes.maketrans(b"abcdefghijklmnopqrstuvwxyz", b"VCCCVCCCVCCCCCVCCCCCVCCCyC")


def _kinds(w: str) -> bytes:
    """C for each consonant of a word of a to z, V for each vowel; y is a vowel after a consonant."""
    kinds = w.encode().translate(_KINDS)
    at = kinds.find(b"y")
    while at >= 0:
        kinds = kinds[:at] + (b"V" if at and kinds[at - 1 : at] == b"C" else b"C") + kinds[at + 1 :]
        at = kinds.find(b"y", at)
    return kinds


def _measure(stem: str) -> int:
    return _kinds(stem).count(b"VC")


def _vowel(stem: str) -> bool:
    return b"V" in _kinds(stem)


def _cvc(w: str) -> bool:
    return len(w) > 2 and w[-1] not in "wxy" and _kinds(w).endswith(b"CVC")


def _ending(w: str, of: dict[str, str] | frozenset[str], most: int) -> str | None:
    """The longest of some endings that a word has."""
    for n in range(most, 1, -1):
        if (end := w[-n:]) in of:
            return end
    return None


# The suffix lists of Porter's published algorithm.
STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "logi": "log", "bli": "ble", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble"}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
WORD = re.compile(r"[^\W_]+")
PLAIN_WORD = re.compile("[a-z]+").fullmatch
#: What isn't a letter or digit of plain text is a blank.
BLANKED = str.maketrans({chr(c): " " for c in range(128) if not chr(c).isalnum()})
STEP4 = frozenset(["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"])


@lru_cache(100_000)
def porter(w: str) -> str:
    """Porter's stem of a lower-case word; short or other words stay."""
    if len(w) < 3 or not PLAIN_WORD(w):
        return w
    if w.endswith(("sses", "ies")):
        w = w[:-2]
    elif w[-1] == "s" and w[-2] != "s":
        w = w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if _measure(w[:-3]) else w
    else:
        cut = w[:-2] if w.endswith("ed") else w[:-3] if w.endswith("ing") else ""
        if cut and _vowel(cut):
            w = cut
            if w.endswith(("at", "bl", "iz")):
                w += "e"
            elif len(w) > 1 and w[-1] == w[-2] and w[-1] not in "lsz" and _kinds(w).endswith(b"C"):
                w = w[:-1]
            elif _measure(w) == 1 and _cvc(w):
                w += "e"
    if w.endswith("y") and _vowel(w[:-1]):
        w = w[:-1] + "i"
    for step in (STEP2, STEP3):
        end = _ending(w, step, 7)
        if end and _measure(w[: -len(end)]) > 0:
            w = w[: -len(end)] + step[end]
    end = _ending(w, STEP4, 5)
    if end and _measure(w[: -len(end)]) > 1 and (end != "ion" or w[: -len(end)].endswith(("s", "t"))):
        w = w[: -len(end)]
    if w.endswith("e") and (_measure(w[:-1]) > 1 or _measure(w[:-1]) == 1 and not _cvc(w[:-1])):
        w = w[:-1]
    if w.endswith("ll") and _measure(w) > 1:
        w = w[:-1]
    return w


def words_of(text: str | None) -> list[str]:
    """Runs of letters and digits of a text, lower case, without diacritics."""
    text = text or ""
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text)
        if marks := "".join(sorted(c for c in set(text) if unicodedata.category(c) == "Mn")):
            text = re.sub(f"[{marks}]+", "", text)
    text = text.lower()
    return text.translate(BLANKED).split() if text.isascii() else WORD.findall(text)


def terms(text: str | None, stem: bool = True) -> list[str]:
    """Search terms of a text: runs of letters and digits, lower case, without diacritics, stemmed."""
    found = words_of(text)
    return [porter(w) for w in found] if stem else found


def stemmed_terms(text: Column) -> Column:
    """`terms` of each text; a batch's distinct words are stemmed once."""

    @arrow_udf("array<string>")
    def stems(texts: pa.Array) -> pa.Array:
        found = [words_of(x) for x in texts.to_pylist()]
        coded = pa.array([w for words in found for w in words], pa.string()).dictionary_encode()
        stemmed = pa.array([porter(w) for w in coded.dictionary.to_pylist()], pa.string())
        ends = np.cumsum([0, *map(len, found)])
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), stemmed.take(coded.indices))

    return stems(text)


def plain_terms(text: Column) -> Column:
    """Terms without folding or stemming, in generated code."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))
