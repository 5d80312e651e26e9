"""Repair of text that was decoded wrongly: UTF-8 read as cp1252 or latin-1, once or several times over.

Such text has the bytes of UTF-8 sequences as characters. Each sequence that could be one is read as UTF-8 again if that
costs less: characters of scripts in common use cost 1, others more, control characters most. What is clean has no
cheaper reading, so it stays: "à «" with a no-break space would be one Samaritan letter, which costs more than the three.
Layers are taken off until nothing gets cheaper. Then C1 controls are read as cp1252, curled quotes become straight,
Latin ligatures and full-width forms their plain letters, and control characters go.
"""

from __future__ import annotations

import re
import unicodedata

#: Bytes that cp1252 leaves undefined stand for themselves, as in latin-1.
BYTES = {bytes([b]).decode("cp1252", "ignore") or chr(b): b for b in range(0x80, 0x100)} | {chr(b): b for b in range(0x80, 0xA0)}
_CONT = "[" + re.escape("".join(c for c, b in BYTES.items() if b < 0xC0)) + "]"
SEQUENCE = re.compile(f"[Â-ß]{_CONT}|[à-ï]{_CONT}{{2}}|[ð-ô]{_CONT}{{3}}")
#: First and last code points of the scripts in common use (fixed values of Unicode's blocks).
COMMON = [(0xA0, 0x17F), (0x370, 0x3FF), (0x400, 0x4FF), (0x5D0, 0x5EA), (0x600, 0x6FF), (0x900, 0x97F), (0xB80, 0xBFF), (0xE00, 0xE7F), (0x2010, 0x2027), (0x2030, 0x203A), (0x20A0, 0x20BF), (0x2122, 0x2122), (0x3000, 0x30FF), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3), (0xFF00, 0xFFEF), (0x1F300, 0x1F6FF)]
MOST_LAYERS = 5
QUOTES = str.maketrans("‘’‚‛“”„‟", "''''\"\"\"\"")
LIGATURES = {c: unicodedata.normalize("NFKC", c) for c in map(chr, [*range(0xFB00, 0xFB07), *range(0x132, 0x134), 0x149, *range(0x1F1, 0x1F4), *range(0x1C4, 0x1CD)])}
WIDTHS = {chr(c): unicodedata.normalize("NFKC", chr(c)) for c in range(0xFF01, 0xFFEF) if unicodedata.normalize("NFKC", chr(c)) != chr(c)} | {"　": " "}
PLAIN = str.maketrans(LIGATURES | WIDTHS)
#: What either of them changes.
CHANGED = re.compile("[" + re.escape("".join(map(chr, QUOTES | PLAIN))) + "]")
CONTROL = re.compile("[\x00-\x08\x0b\x0e-\x1f\x7f﻿⁪-⁯￹-￼]")
C1 = re.compile("[\x80-\x9f]")
_SUSPECT = re.compile("[^\x00-\x7f]")


def cost(text: str) -> int:
    out = 0
    for c in text:
        at = ord(c)
        if at >= 0x80:
            out += 5 if 0x80 <= at < 0xA0 else 1 if c in BYTES or any(low <= at <= high for low, high in COMMON) else 3
    return out


def _read_again(m: re.Match) -> str:
    try:
        read = bytes(BYTES[c] for c in m[0]).decode()
    except UnicodeDecodeError:
        return m[0]
    return read if cost(read) < cost(m[0]) else m[0]


def decoded_again(text: str) -> str:
    """The text with all layers of wrong decoding taken off."""
    for _ in range(MOST_LAYERS):
        if (read := SEQUENCE.sub(_read_again, text)) == text:
            break
        text = read
    return text


def repaired(text: str) -> str:
    if _SUSPECT.search(text):
        text = decoded_again(text)
        text = C1.sub(lambda m: bytes([ord(m[0])]).decode("cp1252", "ignore") or m[0], text)
        text = text.translate(QUOTES).translate(PLAIN) if CHANGED.search(text) else text
    return CONTROL.sub("", text)
