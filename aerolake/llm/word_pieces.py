"""Normalised pieces of a text for a byte-level BPE vocabulary with word ends.

The ``tokenizers`` JSON format with NFC, white space and lower-case normalisation and a
pattern that splits letters, single digits and other signs.  The library's letter and
case tables are of another Unicode version than Python's and ``regex``'s; the code
points in which they differ are listed here, and texts that hold one take a slower way.
"""

from __future__ import annotations

import re
import unicodedata

import numpy as np
import regex

# Fixed values of the vocabulary's format: its splitting pattern, and the printable
# characters that stand for the 256 bytes.
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
PLAIN_BYTES = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]

# Code points that the library's pattern takes neither as letters nor as numbers.
NOT_LETTERS = [
    (0x558, 0x558), (0x58B, 0x58C), (0x88F, 0x88F), (0xC5C, 0xC5C), (0xCDC, 0xCDC), (0x208F, 0x208F), (0x209D, 0x209F),
    (0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2), (0xA7D4, 0xA7D4), (0xA7DD, 0xA7DD), (0xA7E2, 0xA7E2), (0xA7F1, 0xA7F1),
    (0xAB6C, 0xAB6D), (0x107BB, 0x107BF), (0x10940, 0x10959), (0x10EC5, 0x10EC7), (0x10ED9, 0x10EEE), (0x11B0A, 0x11B0A),
    (0x11DB0, 0x11DDB), (0x11DE0, 0x11DE9), (0x11DF1, 0x11DF1), (0x1246F, 0x1246F), (0x12475, 0x1247F), (0x12550, 0x12686),
    (0x16EA0, 0x16EB8), (0x16EBB, 0x16ED3), (0x16FF2, 0x16FF6), (0x187F8, 0x187FF), (0x18CD6, 0x18CDA), (0x18D09, 0x18D20),
    (0x18D80, 0x18DF2), (0x18E00, 0x19191), (0x191A0, 0x191D2), (0x1B123, 0x1B128), (0x1B168, 0x1B168), (0x1D6A6, 0x1D6A6),
    (0x1DF1F, 0x1DF24), (0x1DF2B, 0x1DF81), (0x1DF90, 0x1DF96), (0x1DFCD, 0x1DFFF), (0x1E6C0, 0x1E6DE), (0x1E6E0, 0x1E6E2),
    (0x1E6E4, 0x1E6E5), (0x1E6E7, 0x1E6ED), (0x1E6F0, 0x1E6F4), (0x1E6FE, 0x1E6FF), (0x2B73A, 0x2B73F), (0x2B81E, 0x2B81E),
    (0x2CEA2, 0x2CEAD), (0x323B0, 0x33479), (0x3D000, 0x3FC3F),
]
# First and last capital that the library lowers and Python does not, and the first one's small letter.
NEW_CAPITALS = [
    (0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF), (0xA7D2, 0xA7D2, 0xA7D3),
    (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B), (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB),
]

_SET = "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in NOT_LETTERS)
_LOWERED = {a + i: chr(c + i) for a, b, c in NEW_CAPITALS for i in range(b - a + 1)}
#: a code point for which the tables differ
ODD = regex.compile(f"[{_SET}{''.join(map(chr, _LOWERED))}]")
FIRST_ODD = min(a for a, *_ in [*NOT_LETTERS, *NEW_CAPITALS])
_ASCII = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\x09-\x0D\x20a-z0-9]+")
_EXACT = regex.compile(rf"(?V1)'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}--[{_SET}]]+|[\p{{N}}--[{_SET}]]|(?:[^\s\p{{L}}\p{{N}}]|[{_SET}])+")


def byte_symbols() -> list[str]:
    """The character that stands for each byte: itself if printable, else the next one from 256 up."""
    plain, out, extra = set(PLAIN_BYTES), [], 256
    for b in range(256):
        out.append(chr(b if b in plain else extra))
        extra += b not in plain
    return out


def text_pieces(text: str) -> list[str]:
    """The normalised pieces of a text without special strings, in order."""
    if text.isascii():
        return _ASCII.findall(text.lower())
    # the vocabulary lower-cases character by character: no final sigma
    text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    units = np.frombuffer(text.encode("utf-16-le"), dtype=np.uint16)  # surrogates are above all others of interest
    if units.max() >= FIRST_ODD and ODD.search(text):
        return _EXACT.findall(text.translate(_LOWERED).lower())
    return PIECES.findall(text.lower())


def special_pattern(spec: dict) -> regex.Pattern | None:
    """A pattern of the special strings of a vocabulary file, the longest first; None if it has none."""
    special = [t["content"] for t in spec["added_tokens"]]
    return regex.compile("|".join(map(regex.escape, sorted(special, key=len, reverse=True)))) if special else None
