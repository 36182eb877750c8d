"""Words of text columns as numpy arrays: boundaries, owners and 64-bit hashes.

Works on the UTF-8 bytes of an Arrow string column, so that whole texts are split
without a Python object per word.  All functions are exact but for ``word_hashes``,
whose values are 64-bit fingerprints.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: bytes of text handled at once; one longer text is handled alone
PIECE_BYTES = 2 << 20
#: bytes of words hashed at once; one longer word is hashed alone
HASHED_BYTES = 256 << 10


def _table(outside: list[tuple[int, int]]) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    for lo, hi in outside:
        table[lo : hi + 1] = False
    return table


#: `[^\x20\x09-\x0D]+`
SPACED = _table([(0x20, 0x20), (0x09, 0x0D)])
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` of lower-cased text: A-Z count as letters here
ALPHANUMERIC = _table([(0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_random = np.random.default_rng(20240229)
#: a random odd multiplier for each byte value
_BYTE = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=4)
def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def powers(n: int, base: int = int(_BASE)) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    return _powers(1 << max(6, int(n).bit_length()), base)[:n]


def mixed(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes, so that every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(32)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its rows; null is empty."""
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        return np.empty(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], text: int, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in slices of at most ``limit`` bytes of text (a longer text alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = text_bytes(batch.column(text))
        at = 0
        while at < batch.num_rows:
            upto = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            upto = max(at + 1, min(upto, batch.num_rows))
            yield batch.slice(at, upto - at)
            at = upto


@dataclass
class Words:
    """Words of several texts: byte ranges, and the first word of each text (one entry more than texts)."""

    raw: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def owner(self) -> np.ndarray:
        """Index of the text each word is from."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def split_words(column: pa.Array, kind: np.ndarray, lower: bool = False) -> Words:
    """Maximal runs of the bytes in ``kind``, never across two texts."""
    raw, offsets = text_bytes(column)
    if lower:
        raw = LOWER[raw]
    inside = np.zeros(len(raw) + 2, dtype=bool)
    inside[1:-1] = kind[raw]
    cut = np.zeros(len(raw) + 1, dtype=bool)  # a text begins here
    cut[offsets] = True
    begins = inside[1:] & (~inside[:-1] | cut)
    finishes = inside[:-1] & (~inside[1:] | cut)
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(finishes)
    return Words(raw, starts, ends, np.searchsorted(starts, offsets))


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit fingerprint of each word's bytes."""
    n = len(words.starts)
    found = np.empty(n, dtype=np.uint64)
    upto = np.cumsum(words.ends - words.starts)
    at = done = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(upto, done + HASHED_BYTES, side="right")))
        starts = words.starts[at:end]
        lengths = words.ends[at:end] - starts
        begins = upto[at:end] - lengths - done  # of each word in the bytes of these words
        within = np.arange(int(upto[end - 1]) - done) - np.repeat(begins, lengths)
        values = _BYTE[words.raw[within + np.repeat(starts, lengths)]]
        values *= powers(int(lengths.max()))[within]
        found[at:end] = mixed(np.add.reduceat(values, begins) + lengths.astype(np.uint64))
        at, done = end, int(upto[end - 1])
    return found


class SequenceHash:
    """Fingerprints of any run of words, from prefix sums over the words' fingerprints."""

    def __init__(self, hashes: np.ndarray, base: int = 0xD6E8FEB86659FD93):
        n = len(hashes)
        self.inverse = powers(n + 1, pow(base, -1, 1 << 64))
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(hashes * powers(n + 1, base)[:n], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        length = np.asarray(ends - starts).astype(np.uint64)
        return mixed((self.sums[ends] - self.sums[starts]) * self.inverse[starts] + length)
