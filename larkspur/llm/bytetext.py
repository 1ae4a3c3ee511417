"""Whole columns of text as flat NumPy arrays, for use inside tasks.

Blanks are ASCII, so words can be cut on the UTF-8 bytes. A word's hash sums one
pseudo-random 64-bit number for each (place, byte), as in tabulation hashing.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20  # text handled at once; a longer text is handled alone
_PLACES = 64


def mix64(x: np.ndarray) -> np.ndarray:
    """A well-mixed permutation of unsigned 64-bit numbers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@lru_cache(maxsize=1)
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, byte) numbers, which bytes are blanks, lower-case of each byte."""
    places = mix64((np.arange(_PLACES * 256, dtype=np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
    blank = np.zeros(256, bool)
    blank[[0x20, *range(0x09, 0x0E)]] = True
    lower = np.arange(256, dtype=np.uint8)
    lower[ord("A") : ord("Z") + 1] += 32
    return places, blank, lower


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the offsets of the texts; a null is empty."""
    texts = texts.fill_null("") if texts.null_count else texts
    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def slices(batch: pa.RecordBatch, text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``most`` bytes of text, at least a row each."""
    size = utf8(batch.column(batch.schema.get_field_index(text)))[1]
    row = 0
    while row < batch.num_rows:
        end = max(row + 1, int(np.searchsorted(size, size[row] + most, "right")) - 1)
        yield batch.slice(row, end - row)
        row = end


class Words:
    """Words of a column of texts: hash, row, and the number of words of each row."""

    def __init__(self, texts: pa.Array, lower: bool = True):
        places, blank, lowered = _tables()
        data, self.offsets = utf8(texts)
        self.rows = len(texts)
        self.solid = ~blank[data]
        self.raw = data[self.solid]
        first = np.zeros(len(data) + 1, bool)
        first[self.offsets[:-1]] = True
        first = first[:-1]
        first[1:] |= ~self.solid[:-1]
        first &= self.solid
        self.begins = np.flatnonzero(first)
        self.bytes = lowered[self.raw] if lower else self.raw
        self.row = np.searchsorted(self.offsets, self.begins, "right") - 1
        # places of the words' first bytes among the bytes that are no blanks
        self.starts = np.flatnonzero(first[self.solid])
        self.lengths = np.diff(np.append(self.starts, len(self.bytes)))
        self.counts = np.bincount(self.row, minlength=self.rows)

    def place(self) -> np.ndarray:
        """Of each solid byte in its word."""
        return np.arange(len(self.bytes)) - np.repeat(self.starts, self.lengths)

    def hashes(self) -> np.ndarray:
        return hash_runs(self.bytes, self.place(), self.starts)


def hash_runs(data: np.ndarray, place: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A hash for each run of bytes that begins at ``starts``; ``place`` counts within a run."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    places, _, _ = _tables()
    part = places[(place % _PLACES) * 256 + data]
    far = np.flatnonzero(place >= _PLACES)
    if len(far):
        part[far] = mix64(part[far] + place[far].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return mix64(np.add.reduceat(part, starts))


def shingles(hashes: np.ndarray, counts: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` neighbouring words of a row, and the row of each; none if a row is shorter."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + mix64(hashes[k : k + n] + np.uint64(k + 1))
    row = np.repeat(np.arange(len(counts)), counts)
    whole = row[:n] == row[size - 1 :]
    return mix64(total[whole]), row[:n][whole]
