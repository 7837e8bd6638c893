"""Words and shingles of whole texts as numpy arrays, straight from Arrow buffers.

A word is a run of bytes other than space and the controls 0x09-0x0D, that is `[^\\x20\\x09-\\x0D]+`: the bytes of other
characters in UTF-8 never equal these. Words are hashed by a Karp-Rabin polynomial over 2**64, read off prefix sums, so
that no Python code runs per word; equal words always have equal hashes. Texts are taken in slices of bounded size, cut
between texts, so memory follows the slice or the one longest text, not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text handled at a time; one longer text is a slice of its own.
SLICE_BYTES = 1 << 21

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: A value per byte, so that a polynomial of small numbers does not arise; A-Z may count as a-z.
BYTE_VALUES = np.random.default_rng(20240601).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWERED = BYTE_VALUES.copy()
_LOWERED[ord("A"):ord("Z") + 1] = BYTE_VALUES[ord("a"):ord("z") + 1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads them evenly (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def worker_memory() -> dict:
    """What a worker keeps from task to task. This package travels to the executors by value, its globals anew with every
    task, so what is kept hangs on a library's module."""
    return vars(pa).setdefault("_advertlode_memory", {})


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of the base and of its inverse."""
    held = worker_memory().get("powers")
    if held is None or len(held[0]) <= n:
        held = []
        for base in (_BASE, _INVERSE):
            table = np.full(max(n, SLICE_BYTES) + 1, base, np.uint64)
            table[0] = 1
            held.append(np.multiply.accumulate(table))
        if n <= 4 * SLICE_BYTES:  # not those of a rare very long text
            worker_memory()["powers"] = held
    return held[0], held[1]


@dataclass(frozen=True)
class Words:
    """Words of some texts in order. `first[i]:first[i + 1]` are those of text i; `start`, `end` are byte positions in
    `data`, and text i is `data[at[i]:at[i + 1]]`."""

    data: np.ndarray
    at: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.at) - 1), self.counts)

    def hashes(self, *, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word; with `lower`, A-Z count as a-z."""
        if not len(self.start):
            return np.empty(0, np.uint64)
        power, inverse = power_tables(len(self.data))
        sums = np.zeros(len(self.data) + 1, np.uint64)
        np.cumsum((_LOWERED if lower else BYTE_VALUES)[self.data] * power[:len(self.data)], out=sums[1:])
        return mix((sums[self.end] - sums[self.start]) * inverse[self.start] + (self.end - self.start).astype(np.uint64))


def buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; null counts as empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64, len(texts) + 1, texts.offset * 8)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)), at


def slices(texts: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(from row, to row, bytes, offsets) of consecutive texts of about `limit` bytes."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    data, at = buffers(texts)
    row, rows = 0, len(texts)
    while row < rows:
        to = int(np.searchsorted(at, at[row] + limit, "right")) - 1
        to = min(max(to, row + 1), rows)
        yield row, to, data[at[row]:at[to]], at[row:to + 1] - at[row]
        row = to


#: Bytes between words for `find_words(..., between=MARKS)`: white space, controls and ASCII punctuation.
MARKS = np.ones(256, bool)
MARKS[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def find_words(data: np.ndarray, at: np.ndarray, *, between: np.ndarray = _SPACE) -> Words:
    """The words of texts given as bytes and offsets."""
    inside = ~between[data]
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    # Where a text starts within a run, so does a word; the run before it ends there.
    cut = at[1:-1]
    cut = cut[(cut > 0) & (cut < len(data))]
    begins[cut] = inside[cut]
    ends[cut - 1] = inside[cut - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, at, start, end, np.searchsorted(start, at, "left"))


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of `size` words in a row, and the position of each text's first; a text with fewer words gives one, of its
    whole sequence, and one without words none."""
    n = len(hashes)
    counts = np.diff(first)
    rolled = np.zeros(n, np.uint64)
    for i in range(size):
        part = np.zeros(n, np.uint64)
        part[:n - i] = hashes[i:]
        rolled = mix(rolled * _BASE + part + np.uint64(1))
    made = np.where(counts >= size, counts - size + 1, 0)
    short = (counts > 0) & (counts < size)
    at = np.zeros(len(counts) + 1, np.int64)
    np.cumsum(made + short, out=at[1:])
    out = np.empty(at[-1], np.uint64)
    keep = np.repeat(first[:-1] - (at[:-1]), made + short) + np.arange(at[-1])
    out[:] = rolled[keep] if n else 0
    for i in np.flatnonzero(short):  # fewer than `size` words each
        value = np.uint64(counts[i])
        with np.errstate(over="ignore"):
            for h in hashes[first[i]:first[i + 1]]:
                value = mix(np.asarray([value * _BASE + h + np.uint64(7)], np.uint64))[0]
        out[at[i]] = value
    return out, at
