"""Static range asymmetric numeral system for token ids.

A table of frequencies, out of 2**PRECISION, is shared by all blocks that were counted for it. A block is independent of
the others and holds interleaved lanes: id i belongs to lane i % lanes, and a step takes one id of every lane, so that
encoding and decoding are array operations. State: 64 bits, at least 2**31, refilled by 32-bit words. Every CHECKPOINT
steps the lanes' states and the place in the words are kept, so that several readers can share one block. The ids and
the whole block have checksums.
"""

from __future__ import annotations

import struct
import zlib
from dataclasses import dataclass

import numpy as np

PRECISION, LANES, CHECKPOINT = 20, 1024, 256
_LOW = np.uint64(1 << 31)
_HEAD = "<4sIQIIQI"  # magic, lanes, ids, checkpoints, first id, words, crc32 of the ids
_HEAD_SIZE = struct.calcsize(_HEAD)
_MAGIC = b"RNS1"


class Damaged(ValueError):
    """A block or table that does not match its checksum."""


@dataclass(frozen=True)
class Table:
    """Distinct symbols in ascending order and their frequencies, which add up to 2**PRECISION."""

    symbols: np.ndarray
    frequencies: np.ndarray

    @classmethod
    def of(cls, ids: np.ndarray) -> Table:
        """Frequencies near the ids' own; every id that occurs gets at least 1."""
        symbols, counts = np.unique(ids, return_counts=True)
        if len(symbols) > 1 << (PRECISION - 1):
            raise ValueError(f"more than {1 << (PRECISION - 1)} different ids")
        room = (1 << PRECISION) - len(symbols)
        given = 1 + counts * room // max(1, len(ids))
        if len(given):
            given[np.argmax(counts)] += (1 << PRECISION) - given.sum()
        return cls(symbols.astype(np.uint32), given.astype(np.uint32))

    def dump(self) -> bytes:
        steps = np.diff(self.symbols, prepend=np.uint32(0)).astype("<u4")
        raw = zlib.compress(steps.tobytes() + self.frequencies.astype("<u4").tobytes(), 6)
        return struct.pack("<II", len(self.symbols), zlib.crc32(raw)) + raw

    @classmethod
    def load(cls, raw: bytes) -> Table:
        n, check = struct.unpack_from("<II", raw)
        if zlib.crc32(raw[8:]) != check:
            raise Damaged("table")
        both = np.frombuffer(zlib.decompress(raw[8:]), "<u4")
        return cls(np.cumsum(both[:n], dtype=np.uint32), both[n:].astype(np.uint32))

    def places(self, ids: np.ndarray) -> np.ndarray:
        """The symbols' numbers of ids that all occur in the table."""
        where = np.zeros(int(self.symbols[-1]) + 1 if len(self.symbols) else 1, np.int32)
        where[self.symbols] = np.arange(len(self.symbols))
        return where[ids]


def lanes_for(n: int) -> int:
    """Fewer lanes for short blocks, whose states would outweigh their words."""
    return min(LANES, 1 << max(0, (n // 64).bit_length()))


def encode_block(ids: np.ndarray, table: Table) -> bytes:
    """One block of at least one id."""
    lanes = lanes_for(len(ids))
    steps = -(-len(ids) // lanes)
    symbol = np.full(steps * lanes, np.argmax(table.frequencies), np.int64)
    symbol[:len(ids)] = table.places(ids)
    symbol = symbol.reshape(steps, lanes)
    frequency = table.frequencies.astype(np.uint64)
    below = np.cumsum(frequency) - frequency
    top, shift, word = np.uint64(63 - PRECISION), np.uint64(PRECISION), np.uint64(32)
    state = np.full(lanes, _LOW, np.uint64)
    words: list[np.ndarray] = []
    kept: list[tuple[int, np.ndarray]] = []
    for t in range(steps - 1, -1, -1):
        row = symbol[t]
        f = frequency.take(row)
        full = state >= (f << top)
        words.append(state[full].astype("<u4"))
        state = np.where(full, state >> word, state)
        whole = state // f
        state = (whole << shift) + (state - whole * f) + below.take(row)
        if t % CHECKPOINT == 0:
            kept.append((t, state))
    words.reverse()
    at = np.concatenate(([0], np.cumsum([len(w) for w in words])))
    kept.reverse()
    body = b"".join([np.asarray([at[t] for t, _ in kept], "<u8").tobytes(),
                     np.concatenate([s for _, s in kept]).astype("<u8").tobytes(), *(w.tobytes() for w in words)])
    plain = np.ascontiguousarray(ids, "<u4")
    head = struct.pack(_HEAD, _MAGIC, lanes, len(ids), len(kept), int(plain[0]), int(at[-1]), zlib.crc32(plain))
    return head + struct.pack("<I", zlib.crc32(body, zlib.crc32(head))) + body


class Decoder:
    """Decodes blocks of one table."""

    def __init__(self, table: Table):
        self._symbols = table.symbols
        self._frequency = table.frequencies.astype(np.uint64)
        self._below = np.cumsum(self._frequency) - self._frequency
        self._at_slot = np.repeat(np.arange(len(table.symbols)), table.frequencies)

    def block(self, raw: bytes) -> np.ndarray:
        """All ids of a block, checked."""
        head, starts, states, words = self._open(raw)
        ids = self._run(head[1], head[2], 0, -(-head[2] // head[1]), states[0], words)
        if zlib.crc32(np.ascontiguousarray(ids, "<u4")) != head[6]:
            raise Damaged("ids")
        return ids

    def from_checkpoint(self, raw: bytes, number: int) -> np.ndarray:
        """The ids from one checkpoint up to the next; those of all checkpoints, joined, are the block."""
        head, starts, states, words = self._open(raw)
        first = number * CHECKPOINT
        last = min(first + CHECKPOINT, -(-head[2] // head[1]))
        return self._run(head[1], head[2], first, last, states[number], words[int(starts[number]):])

    @staticmethod
    def checkpoints(raw: bytes) -> int:
        return struct.unpack_from(_HEAD, raw)[3]

    def _open(self, raw: bytes):
        head = struct.unpack_from(_HEAD, raw)
        check, = struct.unpack_from("<I", raw, _HEAD_SIZE)
        body = memoryview(raw)[_HEAD_SIZE + 4:]
        if head[0] != _MAGIC or zlib.crc32(body, zlib.crc32(raw[:_HEAD_SIZE])) != check:
            raise Damaged("block")
        lanes, kept = head[1], head[3]
        starts = np.frombuffer(body, "<u8", kept)
        states = np.frombuffer(body, "<u8", kept * lanes, 8 * kept).reshape(kept, lanes)
        return head, starts, states, np.frombuffer(body, "<u4", head[5], 8 * kept * (1 + lanes))

    def _run(self, lanes: int, n: int, first: int, last: int, state: np.ndarray, words: np.ndarray) -> np.ndarray:
        mask, shift, word = np.uint64((1 << PRECISION) - 1), np.uint64(PRECISION), np.uint64(32)
        state = state.astype(np.uint64)
        out = np.empty((last - first, lanes), np.uint32)
        at = 0
        for t in range(last - first):
            slot = state & mask
            row = self._at_slot.take(slot.view(np.int64))
            out[t] = row
            state = self._frequency.take(row) * (state >> shift) + slot - self._below.take(row)
            empty = np.flatnonzero(state < _LOW)
            state[empty] = (state[empty] << word) | words[at:at + len(empty)]
            at += len(empty)
        return self._symbols[out.reshape(-1)[:n - first * lanes]]
