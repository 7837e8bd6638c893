"""A run-length grammar of a sequence by recompression, and longest common extensions in it.

Levels alternate. Block compression replaces every stretch of one symbol by a symbol of its own; then no two neighbours are
equal. Pair compression deals all symbols into left and right ones by a hash bit and replaces every left symbol that a right
one follows, with it, by a symbol for the pair. Both look at symbols alone, so equal parts of the sequence are compressed
alike but for some symbols at their ends, and a level is about three quarters as long as the pairs' level before it. Names are
given by sorting what they stand for, so equal names mean equal strings: nothing rests on hashes.

An extension of two places climbs while both places start symbols that have equal symbols above them, skips equal symbols
(stretches of one symbol at once, by the shorter of the two), and climbs down where symbols differ; it ends where two symbols
of the sequence itself differ. Many extensions run side by side, one numpy step for all of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from .words import mix

#: Rounds in a row without any repeated pair after which higher levels would tell nothing.
_QUIET = 3
#: Extensions that run side by side.
_AT_ONCE = 1 << 18


@dataclass(frozen=True)
class Grammar:
    """All levels of a sequence in one numbering of nodes: those of the sequence first, level upon level. Every array has a row
    per node: its symbol, the symbols of the sequence it stands for, how many equal symbols follow on its level (itself
    included) and come before it if the next level compresses blocks (1 else), the node above it (-1: none), whether it
    is the first and the last below that, and the first and the last node below it.

    The first and the last symbol of the sequence must occur once each, so that no extension runs out of it.
    """

    size: int
    symbol: np.ndarray
    length: np.ndarray
    ahead: np.ndarray
    back: np.ndarray
    above: np.ndarray
    is_first: np.ndarray
    is_last: np.ndarray
    first: np.ndarray
    last: np.ndarray

    def forward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from places a and b (a != b) on are equal."""
        return self._extended(a, b, self.is_first, self.first, self.ahead, 1)

    def backward(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols up to and with places a and b are equal."""
        return self._extended(a, b, self.is_last, self.last, self.back, -1)

    def _extended(self, a: np.ndarray, b: np.ndarray, outer: np.ndarray, below: np.ndarray, run: np.ndarray, step: int) -> np.ndarray:
        out = np.zeros(len(a), np.int64)
        for begin in range(0, len(a), _AT_ONCE):
            self._extend(a[begin:begin + _AT_ONCE], b[begin:begin + _AT_ONCE], outer, below, run, step, out[begin:begin + _AT_ONCE])
        return out

    def _extend(self, a, b, outer, below, run, step, out) -> None:
        who, a, b = np.arange(len(a)), a.astype(np.int64), b.astype(np.int64)
        symbol, above = self.symbol, self.above
        while len(who):
            equal = symbol[a] == symbol[b]
            up, over = above[a], above[b]
            climbs = equal & outer[a] & outer[b] & (up >= 0)
            climbs &= symbol[up] == symbol[over]  # -1 is any node: such rows do not climb
            skips = np.flatnonzero(equal & ~climbs)
            many = np.minimum(run[a[skips]], run[b[skips]])
            out[who[skips]] += many * self.length[a[skips]]
            next_a, next_b = np.where(climbs, up, below[a]), np.where(climbs, over, below[b])
            next_a[skips], next_b[skips] = a[skips] + step * many, b[skips] + step * many
            stays = equal | (a >= self.size)
            who, a, b = who[stays], next_a[stays], next_b[stays]


def _named(one: np.ndarray, other: np.ndarray, base: int) -> tuple[np.ndarray, int]:
    """A number from `base` on for each pair of numbers, equal for equal pairs only, and how many there are."""
    if not len(one):
        return one, 0
    found, names = np.unique(one * np.int64(int(other.max()) + 1) + other, return_inverse=True)
    return names.astype(np.int64) + base, len(found)


def grammar(sequence: np.ndarray) -> Grammar:
    """The grammar of a sequence of numbers from 0 on."""
    symbol = sequence.astype(np.int64)
    size, names = len(symbol), int(symbol.max()) + 1 if len(symbol) else 0
    length = np.ones(size, np.int64)
    first = last = np.full(size, -1, np.int64)
    levels: dict[str, list[np.ndarray]] = {n: [] for n in ("symbol", "length", "ahead", "back", "above", "is_first", "is_last", "first", "last")}
    offset, quiet, blocks = 0, 0, True
    while True:
        n = len(symbol)
        starts = np.ones(n, bool)  # of the groups that become one symbol
        ahead = back = np.ones(n, np.int64)
        if blocks:
            starts[1:] = symbol[1:] != symbol[:-1]
        else:
            right = (mix(symbol.astype(np.uint64) + np.uint64(offset)) & np.uint64(1)).astype(bool)
            starts[1:] = right[:-1] | ~right[1:]
        at = np.flatnonzero(starts)
        counts = np.diff(np.append(at, n))
        ends = at + counts - 1
        if blocks:
            group = np.cumsum(starts) - 1
            here = np.arange(n)
            ahead, back = ends[group] - here + 1, here - at[group] + 1
            grown = np.flatnonzero(counts > 1)
            made, new = _named(symbol[at[grown]], counts[grown], names)
        else:
            group = np.cumsum(starts) - 1
            grown = np.flatnonzero(counts > 1)
            made, new = _named(symbol[at[grown]], symbol[ends[grown]], names)
            quiet = quiet + 1 if new == len(grown) else 0
        ending = np.zeros(n, bool)
        ending[ends] = True
        top = quiet >= _QUIET or n <= 2
        above = np.full(n, -1, np.int64) if top else group + offset + n
        for name, values in (("symbol", symbol), ("length", length), ("ahead", ahead), ("back", back), ("above", above), ("is_first", starts),
                             ("is_last", ending), ("first", first), ("last", last)):
            levels[name].append(values)
        if top:
            return Grammar(size, **{name: np.concatenate(parts) for name, parts in levels.items()})
        symbol = symbol[at]
        symbol[grown] = made
        names += new
        length = np.add.reduceat(length, at)
        first, last = at + offset, ends + offset
        offset += n
        blocks = not blocks
