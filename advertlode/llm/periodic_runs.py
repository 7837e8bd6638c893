"""Periodic runs of words in whole texts, found by recompression.

A run is a stretch of words with smallest period q, of at least max(LEAST, 2 q) words, that no neighbouring word extends. Every
run of period p holds a multiple i of p with i + p in it too, so the pairs (i, i + p) for all p up to half the text are a
harmonic grid of n ln n candidates. Those where the words at i and i + p, and one pair of their neighbours, are equal are
extended to both sides by a grammar of the texts (`recompression.py`), exactly and without suffix arrays. A stretch found for
several periods has the smallest of them; the others are its multiples.

Work is map-side: the texts of a slice of a batch share one grammar, kept apart by symbols that occur once. Memory follows the
slice, or the one longest text; nothing is cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .recompression import grammar
from .words import Words, find_words, slices, worker_memory

LEAST = 12
#: Places of the grid that are kept for all texts; longer texts make theirs in parts of this size.
_GRID = 1 << 16


def _multiples(low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """All (j, p) with low <= j < high and p a divisor of j."""
    p = np.arange(1, high)
    many = (high - 1) // p - (low - 1) // p
    each = np.repeat(p, many)
    turn = np.arange(len(each)) - np.repeat(np.cumsum(many) - many, many)
    return (np.repeat((low - 1) // p + 1, many) + turn) * each, each


def _grid(n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) with j - i dividing j, for all j < n."""
    held = worker_memory().get("grid")
    if held is None:
        j, p = _multiples(1, _GRID)
        order = np.argsort(j, kind="stable")
        j, p = j[order], p[order]
        held = worker_memory()["grid"] = (j - p, j, np.searchsorted(j, np.arange(_GRID + 1)))
    i, j, until = held
    to = until[min(n, _GRID)]
    yield i[:to], j[:to]
    for low in range(_GRID, n, _GRID):
        j, p = _multiples(low, min(n, low + _GRID))
        yield j - p, j


def _candidates(symbols: np.ndarray, at: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places (i, j) of the grid of the n symbols from `at` on that a run can hold."""
    own, found = symbols[at:at + n], []
    for i, j in _grid(n):
        equal = np.flatnonzero(own[i] == own[j])
        i, j = i[equal] + at, j[equal] + at
        beside = (symbols[i + 1] == symbols[j + 1]) | (symbols[i - 1] == symbols[j - 1])
        beside &= j - i <= n // 2
        found.append((i[beside], j[beside]))
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def runs_of(symbols: np.ndarray, first: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, start, length and period of every run, by text, start and period. Text t has the numbers
    `symbols[first[t]:first[t + 1]]`, from 0 on; a run has `least` of them at least, and at least 4."""
    least = max(least, 4)
    texts, counts = len(first) - 1, np.diff(first)
    # One symbol that occurs once before each text, and one at the end.
    apart = np.arange(texts + 1) + (int(symbols.max()) + 1 if len(symbols) else 0)
    whole = np.insert(symbols.astype(np.int64), first, apart)
    begin = first[:-1] + np.arange(texts) + 1
    pairs = [_candidates(whole, int(begin[t]), int(counts[t])) for t in np.flatnonzero(counts >= least)]
    if not pairs or not sum(len(i) for i, _ in pairs):
        return (np.empty(0, np.int64),) * 4
    i, j = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
    # Only texts with candidates need a grammar.
    text = np.searchsorted(begin, i, "right") - 1
    used = np.unique(text)
    take = np.zeros(len(whole), bool)
    take[first + np.arange(texts + 1)] = True
    take[np.repeat(begin[used] - np.cumsum(counts[used]) + counts[used], counts[used]) + np.arange(counts[used].sum())] = True
    moved = np.cumsum(take) - 1
    found = grammar(whole[take])
    a, b = moved[i], moved[j]
    period = j - i
    ahead, back = found.forward(a, b), found.backward(a - 1, b - 1)
    good = ahead + back >= np.maximum(least - period, period)
    text, period = text[good], period[good]
    start, length = (i - back)[good] - begin[text], (ahead + back)[good] + period
    order = np.lexsort((period, length, start, text))
    text, start, length, period = text[order], start[order], length[order], period[order]
    new = np.ones(len(text), bool)
    new[1:] = (text[1:] != text[:-1]) | (start[1:] != start[:-1]) | (length[1:] != length[:-1])
    text, start, length, period = text[new], start[new], length[new], period[new]
    order = np.lexsort((period, start, text))
    return text[order], start[order], length[order], period[order]


def _word_numbers(words: Words) -> np.ndarray:
    """A number for each word, equal for equal words only."""
    inside = np.zeros(len(words.data) + 1, np.int8)
    np.add.at(inside, words.start, 1)
    np.add.at(inside, words.end, -1)
    letters = words.data[np.cumsum(inside[:-1], dtype=np.int8).astype(bool)]
    offsets = np.concatenate(([0], np.cumsum(words.end - words.start)))
    column = pa.Array.from_buffers(pa.large_binary(), len(words.start), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    return column.dictionary_encode().indices.to_numpy().astype(np.int64)


def _joined(words: Words, kept: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by single spaces."""
    text = words.text_of()[kept]
    start, size = words.start[kept], (words.end - words.start)[kept]
    after = np.ones(len(text), np.int64)  # a space, but not after a text's last word
    after[np.append(text[1:] != text[:-1], True)[:len(text)]] = 0
    until = np.concatenate(([0], np.cumsum(size + after)))
    out = np.full(until[-1], 0x20, np.uint8)
    letter = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(until[:-1], size) + letter] = words.data[np.repeat(start, size) + letter]
    ends = until[np.searchsorted(text, np.arange(len(words.at)), "left")]
    return pa.Array.from_buffers(pa.large_string(), len(words.at) - 1, [None, pa.py_buffer(ends), pa.py_buffer(out)])


def _found(least: int):
    run_type = pa.struct([(n, pa.int64()) for n in ("start", "length", "period")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, to, data, at in slices(batch.column(1)):
                words = find_words(data, at)
                text, start, length, period = runs_of(_word_numbers(words), words.first, least)
                repeats = np.zeros(len(words.start) + 1, np.int64)
                np.add.at(repeats, words.first[text] + start + period, 1)
                np.add.at(repeats, words.first[text] + start + length, -1)
                collapsed = _joined(words, np.flatnonzero(np.cumsum(repeats[:-1]) == 0))
                each = pa.StructArray.from_arrays([pa.array(c) for c in (start, length, period)], fields=list(run_type))
                ends = np.searchsorted(text, np.arange(to - row + 1), "left").astype(np.int32)
                yield pa.record_batch([batch.column(0).slice(row, to - row), pa.array(words.counts), pa.ListArray.from_arrays(pa.array(ends), each),
                                       collapsed.cast(pa.string())], ["id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, *, least: int = LEAST, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`<id_col>, n_words, runs, collapsed` of every row: all runs (start, length, period, in words from 0 on) by start and
    period, and the text without the words that a run has after its first period, joined by single spaces.

    Words are `[^\\x20\\x09-\\x0D]+` of the whole text. Null and empty texts have no words, no runs and an empty collapsed text.
    Rows that repeat are rows of their own; ids only pass through. Other columns are not read.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
        _found(least), f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return found.withColumnRenamed("id", id_col)
