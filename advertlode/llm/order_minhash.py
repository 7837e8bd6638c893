"""Fingerprints that follow the edit distance: Order MinHash.

A text's k-byte strings are numbered by their occurrence, so that repeats count, and each has a value: the hash of the string for its
first occurrence, a hash of that and the number for later ones. A hash function is a point on the circle of values, and selects
the SELECTED values that follow it; so one sort of a text's values serves all functions. The selected strings are put back
into text order and hashed as one tuple. Texts that keep most of their strings in the same order agree in most tuples. The share
p of tuples that agree estimates j**SELECTED for the weighted overlap j, and 2j / (1 + j) is the share of the strings that both
texts have, which falls with the edit distance.

Every text takes part with two kinds of strings whatever its length: long ones, which tell texts of one language apart,
and short ones, by which even a few words have many. `likeness` is the mean of both kinds, each by its number of functions.

Equal texts have equal fingerprints. A text shorter than a kind's strings is one string, and an empty one has an empty fingerprint.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import staged
from .token_files import text_slices
from .words import BYTE_VALUES, buffers, mix, power_tables

#: Bytes of the strings of each kind, and its hash functions.
KINDS = ((8, 48), (3, 16))
SKETCHES, SELECTED = sum(n for _, n in KINDS), 2
_PLACES = 24  # low bits for a place in a text, the others for its value; longer texts have values of their own length
_PLACE = np.uint64((1 << _PLACES) - 1)
#: Where each function's point lies.
POINTS = np.random.default_rng(41).integers(0, 1 << 40, SKETCHES, dtype=np.uint64) << np.uint64(_PLACES)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Bytes of text handled at a time, so few that their arrays stay in a core's cache.
_SLICE = 1 << 19


def _following(points: np.ndarray, *sides: np.ndarray) -> np.ndarray:
    """For each point the SELECTED values that follow it on the circle, among sorted sides: of each side as many, then the
    nearest of all."""
    ahead = []
    for values in sides:
        at = np.searchsorted(values, points)[:, None] + np.arange(min(SELECTED, len(values)))
        ahead.append(values[at % len(values)] - points[:, None])
    return np.sort(np.concatenate(ahead, axis=1), axis=1)[:, :SELECTED] + points[:, None]


def _selected(strings: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values and places of the strings of a text that each function selects."""
    n = len(strings)
    if n >= 1 << _PLACES:
        return _selected_in_long(strings, points)
    key = np.sort((strings & ~_PLACE) | np.arange(n, dtype=np.uint64))
    new = np.ones(n, bool)
    np.greater(key[1:] ^ key[:-1], _PLACE, out=new[1:])
    first = np.flatnonzero(new)
    sides = [key[first]]
    if len(first) < n:
        again = np.flatnonzero(~new)
        number = again - np.repeat(first, np.diff(first, append=n) - 1)
        repeated = key[again]
        sides.append(np.sort((mix((repeated & ~_PLACE) + number.astype(np.uint64) * _STEP) & ~_PLACE) | (repeated & _PLACE)))
    chosen = _following(points, *sides)
    return chosen & ~_PLACE, (chosen & _PLACE).astype(np.int64)


def _selected_in_long(strings: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for a text whose places do not fit beside the values."""
    value = strings & ~_PLACE
    place = np.argsort(value, kind="stable")
    value = value[place]
    first = np.flatnonzero(np.append(True, value[1:] != value[:-1]))
    number = np.arange(len(value)) - np.repeat(first, np.diff(first, append=len(value)))
    value = np.where(number, mix(value + number.astype(np.uint64) * _STEP) & ~_PLACE, value)
    order = np.lexsort((place, value))
    value, place = value[order], place[order]
    at = (np.searchsorted(value, points)[:, None] + np.arange(SELECTED)) % len(value)
    return value[at], place[at]


def _prefix_sums(data: np.ndarray) -> np.ndarray:
    power, _ = power_tables(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * power[:len(data)], out=sums[1:])
    return sums


def _strings(sums: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every k-byte string of each text, and where each text's begin."""
    _, inverse = power_tables(len(sums) - 1)
    size = np.diff(at)
    made = np.where(size >= k, size - k + 1, np.minimum(size, 1))
    first = np.concatenate(([0], np.cumsum(made)))
    start = np.repeat(at[:-1] - first[:-1], made) + np.arange(first[-1])
    end = np.minimum(start + k, np.repeat(at[1:], made))
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64)), first


def _kind(sums: np.ndarray, at: np.ndarray, k: int, points: np.ndarray) -> np.ndarray:
    """The tuples of one kind of strings."""
    strings, first = _strings(sums, at, k)
    texts = len(first) - 1
    chosen = np.zeros((texts, len(points), SELECTED), np.uint64)
    where = np.full((texts, len(points), SELECTED), -1)
    for t in np.flatnonzero(np.diff(first)).tolist():
        value, place = _selected(strings[first[t]:first[t + 1]], points)
        chosen[t, :, :value.shape[1]], where[t, :, :value.shape[1]] = value, place
    chosen = np.take_along_axis(chosen, np.argsort(where, axis=2, kind="stable"), 2)
    told = np.zeros(chosen.shape[:2], np.uint64)
    for s in range(SELECTED):
        told = mix(told * _STEP + chosen[:, :, s] + np.uint64(1))
    return (told >> np.uint64(48)).astype(np.uint16)


def fingerprints(texts: pa.Array) -> np.ndarray:
    """SKETCHES numbers of 16 bits for each text; those of an empty text mean nothing."""
    data, at = buffers(texts)
    data, at = data[at[0]:at[-1]], at - at[0]
    ends, sums = np.cumsum([n for _, n in KINDS]), _prefix_sums(data)
    return np.concatenate([_kind(sums, at, k, POINTS[end - n:end]) for (k, n), end in zip(KINDS, ends)], axis=1)


def likeness(one: np.ndarray, other: np.ndarray, one_empty: np.ndarray, other_empty: np.ndarray) -> np.ndarray:
    """0 to 1 for rows of fingerprints; two empty texts are alike, an empty one and another are not."""
    total, end = 0.0, 0
    for _, n in KINDS:
        overlap = (one[:, end:end + n] == other[:, end:end + n]).mean(1) ** (1 / SELECTED)
        total, end = total + n * 2 * overlap / (1 + overlap), end + n
    return np.where(one_empty | other_empty, (one_empty & other_empty).astype(float), total / SKETCHES)


def edited(text: str, follower: str) -> str:
    """The last third of a text, rounded down, replaced by as many characters from the start of the next, or all of it."""
    third = len(text) // 3
    return text[:len(text) - third] + follower[:third]


_ROWS = ("shard long, place long, id {id}, n_chars long, sha256 binary, fingerprint binary, edited_fingerprint binary, "
         "near_edited double, near_next double, edge int, text string")
_EMPTY = b""


def _compared(ids: list, texts: list[str], prints: np.ndarray, shard: int, place: int, kind: pa.DataType) -> pa.RecordBatch:
    """Rows of all texts but the last, each with its follower."""
    n = len(texts) - 1
    after = [edited(a, b) for a, b in zip(texts, texts[1:])]
    later = fingerprints(pa.array(after, pa.large_string()))
    empty, later_empty = np.asarray([not t for t in texts]), np.asarray([not t for t in after], bool)

    def raw(rows: np.ndarray, none: np.ndarray) -> list[bytes]:
        return [_EMPTY if e else r.astype(">u2").tobytes() for r, e in zip(rows, none)]

    return pa.record_batch([
        pa.array(np.full(n, shard)), pa.array(np.arange(place, place + n)), pa.array(ids[:n], kind),
        pa.array([len(t) for t in texts[:n]], pa.int64()), pa.array([hashlib.sha256(t.encode()).digest() for t in after], pa.binary()),
        pa.array(raw(prints[:n], empty[:n]), pa.binary()), pa.array(raw(later, later_empty), pa.binary()),
        pa.array(likeness(prints[:n], later, empty[:n], later_empty)), pa.array(likeness(prints[:n], prints[1:], empty[:n], empty[1:])),
        pa.array(np.zeros(n, np.int32)), pa.nulls(n, pa.string())], _names())


def _names() -> list[str]:
    return ["shard", "place", "id", "n_chars", "sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edge", "text"]


def _edge(shard: int, place: int, doc_id, text: str, edge: int, kind: pa.DataType) -> pa.RecordBatch:
    values = {"shard": pa.array([shard]), "place": pa.array([place]), "id": pa.array([doc_id], kind), "edge": pa.array([edge], pa.int32()),
              "text": pa.array([text], pa.string())}
    types = {"n_chars": pa.int64(), "near_edited": pa.float64(), "near_next": pa.float64()}
    return pa.record_batch([values[n] if n in values else pa.nulls(1, types.get(n, pa.binary())) for n in _names()], _names())


def _shard_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finished rows of a shard in order, but for its last document, whose follower another shard has: the first and the
    last document are given as edges (1 and 2)."""
    shard, place = TaskContext.get().partitionId(), 0
    held = None
    for batch in batches:
        kind = batch.column(0).type
        for row, part in text_slices(batch.column(1), _SLICE):
            ids, texts, prints = batch.column(0).slice(row, len(part)).to_pylist(), part.to_pylist(), fingerprints(part)
            if held is None:
                yield _edge(shard, 0, ids[0], texts[0], 1, kind)
            else:
                ids, texts, prints = [held[0], *ids], [held[1], *texts], np.concatenate([held[2], prints])
            if len(texts) > 1:
                yield _compared(ids, texts, prints, shard, place, kind)
            place += len(texts) - 1
            held = ids[-1], texts[-1], prints[-1:]
    if held is not None:
        yield _edge(shard, place, held[0], held[1], 2, kind)


def _last_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            shard, place, doc_id, text, follower = (batch.column(c)[i].as_py() for c in range(5))
            both = [text, follower]
            yield _compared([doc_id, None], both, fingerprints(pa.array(both, pa.large_string())), shard, place, batch.column(2).type)


def followed(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`<id_col>, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next` of every row.

    The next document is the one with the next smaller id; after the last comes the first, and a single one follows itself.
    Rows of one id go by their text's hash; null ids come last; null texts are empty. One shuffle, of the texts: shards of
    the descending order compare neighbours on their own, and one document at each end of a shard is compared afterwards.
    """
    tie = F.xxhash64("text")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    ordered = rows.repartitionByRange(F.col("id").desc(), tie).sortWithinPartitions(F.col("id").desc(), tie, "text")
    done = staged(ordered.mapInArrow(_shard_rows, _ROWS.format(id=kind)), "fingerprints")
    numbered = done.where("edge = 1").select("shard", F.col("text").alias("follower")).join(
        done.where("edge = 1").select("shard", (F.row_number().over(Window.orderBy("shard")) - 1).alias("number"),
                                      F.count("*").over(Window.partitionBy()).alias("shards")), "shard")
    lasts = done.where("edge = 2").select("shard", "place", "id", "text").join(numbered.select("shard", "number", "shards"), "shard") \
        .withColumn("next", (F.col("number") + 1) % F.col("shards"))
    met = lasts.join(numbered.select(F.col("number").alias("next"), "follower"), "next").select("shard", "place", "id", "text", "follower")
    every = done.where("edge = 0").unionByName(met.mapInArrow(_last_rows, _ROWS.format(id=kind)))
    return every.select(F.col("id").alias(id_col), "n_chars", F.lower(F.hex("sha256")).alias("edited_sha256"),
                        F.lower(F.hex("fingerprint")).alias("fingerprint"),
                        F.lower(F.hex("edited_fingerprint")).alias("edited_fingerprint"), "near_edited", "near_next")
