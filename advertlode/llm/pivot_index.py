"""Near-duplicate vectors by a pivot-permutation index.

1. Vectors that are equal and have the same label are one class (a 128-bit digest), so exact copies, however many, cost one row.
2. Reference points (pivots) come from a sample of the classes of least hash, SAMPLE at most, which is the index's only
   bounded part: those that are near an earlier one are left out, so that a group of near copies gives one, and seeded random
   directions fill the rest up to PIVOTS. Every class is described by its NEAREST pivots in order of nearness.
3. An inverted list holds the classes of one label that have two given pivots among their first KEYED ones. Members of a
   list whose descriptions share at least SHARED pivots are candidates, and these are verified by their cosine.
   A pair meets in several lists; only the list of the two smallest pivots that both have there counts it.
4. A list of more than PART classes is dealt into parts, and every two parts meet in a block of their own, so that no task
   holds more than two of them. A task gives back, for each class in it, the number of vectors linked with it and one member of
   its linked neighbourhood, never pairs: the output grows with the lists, while the comparisons within a group of near
   copies, all of which count, take matrix products.

Missed links: two vectors of cosine 0.98 in 64 dimensions fail to share two of their six first pivots of 512, or five of their
twelve, with a probability of 0.0004 (20,000 random pairs; less for nearer ones). `tests/llm` measures the recall against brute force.

What moves: one narrow row per class and list, KEYED * (KEYED - 1) / 2 of them, and vectors only for lists that
at least two classes share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import components, staged

PIVOTS, SAMPLE, NEAREST, KEYED, SHARED = 512, 2048, 12, 6, 5
#: Pivots more alike than this count as one.
_THIN = 0.8
#: Classes of a list in one part.
PART = 2048
#: Lists up to this size are compared pair by pair, many lists at once; larger ones in tiles of this many rows.
_SMALL, _TILE, _PAIRS = 64, 512, 1 << 16

_KEYS = ["label", "dim", "pair", "low", "high"]


def _vectors(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, vectors) of the rows of each length; null rows and empty vectors are left out, null components are NaN."""
    column = column.cast(pa.list_(pa.float64()))
    flat = column.flatten().to_numpy(zero_copy_only=False)
    size = column.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    at = np.cumsum(size) - size
    for dim in np.unique(size[size > 0]):
        rows = np.flatnonzero(size == dim)
        yield rows, flat[at[rows][:, None] + np.arange(dim)]


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows of length 1; scaled first, so that no square leaves the range of doubles."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("nd,nd->n", x, x))[:, None]


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The class of each row; none for vectors that link with nothing."""
    for batch in batches:
        nodes: list[bytes | None] = [None] * batch.num_rows
        labels = batch.column("label").to_pylist()
        for rows, x in _vectors(batch.column("vector")):
            good = np.isfinite(x).all(1) & (x != 0).any(1)
            x = x + 0.0  # one zero
            for row, v in zip(rows[good].tolist(), x[good]):
                if labels[row] is not None:
                    nodes[row] = hashlib.blake2b(v.tobytes() + labels[row].encode(), digest_size=16).digest()
        yield pa.record_batch([batch.column("id"), pa.array(nodes, pa.binary()), batch.column("label"), batch.column("vector")],
                              ["id", "node", "label", "vector"])


def chosen_pivots(sample: list[np.ndarray], pivots: int) -> dict[int, np.ndarray]:
    """For each number of dimensions in the sample, unit vectors in its order that are not near an earlier one."""
    out: dict[int, list[np.ndarray]] = {}
    for v in sample:
        held, u = out.setdefault(len(v), []), _unit(v[None, :])[0]
        if len(held) < pivots and (not held or (np.stack(held) @ u).max() < _THIN):
            held.append(u)
    return {dim: np.stack(held) for dim, held in out.items()}


def _filled(chosen: dict[int, np.ndarray], dim: int, pivots: int) -> np.ndarray:
    """The pivots of one number of dimensions, random directions after the chosen ones."""
    held = chosen.get(dim, np.empty((0, dim)))
    more = np.random.default_rng(dim).standard_normal((pivots, dim))
    return np.concatenate([held, _unit(more)])[:pivots]


def _described(chosen: dict[int, np.ndarray], pivots: int):
    """(node, label, dim, near) of each class; near holds its nearest pivots, the nearest first."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filled: dict[int, np.ndarray] = {}
        for batch in batches:
            near = np.zeros((batch.num_rows, NEAREST), np.int16)
            dims = np.zeros(batch.num_rows, np.int32)
            for rows, x in _vectors(batch.column("vector")):
                dim = x.shape[1]
                if dim not in filled:
                    filled[dim] = _filled(chosen, dim, pivots)
                for part in np.array_split(np.arange(len(rows)), len(rows) // 4096 + 1):
                    cosine = _unit(x[part]) @ filled[dim].T
                    best = np.sort(np.argpartition(-cosine, NEAREST - 1, axis=1)[:, :NEAREST], axis=1)
                    order = np.argsort(-np.take_along_axis(cosine, best, 1), axis=1, kind="stable")
                    near[rows[part]] = np.take_along_axis(best, order, 1)
                dims[rows] = dim
            lists = pa.ListArray.from_arrays(pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * NEAREST), pa.array(near.reshape(-1)))
            yield pa.record_batch([batch.column("node"), batch.column("label"), pa.array(dims), lists], ["node", "label", "dim", "near"])
    return run


def _union(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Let linked rows have the least row reachable as their label."""
    while True:
        one, two = label[a], label[b]
        apart = one != two
        if not apart.any():
            return
        a, b, one, two = a[apart], b[apart], one[apart], two[apart]
        np.minimum.at(label, np.maximum(one, two), np.minimum(one, two))
        while True:
            higher = label[label]
            if np.array_equal(higher, label):
                break
            label[:] = higher


class _Lists:
    """Rows of whole lists or blocks of one number of dimensions, in order."""

    def __init__(self, table: pa.Table, x: np.ndarray, starts: np.ndarray, pivots: int, least: float):
        self.unit, self.least = _unit(x), least
        self.near = np.asarray(table["near"].combine_chunks().flatten()).reshape(-1, NEAREST)
        self.keyed = np.sort(self.near[:, :KEYED], axis=1)
        self.times = np.asarray(table["times"])
        self.pair = np.asarray(table["pair"])
        self.part = np.asarray(table["part"])
        self.cross = np.asarray(table["low"]) != np.asarray(table["high"])
        self.starts, self.ends = starts, np.append(starts[1:], len(x))
        self.pivots = pivots
        self.links = np.zeros(len(x), np.int64)
        self.label = np.arange(len(x))

    def _verified(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.einsum("nd,nd->n", self.unit[a], self.unit[b]) >= self.least

    def _take(self, a: np.ndarray, b: np.ndarray) -> None:
        """Linked rows: count those whose list is the pair's own, connect all."""
        both = (self.keyed[a][:, :, None] == self.keyed[b][:, None, :]).any(2)
        place = np.argmax(both, axis=1)
        both[np.arange(len(a)), place] = False
        low, high = (np.take_along_axis(self.keyed[a], p[:, None], 1)[:, 0].astype(np.int64) for p in (place, np.argmax(both, axis=1)))
        own = low * self.pivots + high == self.pair[a]
        for one, two in ((a[own], b[own]), (b[own], a[own])):
            np.add.at(self.links, one, self.times[two])
        _union(self.label, a, b)

    def _small(self, rows: np.ndarray, end: np.ndarray) -> None:
        """Pairs of each row with the later rows of its list."""
        after = end - rows - 1
        until = np.cumsum(after)
        begin = 0
        while begin < len(rows):
            to = max(begin + 1, int(np.searchsorted(until, (until[begin - 1] if begin else 0) + _PAIRS, "right")))
            many = after[begin:to]
            a = np.repeat(rows[begin:to], many)
            b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(many) - many, many)
            meet = ~self.cross[a] | (self.part[a] != self.part[b])
            a, b = a[meet], b[meet]
            shared = (self.near[a][:, :, None] == self.near[b][:, None, :]).any(2).sum(1)
            a, b = a[shared >= SHARED], b[shared >= SHARED]
            linked = self._verified(a, b)
            self._take(a[linked], b[linked])
            begin = to

    def _large(self, start: int, end: int) -> None:
        """Tiles of one list."""
        words = np.zeros((end - start, -(-self.pivots // 64)), np.uint64)
        for k in range(NEAREST):
            pivot = self.near[start:end, k].astype(np.int64)
            words[np.arange(end - start), pivot >> 6] |= np.uint64(1) << (pivot & 63).astype(np.uint64)
        for i in range(start, end, _TILE):
            to = min(i + _TILE, end)
            for j in range(i, end, _TILE):
                stop = min(j + _TILE, end)
                shared = np.zeros((to - i, stop - j), np.int16)
                for w in range(words.shape[1]):
                    shared += np.bitwise_count(words[i - start:to - start, w][:, None] & words[j - start:stop - start, w][None, :])
                near = shared >= SHARED
                if self.cross[start]:
                    near &= self.part[i:to][:, None] != self.part[j:stop][None, :]
                if i == j:
                    near &= np.arange(i, to)[:, None] < np.arange(j, stop)[None, :]
                if near.any():
                    near &= self.unit[i:to] @ self.unit[j:stop].T >= self.least
                    a, b = np.nonzero(near)
                    for cut in range(0, len(a), _PAIRS):
                        self._take(a[cut:cut + _PAIRS] + i, b[cut:cut + _PAIRS] + j)

    def compared(self) -> None:
        size = self.ends - self.starts
        small = np.flatnonzero(size <= _SMALL)
        rows = np.repeat(self.starts[small] - np.cumsum(size[small]) + size[small], size[small]) + np.arange(size[small].sum())
        self._small(rows, np.repeat(self.ends[small], size[small]))
        for k in np.flatnonzero(size > _SMALL).tolist():
            self._large(int(self.starts[k]), int(self.ends[k]))


def _linked(pivots: int, least: float):
    """(node, links, other) of the classes that have links in the lists of a task: vectors linked in lists that count them,
    and a class of the same component."""
    def found(table: pa.Table) -> Iterator[pa.RecordBatch]:
        starts = _starts(table)
        nodes, dims = table["node"].combine_chunks(), np.asarray(table["dim"])
        for rows, x in _vectors(table["vector"].combine_chunks()):
            # Lists have one number of dimensions each, so their rows stay together.
            part = table.take(pa.array(rows)) if len(rows) < len(dims) else table
            lists = _Lists(part, x, np.searchsorted(rows, starts[dims[starts] == x.shape[1]]), pivots, least)
            lists.compared()
            held = np.flatnonzero(np.bincount(lists.label, minlength=len(x))[lists.label] > 1)
            yield pa.record_batch([nodes.take(pa.array(rows[held])), pa.array(lists.links[held]), nodes.take(pa.array(rows[lists.label[held]]))],
                                  ["node", "links", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table]).combine_chunks()
            last = int(_starts(held)[-1]) if held.num_rows else 0
            if last:
                yield from found(held.slice(0, last))
                held = held.slice(last)
        if held is not None and held.num_rows:
            yield from found(held)
    return run


def _starts(table: pa.Table) -> np.ndarray:
    """The first row of each list."""
    new = np.ones(table.num_rows, bool)
    new[1:] = False
    for name in _KEYS:
        column = table[name].combine_chunks()
        values = np.asarray(column.dictionary_encode().indices if name == "label" else column)
        new[1:] |= values[1:] != values[:-1]
    return np.flatnonzero(new)


def _links(classes: DataFrame, least: float, pivots: int) -> DataFrame:
    """`node, links, other`, a row or more for each class that has links (see `_linked`)."""
    sample = classes.select("vector").orderBy(F.xxhash64("vector"), "node").limit(SAMPLE).toArrow()
    chosen = chosen_pivots([np.asarray(v.as_py(), np.float64) for v in sample["vector"]], pivots)
    described = staged(classes.select("node", "label", "vector").mapInArrow(
        _described(chosen, pivots), "node binary, label string, dim int, near array<smallint>"), "descriptions")

    def key(a: int, b: int):
        one, two = (F.col("near")[k].cast("int") for k in (a, b))
        return F.least(one, two) * pivots + F.greatest(one, two)

    postings = described.select("node", "label", "dim", "near", F.explode(F.array(*[key(a, b) for a, b in combinations(range(KEYED), 2)])).alias("pair"))
    lists = postings.groupBy("label", "dim", "pair").agg(F.count("*").alias("size")).where("size > 1").select(
        "label", "dim", "pair", F.ceil(F.col("size") / PART).cast("int").alias("parts"))
    dealt = postings.join(lists, ["label", "dim", "pair"]).withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int")) \
        .withColumn("met", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    blocks = dealt.select("node", "label", "dim", "pair", "near", "part", F.least("part", "met").alias("low"), F.greatest("part", "met").alias("high"))
    rows = blocks.join(classes.select("node", "vector", "times"), "node").repartition(*_KEYS).sortWithinPartitions(*_KEYS)
    return rows.mapInArrow(_linked(pivots, least), "node binary, links long, other binary")


def near_vectors(vectors: DataFrame, *, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 pivots: int = PIVOTS) -> DataFrame:
    """`<id_col>, n_links, component_id, kept` of every row.

    Rows whose labels are equal and not null are linked if the index finds them and the cosine of their vectors, in double
    precision, is at least `least`. Vectors that are null, empty or zero, or hold a null or non-finite component, link with
    nothing, and vectors of unlike lengths not with each other. `n_links` counts the other rows linked directly, repeated
    rows each; `component_id` is the smallest id reachable, its own included, and `kept` marks its rows. Rows that
    repeat an id are rows of their own; a null id takes part in no minimum. Other columns are not read.
    """
    if not NEAREST <= pivots < 1 << 15:
        raise ValueError(f"between {NEAREST} and {(1 << 15) - 1} pivots")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).alias("vector"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    signed = rows.mapInArrow(_signed, f"id {kinds['id']}, node binary, label string, vector {kinds['vector']}")
    classes = staged(signed.where("node IS NOT NULL").groupBy("node").agg(
        F.first("label").alias("label"), F.first("vector").alias("vector"), F.count("*").alias("times"), F.min("id").alias("least")), "classes")
    links = staged(_links(classes, least, pivots), "links")
    belongs = staged(components(links.select(F.col("node").alias("a"), F.col("other").alias("b"))), "components")
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    known = classes.select("node", "times", "least").join(counts, "node", "left").join(belongs, "node", "left") \
        .withColumn("component", F.coalesce("component", "node"))
    smallest = known.groupBy("component").agg(F.min("least").alias("component_id"))
    named = known.join(smallest, "component").select("node", "component_id", (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    both = signed.select("id", "node").join(named, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return both.select(F.col("id").alias(id_col), F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), own.alias("component_id"),
                       F.coalesce(F.col("id") == own, F.lit(False)).alias("kept"))
