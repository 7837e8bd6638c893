"""Centroid clustering by a tournament of bisectors, in whole numbers.

Every component x becomes floor(scale * x). A vector's nearest centroid is found without any distance: for each pair of
centroids i < j the points nearer to j are those with normal . x > threshold, where normal = 2 (c_j - c_i) and threshold =
|c_j|**2 - |c_i|**2 are computed once, in whole numbers. The first centroid meets all others in turn; each of the k - 1 tests
eliminates one of two by its sign, and zero keeps the smaller number. Only the distance to the winner is computed.

Each round moves one row of sums per task and centroid, so the shuffle does not depend on how large a cluster is. The driver
holds the centroids and the normals of their pairs, k * k * dim numbers (MOST_NORMALS at most; larger settings raise). The
whole numbers of the kept vectors are staged once, so that a round that loses an executor repeats its own tasks only.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import staged

K, ROUNDS, DIM, SCALE, SEED = 16, 3, 64, 64, "1"
#: Numbers in the normals of all pairs, 64 MB.
MOST_NORMALS = 1 << 23


def largest(dim: int) -> int:
    """The greatest size of a component for which no distance or sign test leaves 64 bits."""
    return isqrt((1 << 59) // dim)


@dataclass(frozen=True)
class Bisectors:
    """The centroids with the normals and thresholds of their pairs."""

    centroids: np.ndarray
    normals: np.ndarray
    thresholds: np.ndarray

    @staticmethod
    def of(centroids: list[list[int]], dim: int) -> Bisectors:
        c = np.asarray(centroids, np.int64).reshape(len(centroids), dim)
        square = (c * c).sum(1)
        return Bisectors(c, 2 * (c[None, :, :] - c[:, None, :]), square[None, :] - square[:, None])

    def winners(self, x: np.ndarray) -> np.ndarray:
        """The nearest centroid of each row, the smaller number among equals."""
        best = np.zeros(len(x), np.int64)
        for j in range(1, len(self.centroids)):
            side = np.einsum("nd,nd->n", self.normals[best, j], x) - self.thresholds[best, j]
            best[side > 0] = j
        return best

    def distances(self, x: np.ndarray, best: np.ndarray) -> np.ndarray:
        apart = x - self.centroids[best]
        return np.einsum("nd,nd->n", apart, apart)


def _rows(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def _sums(bisectors: Bisectors, dim: int):
    """(cluster, sums of all components and the count) of one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(bisectors.centroids), dim + 1), np.int64)
        for batch in batches:
            x = _rows(batch.column(0), dim)
            best = bisectors.winners(x)
            for c in np.unique(best):
                mine = x[best == c]
                total[c, :dim] += mine.sum(0)
                total[c, dim] += len(mine)
        held = np.flatnonzero(total[:, dim])
        if len(held):
            yield pa.record_batch([pa.array(held, pa.int32()), pa.array(total[held].tolist(), pa.list_(pa.int64()))], ["cluster", "sums"])
    return run


def _assigned(bisectors: Bisectors, dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _rows(batch.column(1), dim)
            best = bisectors.winners(x)
            yield pa.record_batch([batch.column(0), pa.array(best, pa.int32()), pa.array(bisectors.distances(x, best))],
                                  ["id", "cluster", "distance"])
    return run


def whole_numbers(vectors: DataFrame, *, dim: int = DIM, scale: int = SCALE, id_col: str = "vec_id",
                  vector_col: str = "embedding") -> DataFrame:
    """`id, x`: the vectors of exactly `dim` components that are neither null nor non-finite, each component as
    floor(scale * x). Components beyond `largest(dim)`, whose distances no 64-bit column can hold, count as non-finite."""
    most = largest(dim) / scale
    good = F.forall(vector_col, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < most))
    x = F.transform(vector_col, lambda v: F.floor(v.cast("double") * scale).cast("int"))
    kept = (F.size(F.col(vector_col)) == dim) & good
    return vectors.where(kept).select(F.col(id_col).alias("id"), x.alias("x"))


@dataclass(frozen=True)
class Clustering:
    """`rows` has `id, cluster, distance` of each kept vector; `centroids` are the final ones by number."""

    rows: DataFrame
    centroids: list[list[int]]


def clustered(vectors: DataFrame, *, k: int = K, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: str = SEED,
              id_col: str = "vec_id", vector_col: str = "embedding") -> Clustering:
    """Cluster all vectors that `whole_numbers` keeps.

    Centroids start as the k kept vectors whose sha256 of `<seed>:<id>` is smallest, in that order (vectors of one id by their
    components, null ids last; fewer than k vectors give fewer centroids). Each round assigns all vectors and replaces every
    centroid that has any by the floor of the exact mean; then vectors are assigned once more. Repeated rows are vectors of
    their own. Without kept vectors there are no centroids and no rows. Other columns are not read.
    """
    if k * k * dim > MOST_NORMALS:
        raise ValueError(f"the normals of {k} centroids in {dim} dimensions exceed {MOST_NORMALS} numbers")
    spark = vectors.sparkSession
    numbers = staged(whole_numbers(vectors, dim=dim, scale=scale, id_col=id_col, vector_col=vector_col), "whole-numbers")
    named = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    first = numbers.select(named.alias("name"), "x").orderBy(F.col("name").asc_nulls_last(), "x").limit(k).collect()
    kind = numbers.schema["id"].dataType.simpleString()
    centroids = [list(row.x) for row in first]
    schema = f"id {kind}, cluster int, distance long"
    if not centroids:
        return Clustering(spark.createDataFrame([], schema), [])
    for _ in range(rounds):
        partial = numbers.select("x").mapInArrow(_sums(Bisectors.of(centroids, dim), dim), "cluster int, sums array<long>")
        found = partial.select("cluster", F.posexplode("sums").alias("place", "sum")).groupBy("cluster", "place").agg(F.sum("sum").alias("sum"))
        totals: dict[int, dict[int, int]] = {}
        for row in found.collect():  # k * (dim + 1) numbers at most
            totals.setdefault(row.cluster, {})[row.place] = row["sum"]
        for c, sums in totals.items():
            centroids[c] = [sums[d] // sums[dim] for d in range(dim)]
    return Clustering(staged(numbers.mapInArrow(_assigned(Bisectors.of(centroids, dim), dim), schema), "clusters"), centroids)
