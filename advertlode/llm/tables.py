"""Staged tables, columns that do not clash, and components of a graph."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder of `spark.checkpoint.dir`. Only a session in one process may do without that
    setting, since there the driver's folder is every executor's folder."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.conf.get("spark.master", "").split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def fresh(df: DataFrame, *names: str) -> list[str]:
    """These names, each with as many underscores before it as no column of `df` has."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: later steps neither compute it again nor depend on the
    executors that did."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Bits of a map of keys, 2 MB at any size of the input. More keys only let more rows pass.
MAP_BITS = 1 << 24
_BITMAP = 32768  # bits in one row of Spark's bitmap functions


def key_map(keys: DataFrame, column: str) -> bytes:
    """A map with the bit `key % MAP_BITS` set for every non-null long in a column. At most MAP_BITS / 32768 rows of
    4 KB reach the driver."""
    place = keys.where(F.col(column).isNotNull()).select(F.pmod(column, F.lit(MAP_BITS)).alias("p"))
    rows = place.groupBy(F.floor(F.col("p") / _BITMAP).alias("bucket")).agg(
        F.bitmap_construct_agg(F.col("p") % _BITMAP).alias("bits")).collect()
    found = bytearray(MAP_BITS // 8)
    for row in rows:
        found[row.bucket * _BITMAP // 8:(row.bucket + 1) * _BITMAP // 8] = row.bits
    return bytes(found)


def in_map(found: bytes, keys: np.ndarray) -> np.ndarray:
    """Whether the bit of each key (64 bits, signed or not) is set."""
    place = keys.view(np.uint64) % np.uint64(MAP_BITS)
    bits = np.frombuffer(found, np.uint8)
    return (bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _are_stars(edges: DataFrame) -> bool:
    """Whether each node of `edges` (a, b: a > b) hangs on one other at most, and no node that hangs holds others: then
    every component is one star around its least node."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("hangs"), F.lit(0).alias("holds")).unionByName(
        edges.select(F.col("b").alias("node"), F.lit(0).alias("hangs"), F.lit(1).alias("holds")))
    nodes = ends.groupBy("node").agg(F.sum("hangs").alias("hangs"), F.max("holds").alias("holds"))
    return nodes.where("hangs > 1 OR hangs = 1 AND holds = 1").agg(F.count("*")).first()[0] == 0


def components(links: DataFrame, *, most_rounds: int = 60) -> DataFrame:
    """`node, component` of every node in `links` (a, b): the least node reachable.

    Alternating large and small stars: each round hangs a node's neighbours on the least of them. A node with very many
    links costs joins against one row per node, which Spark may split, and no list of neighbours is ever built. Every
    round is a staged table, so that a lost executor repeats one round at most. Ends when only stars are left; the number of rounds
    is about the logarithm of the longest chain.
    """
    def low(edges: DataFrame) -> DataFrame:
        return edges.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))

    edges = staged(links.where(F.col("a") != F.col("b")).select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    for _ in range(most_rounds):
        if _are_stars(edges):
            break
        # Large star: greater neighbours go to the least one.
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        large = both.join(low(both), "a").where(F.col("b") > F.col("a")).select(
            F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct()
        # Small star: lesser neighbours, and the node itself, go to the least one.
        down = large
        least = low(down)
        small = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where(
            F.col("a") != F.col("b")).unionByName(least.select("a", F.col("m").alias("b")))
        edges = staged(small.distinct(), "stars")
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component"))).distinct()
