"""Line dedup by distinct-site spread.

A line that many sites carry is boilerplate. Each line hash has a HyperLogLog sketch of the sites it occurs on; sketches
merge in the aggregation, before the shuffle too, so a line that is everywhere costs one sketch per task. Sketches decide
lines that are clearly below or above the threshold; lines within MARGIN of it are counted exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .string_tiling import text_key
from .tables import fresh, in_map, key_map, staged

#: Sites from which on a line is boilerplate; how far from it a sketch is believed, over ten times its standard error.
SITES, MARGIN, LG_K = 10, 0.25, 12


def _line(text: Column) -> Column:
    return F.explode(F.split(text, "\n", -1))


def _hash(line: Column) -> Column:
    return F.xxhash64(F.trim(line))


def site_lines(docs: DataFrame, site_col: str, text_col: str) -> DataFrame:
    """`site, line` (the hash) of every line that is not blank, on a known site."""
    lines = docs.select(F.col(site_col).cast("string").alias("site"), _line(F.col(text_col)).alias("line"))
    return lines.where(F.col("site").isNotNull() & (F.trim("line") != "")).select("site", _hash(F.col("line")).alias("line"))


def boilerplate(docs: DataFrame, *, site_col: str = "source", text_col: str = "text", sites: int = SITES) -> DataFrame:
    """`line, sites` of the hashes of lines on at least `sites` sites; `sites` is exact near the threshold, else estimated."""
    lines = site_lines(docs, site_col, text_col)
    spread = lines.groupBy("line").agg(F.hll_sketch_agg("site", LG_K).alias("sketch")).select(
        "line", F.hll_sketch_estimate("sketch").alias("sites"))
    wide = staged(spread.where(F.col("sites") >= sites * (1 - MARGIN)), "spread")
    near = wide.where(F.col("sites") <= sites * (1 + MARGIN)).select("line")
    exact = lines.join(near, "line", "left_semi").distinct().groupBy("line").agg(F.count("*").alias("sites"))
    return wide.where(F.col("sites") > sites * (1 + MARGIN)).unionByName(exact.where(F.col("sites") >= sites))


def _in_lines(wanted: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, places, found = [], [], []
            for key, text in zip(batch.column(0), batch.column(1)):
                lines = [x.strip(" ").encode() for x in (text.as_py() or "").split("\n")]
                hashes = np.fromiter((xxhash.xxh64_intdigest(x, 42) for x in lines), np.uint64, len(lines)).view(np.int64)
                hit = np.flatnonzero(in_map(wanted, hashes) & np.asarray([bool(x) for x in lines]))
                if len(hit):
                    keys += [key.as_py()] * len(hit)
                    places += hit.tolist()
                    found += hashes[hit].tolist()
            yield pa.record_batch([pa.array(keys, pa.string()), pa.array(places, pa.int32()), pa.array(found, pa.int64())],
                                  ["key", "place", "line"])
    return run


def without_boilerplate(docs: DataFrame, *, site_col: str = "source", text_col: str = "text", sites: int = SITES,
                        lines_col: str = "_lines", removed_col: str = "_removed") -> DataFrame:
    """`docs` without the lines that `sites` or more sites carry; two new columns count each text's lines and those removed.

    Lines are compared without the spaces at their ends; blank lines stay. Null texts stay null and have no lines, and a row
    without a site counts for no line but loses boilerplate as others do. Only places of lines and the keys of texts are
    shuffled before the last join, and the lines of one text share one row there.
    """
    if fresh(docs, lines_col, removed_col) != [lines_col, removed_col]:
        raise ValueError(f"{lines_col} or {removed_col} is a column already")
    key, cut_key, cuts = fresh(docs, "_key", "_cut_key", "_places")
    bad = staged(boilerplate(docs, site_col=site_col, text_col=text_col, sites=sites).select("line"), "boilerplate")
    keyed = docs.withColumn(key, text_key(text_col))
    places = keyed.select(F.col(key).alias("key"), F.col(text_col).alias("text")).mapInArrow(
        _in_lines(key_map(bad, "line")), "key string, place int, line long")
    cut = places.join(bad, "line", "left_semi").groupBy(F.col("key").alias(cut_key)).agg(F.collect_set("place").alias(cuts))
    met = keyed.join(cut, F.col(key) == F.col(cut_key), "left")
    lines = F.split(F.col(text_col), "\n", -1)
    kept = F.filter(lines, lambda x, i: ~F.array_contains(F.coalesce(cuts, F.array().cast("array<int>")), i))
    new = F.when(F.col(cuts).isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    return met.select(*[(new.alias(c) if c == text_col else F.col(c)) for c in docs.columns],
                      F.coalesce(F.size(lines), F.lit(0)).cast("long").alias(lines_col),
                      F.coalesce(F.size(cuts), F.lit(0)).cast("long").alias(removed_col))
