"""Benchmark decontamination by greedy string tiling.

Words are runs of letters and digits, A-Z as a-z, so that neither marks nor spaces hide a passage. Seeds are MINIMUM words in a row.

1. A map of fixed size of the benchmark's seeds is broadcast; each text gives up only the stretches of words in which
   every seed is in the map. Other texts, nearly all of them, are never moved. Equal texts are one from here on.
2. Seeds of these stretches meet the benchmark's seeds in a join. A covering text shares at least one seed for every
   MINIMUM words that must be covered, so as many less one of an item's most common seeds need not be joined on.
3. Each pair of text and item is tiled: running Karp-Rabin hashes of MINIMUM words find all maximal common stretches; the
   longest that is still unmarked on both sides is marked, again and again. Passages in another order are so found in full.
4. An item whose words are covered by THRESHOLD or more contaminates the text.

Items of fewer than MINIMUM words are no evidence and are never found.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import in_map, key_map, staged
from .words import MARKS, find_words, shingle_hashes, slices

MINIMUM, THRESHOLD = 5, 0.5


def tiles(item: np.ndarray, text: np.ndarray, minimum: int = MINIMUM) -> list[tuple[int, int, int]]:
    """(place in item, place in text, length) of the tiles, the longest first; ties go to the first place in the item,
    then in the text. Negative words match nothing."""
    if len(item) < minimum or len(text) < minimum:
        return []
    def windows(words: np.ndarray) -> np.ndarray:
        return shingle_hashes(words.astype(np.uint64), np.asarray([0, len(words)]), minimum)[0]

    at: dict[int, list[int]] = {}
    for j, h in enumerate(windows(text).tolist()):
        at.setdefault(h, []).append(j)
    a, b = item.tolist(), text.tolist()
    found: list[tuple[int, int, int]] = []
    for i, h in enumerate(windows(item).tolist()):
        for j in at.get(h, ()):
            if i and j and a[i - 1] == b[j - 1] >= 0:
                continue  # part of a longer one
            n = 0
            while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] >= 0:
                n += 1
            if n >= minimum:
                found.append((-n, i, j))
    heapq.heapify(found)
    in_item, in_text = np.zeros(len(a), bool), np.zeros(len(b), bool)
    marked = []
    while found:
        n, i, j = heapq.heappop(found)
        n = -n
        free = ~(in_item[i:i + n] | in_text[j:j + n])
        if free.all():
            in_item[i:i + n] = in_text[j:j + n] = True
            marked.append((i, j, n))
            continue
        edges = np.flatnonzero(np.diff(np.concatenate(([False], free, [False]))))
        for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
            if end - start >= minimum:
                heapq.heappush(found, (start - end, i + start, j + start))
    return marked


def _words(data: np.ndarray, at: np.ndarray):
    words = find_words(data, at, between=MARKS)
    return words, (words.hashes(lower=True) >> np.uint64(1)).view(np.int64)  # never negative


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, to, data, at in slices(batch.column(1)):
            words, hashes = _words(data, at)
            lists = pa.ListArray.from_arrays(pa.array(words.first.astype(np.int32)), pa.array(hashes))
            seeds, first = shingle_hashes(hashes.view(np.uint64), words.first, MINIMUM)
            seed_lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(seeds.view(np.int64)))
            yield pa.record_batch([batch.column(0).slice(row, to - row), lists, seed_lists], ["item_id", "words", "seeds"])


def _stretches(seeds_map: bytes):
    """`key, runs, seeds` of each text with a seed in the map: its stretches, -1 between them, and their seeds."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, to, data, at in slices(batch.column(1)):
                words, hashes = _words(data, at)
                seeds, first = shingle_hashes(hashes.view(np.uint64), words.first, MINIMUM)
                hit = in_map(seeds_map, seeds)
                hits = np.concatenate(([0], np.cumsum(hit)))
                keys, runs, held = [], [], []
                for i in np.flatnonzero((hits[first[1:]] > hits[first[:-1]]) & (words.counts >= MINIMUM)).tolist():
                    own = hit[first[i]:first[i + 1]]
                    places = np.flatnonzero(own)
                    inside = np.zeros(int(words.counts[i]), bool)
                    for k in range(MINIMUM):
                        inside[places + k] = True
                    text = np.where(inside, hashes[words.first[i]:words.first[i + 1]], -1)
                    keys.append(batch.column(0)[row + i].as_py())
                    runs.append(text[inside | np.concatenate(([False], inside[:-1]))])
                    held.append(np.unique(seeds[first[i]:first[i + 1]][own]).view(np.int64))
                if keys:
                    yield pa.record_batch([pa.array(keys), pa.array(runs, pa.list_(pa.int64())), pa.array(held, pa.list_(pa.int64()))],
                                          ["key", "runs", "seeds"])
    return run


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        covered, number = [], []
        for words, runs in zip(batch.column("words"), batch.column("runs")):
            marked = tiles(np.asarray(words.values), np.asarray(runs.values))
            covered.append(sum(n for _, _, n in marked))
            number.append(len(marked))
        yield pa.record_batch([batch.column("key"), batch.column("item_id"), pa.array(covered, pa.int64()),
                               pa.array(number, pa.int64()), pa.array([len(w.values) for w in batch.column("words")], pa.int64())],
                              ["key", "item_id", "covered", "n_tiles", "n_words"])


def text_key(text_col: str = "text"):
    """What stands for a text: equal texts are judged once."""
    return F.md5(F.coalesce(F.col(text_col), F.lit("")))


def matches(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text", item_col: str = "item_id",
            item_text_col: str = "text") -> DataFrame:
    """`key, item_id, covered, n_tiles, n_words, coverage` of each text (`text_key`) and each item that it covers by
    THRESHOLD or more. Null and empty texts and items match nothing; repeated items count once by id, and items with one
    id and different texts are one each."""
    raw = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("text")).distinct()
    kind = raw.schema["item_id"].dataType.simpleString()
    items = staged(raw.mapInArrow(_item_words, f"item_id {kind}, words array<long>, seeds array<long>")
                   .where(F.size("words") >= MINIMUM).withColumn("item", F.xxhash64("item_id", "words")), "items")
    # Items that repeat a seed are joined on all of theirs.
    needed = F.when(F.size(F.array_distinct("seeds")) == F.size("seeds"), F.ceil(F.ceil(F.size("words") * THRESHOLD) / MINIMUM)) \
        .otherwise(1)
    seeds = items.select("item", (F.size(F.array_distinct("seeds")) - needed + 1).alias("rarest"),
                         F.explode(F.array_distinct("seeds")).alias("seed"))
    common = seeds.groupBy("seed").agg(F.count("*").alias("df"))
    order = Window.partitionBy("item").orderBy("df", "seed")
    index = staged(seeds.join(common, "seed").withColumn("rank", F.row_number().over(order)), "seeds")
    joined_on = index.where("rank <= rarest")
    found = staged(docs.select(text_key(text_col).alias("key"), F.col(text_col).alias("text")).mapInArrow(
        _stretches(key_map(index, "seed")), "key string, runs array<long>, seeds array<long>").dropDuplicates(["key"]), "stretches")
    pairs = found.select("key", F.explode("seeds").alias("seed")).join(joined_on.select("seed", "item"), "seed") \
        .select("key", "item").distinct()
    tiled = pairs.join(found.select("key", "runs"), "key").join(items.select("item", "item_id", "words"), "item") \
        .select("key", "item_id", "words", "runs").mapInArrow(
            _tiled, f"key string, item_id {kind}, covered long, n_tiles long, n_words long")
    return tiled.withColumn("coverage", F.col("covered") / F.col("n_words")).where(F.col("coverage") >= THRESHOLD)


def contamination(docs: DataFrame, benchmark: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`<id_col>, contaminated, n_items, item_id, coverage` of every row: how many items its text covers, the one it covers
    most (the least id among equals, null if none) and how far."""
    best = matches(docs, benchmark, text_col=text_col).groupBy("key").agg(
        F.count("*").alias("n_items"), F.min(F.struct((-F.col("coverage")).alias("c"), "item_id")).alias("best"))
    rows = docs.select(F.col(id_col).alias("_id"), text_key(text_col).alias("key")).join(best, "key", "left")
    return rows.select(F.col("_id").alias(id_col), F.col("n_items").isNotNull().alias("contaminated"),
                       F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"), F.col("best.item_id").alias("item_id"),
                       F.coalesce(-F.col("best.c"), F.lit(0.0)).alias("coverage"))


def decontaminated(docs: DataFrame, benchmark: DataFrame, *, text_col: str = "text") -> DataFrame:
    """The rows of `docs` whose text covers no item."""
    flagged = staged(matches(docs, benchmark, text_col=text_col).select("key").distinct(), "flagged")
    return docs.join(flagged, text_key(text_col) == flagged["key"], "left_anti")
