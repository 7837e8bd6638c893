"""Mixing sources to target weights by balanced sampling with the cube method.

Every document of a source is to appear `rate` = target / size of the source times: its whole part for certain, the rest
with that probability. The cube method draws these last copies so that their number and their words come out as expected:
the flight moves the probabilities of three documents at a time along the null space of both constraints until one of
them is 0 or 1. It runs at once in blocks of at most about BLOCK documents of a source, dealt by hash, so that a large source is many
blocks. The LARGE largest of a block are decided first, moved against all others at once; three at a time a large one
would hardly move and be left for the end. Each block leaves two documents undecided at most; those of all blocks fly on
together, until a source is one block; its last two give up the count, then the last one is rounded. A source's words so
miss their target by half of one of its smaller documents.

Equal rows (id, source, size and text's hash) are one unit of `times` rows: floor(times * rate) copies are certain and one more is
drawn, so a unit misses its share by less than one copy, however often its row is repeated. The rows of a unit get equal
numbers of its copies, some one more than others.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import fresh, staged

BLOCK = 4_000
#: A source's target stops at so many times its size.
MOST = 3
WEIGHTS = (1, 2, 3)
WORDS = r"[^\x20\x09-\x0D]+"
LARGE = 64
_SURE = 1e-9


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORDS)), F.lit(0)).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """`source, source_size, target` from `source, source_size`: all sizes shared by weight, none above MOST times its own.

    Sources weigh 1, 2, 3, repeating, by code point, null last. With a common level, a source gets weight * level or its
    limit. Sources in ascending order of limit / weight reach their limits one after another, so the level follows from
    running sums. One row per source passes through one task.
    """
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (place % len(WEIGHTS) + 1).cast("int")).cast("double")
    rows = sizes.withColumn("weight", weight).withColumn("most", F.col("source_size").cast("double") * MOST)
    order = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    so_far, all_of = order.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy(F.lit(0))
    rows = rows.withColumn("total", F.sum(F.col("source_size").cast("double")).over(all_of)) \
        .withColumn("limits", F.sum("most").over(so_far)) \
        .withColumn("open", F.sum("weight").over(all_of) - F.sum("weight").over(so_far)) \
        .withColumn("before", F.col("limits") - F.col("most")).withColumn("own", F.col("open") + F.col("weight"))
    # The first source, in that order, whose limit is not reached sets the level for itself and all after it.
    level = F.min(F.when((F.col("total") - F.col("before")) / F.col("own") <= F.col("most") / F.col("weight"),
                         F.struct(F.col("most") / F.col("weight"), (F.col("total") - F.col("before")) / F.col("own")))).over(all_of)
    return rows.withColumn("level", level).select(
        "source", "source_size", F.coalesce(F.least("most", F.col("weight") * F.col("level.col2")), F.lit(0.0)).alias("target"))


def fly(chance: np.ndarray, size: np.ndarray, rng: np.random.Generator, *, last: bool) -> np.ndarray:
    """Move chances to 0 or 1, keeping their sum and their sum weighted by size; two are left, none if `last`."""
    chance, size = chance.astype(float).copy(), size.astype(float)
    _decide_large(chance, size, rng)
    left = [i for i in np.flatnonzero((chance > _SURE) & (chance < 1 - _SURE)).tolist()][::-1]
    draws, at = rng.random(len(left) + 3), 0
    p, s = chance.tolist(), size.tolist()
    held: list[int] = []
    while True:
        while len(held) < 3 and left:
            held.append(left.pop())
        if len(held) < 3:
            break
        i, j, k = held
        # Orthogonal to (1, 1, 1) and to the sizes.
        u = (s[j] - s[k], s[k] - s[i], s[i] - s[j])
        if u[0] == u[1] == 0:
            u = (1.0, -1.0, 0.0)
        _step(p, held, u, draws[at])
        at += 1
        held = [x for x in held if _SURE < p[x] < 1 - _SURE]
    if last and len(held) == 2:
        i, j = held
        u = (s[j], -s[i]) if s[i] or s[j] else (1.0, -1.0)
        _step(p, held, u, draws[at])
        held = [x for x in held if _SURE < p[x] < 1 - _SURE]
    if last:
        for x in held:
            p[x] = float(p[x] >= 0.5)
    out = np.asarray(p)
    out[out <= _SURE], out[out >= 1 - _SURE] = 0.0, 1.0
    return out


def _decide_large(chance: np.ndarray, size: np.ndarray, rng: np.random.Generator) -> None:
    """Decide the LARGE largest one after another. Against a step of the large one all others move by a + b * size, so that
    sum and weighted sum stay; whoever reaches 0 or 1 on the way is decided too."""
    for large in np.argsort(-size, kind="stable")[:LARGE]:
        while _SURE < chance[large] < 1 - _SURE:
            others = np.flatnonzero((chance > _SURE) & (chance < 1 - _SURE))
            others = others[others != large]
            s = size[others]
            n, total, squares = len(s), s.sum(), (s * s).sum()
            fixed = n * squares - total * total
            if n < 3 or fixed <= 1e-9 * n * squares:
                return
            a, b = (total * size[large] - squares) / fixed, (total - n * size[large]) / fixed
            u = np.append(a + b * s, 1.0)
            p = np.append(chance[others], chance[large])
            with np.errstate(divide="ignore"):
                room = np.where(u > 0, (1 - p) / u, np.where(u < 0, p / -u, np.inf))
                behind = np.where(u > 0, p / u, np.where(u < 0, (1 - p) / -u, np.inf))
            ahead, back = room.min(), behind.min()
            forward = rng.random() * (ahead + back) < back
            hit = np.argmin(room if forward else behind)
            p = np.clip(p + (ahead if forward else -back) * u, 0, 1)
            p[hit] = round(p[hit])
            chance[others], chance[large] = p[:-1], p[-1]


def _step(p: list[float], places: list[int], u: tuple[float, ...], draw: float) -> None:
    """Go along u as far as all chances stay within 0 and 1, forward or back so that the chances are met on average."""
    ahead = min((1 - p[x]) / d if d > 0 else p[x] / -d for x, d in zip(places, u) if d)
    back = min(p[x] / d if d > 0 else (1 - p[x]) / -d for x, d in zip(places, u) if d)
    move = ahead if draw * (ahead + back) < back else -back
    for x, d in zip(places, u):
        p[x] = min(1.0, max(0.0, p[x] + move * d))


def _flown(last: bool, seed: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["turn", "tie"], kind="stable")
        rng = np.random.default_rng(abs(int(rows["turn"].iloc[0])) + seed)
        return rows.assign(chance=fly(rows["chance"].to_numpy(), rows["weight"].to_numpy(), rng, last=last))
    return run


def copies(units: DataFrame, *, seed: int = 5) -> DataFrame:
    """`units` (source, size, turn, tie, times, rate) with the `copies` that the rows of each have together. `turn` orders the
    units at random."""
    share = F.col("rate") * F.col("times")
    rows = units.withColumn("weight", F.col("size").cast("double")).withColumn("sure", F.floor(share)).withColumn("chance", share - F.col("sure"))
    open_ = (F.col("chance") > _SURE) & (F.col("chance") < 1 - _SURE)
    done, rows = rows.where(~open_), rows.where(open_)
    level = 0
    while True:
        counts = rows.groupBy("source").agg(F.count("*").alias("n"))
        blocks = F.ceil(F.col("n") / BLOCK)
        most = counts.agg(F.max(blocks)).first()[0]
        last = most is None or most <= 1
        dealt = rows.join(counts, rows["source"].eqNullSafe(counts["source"])).drop(counts["source"]).withColumn(
            "block", F.pmod(F.xxhash64("turn", F.lit(level)), blocks)).drop("n") if not last else rows.withColumn("block", F.lit(0))
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
        flown = dealt.groupBy("source", "block").applyInPandas(_flown(last, seed + level), kinds).drop("block")
        if last:
            break
        flown = staged(flown, "flown")
        done = done.unionByName(flown.where(~open_))
        rows = flown.where(open_)
        level += 1
    return done.unionByName(flown).withColumn("copies", (F.col("sure") + F.round("chance")).cast("long")).drop("weight", "chance", "sure")


def mixed(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """`doc_id, source, hash, size, source_size, target, times, copies`: one row for each distinct (id, source, text) of
    `docs`, `times` it occurs, and how often these rows together appear in the mix. Null texts have size 0; null sources are a
    source. A document of size 0 appears as often as its source's rate says; a source without words not at all."""
    rows = staged(docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), F.xxhash64(text_col).alias("hash"),
                              word_count(F.col(text_col)).alias("size")).groupBy("doc_id", "source", "hash", "size").agg(
                                  F.count("*").alias("times")), "sizes")
    goals = staged(targets(rows.groupBy("source").agg(F.sum(F.col("size") * F.col("times")).alias("source_size"))), "targets")
    rate = F.when(F.col("source_size") > 0, F.least(F.lit(float(MOST)), F.col("target") / F.col("source_size"))).otherwise(0.0)
    units = rows.join(goals, rows["source"].eqNullSafe(goals["source"])).drop(goals["source"]).withColumn("rate", rate).withColumn(
        "turn", F.xxhash64("doc_id", "hash", F.lit(3))).withColumn("tie", F.col("hash"))
    return copies(units).drop("turn", "tie", "rate")


def own_copies(copies: Column, times: Column, number: Column) -> Column:
    """The copies that row `number`, from 1 on, of the `times` rows of a unit gets."""
    return (F.floor(copies / times) + F.when(number <= copies % times, 1).otherwise(0)).cast("int")


def mix(docs: DataFrame, *, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """The mix itself: each row of `docs` as often as it appears.

    Repeated rows are staged with the partition they lie in and numbered within it, so that no window holds more of them than
    one partition does. Which rows of one id, source and text get one copy more than the others depends on where they lie.
    """
    own_id, own_source, own_hash, often, times, copy, part, number, ahead, n = fresh(
        docs, "_id", "_source", "_hash", "_copies", "_times", "_copy", "_part", "_number", "_ahead", "_n")
    chosen = staged(mixed(docs, id_col=id_col, source_col=source_col, text_col=text_col).where("copies > 0").select(
        F.col("doc_id").alias(own_id), F.col("source").alias(own_source), F.col("hash").alias(own_hash), F.col("copies").alias(often),
        F.col("times").alias(times)), "chosen")

    def met(units: DataFrame) -> DataFrame:
        return docs.join(units, F.col(id_col).eqNullSafe(F.col(own_id)) & F.col(source_col).eqNullSafe(F.col(own_source))
                         & (F.xxhash64(F.col(text_col)) == F.col(own_hash)))

    once = met(chosen.where(F.col(times) == 1)).withColumn(copy, F.explode(F.sequence(F.lit(1).cast("long"), F.col(often)))).select(*docs.columns)
    more = chosen.where(F.col(times) > 1)
    if more.isEmpty():  # no second pass over the texts
        return once
    repeated = staged(met(more).withColumn(part, F.spark_partition_id()), "repeated")
    unit = [own_id, own_source, own_hash]
    before = Window.partitionBy(*unit).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = repeated.groupBy(*unit, part).agg(F.count("*").alias(n)).withColumn(ahead, F.coalesce(F.sum(n).over(before), F.lit(0))).select(
        *[F.col(c).alias(f"{c}_") for c in unit], F.col(part).alias(f"{part}_"), ahead)
    same = F.col(part) == F.col(f"{part}_")
    for c in unit:
        same = same & F.col(c).eqNullSafe(F.col(f"{c}_"))
    place = F.col(ahead) + F.row_number().over(Window.partitionBy(*unit, part).orderBy(F.xxhash64(*unit)))
    numbered = repeated.join(parts, same).withColumn(number, place).withColumn(often, own_copies(F.col(often), F.col(times), F.col(number)))
    shared = numbered.where(F.col(often) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(often))))
    return once.unionByName(shared.select(*docs.columns))
