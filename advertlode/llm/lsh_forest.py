"""Near-duplicate groups by an LSH forest.

1. Every text becomes the set of its word shingles. Equal sets are one class (a 128-bit digest), so exact copies, however
   many, cost one row from here on.
2. Each class has TREES labels of DEPTH min-hash values of one byte. A tree is the order of all classes by one label;
   classes with a long common prefix stand side by side in it. Two sets of similarity s share their first d values in
   a tree with probability s**d.
3. A region is a prefix that at least two classes share, at MIN_DEPTH and below. Each region has a leader, the class whose
   whole labels agree with most others, and every class is a candidate with the leaders of its regions. The number of
   candidates thus grows with the classes, never with the pairs of a group.
4. Neighbours in the sorted orders are the next candidates. The depth adapts to the region: a class is sorted within
   the shortest prefix that at most REGION classes share, and whole labels shared by more are dealt at random into
   stretches of that size, anew in each tree. Only neighbours that are not connected yet go on to step 5, and each round
   takes the next neighbours, until a round connects nothing new. Neighbours whose
   parities prove them too different are left out: a member that only one of two sets has changes one of the
   PARITIES * 64 bits, so no more bits differ than members, and this loses no link.
5. Then the rest is complete. In regions at MIN_DEPTH of at most REGION classes all pairs that are not connected yet are
   candidates, unless their sizes or parities prove them too different. The classes of larger regions meet by their rarest shingles: sets that
   are similar enough share one of the first n - percent * n + 1 in any common order. A shingle's classes are dealt
   into parts, each of which meets all of them, so that none is one task's. These pairs can grow with the square of a
   group whose members are like each other but not linked; nothing is capped.
6. Candidates are confirmed on their full sets; linked classes form components.

Missed links: with 16 trees, a minimum depth of 4 and similarity 0.8, two classes fail to meet in any region
with probability (1 - 0.8**4)**16 = 0.0002; those of two large regions meet whatever their labels.
`tests/llm` measures the recall against brute force.

Confirmation compares 32-bit hashes of shingles with exact set sizes. Two different sets of a thousand shingles with 200
on either side alone gain a false common one with probability 200 * 200 / 2**32 = 0.00001, and that matters only exactly at the threshold.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .tables import components, fresh, in_map, key_map, staged
from .words import find_words, mix, shingle_hashes, slices

TREES, DEPTH, MIN_DEPTH = 16, 8, 4
#: Classes that are sorted together; larger regions are entered at a greater depth.
REGION = 256
#: Classes of one shingle that meet the others in one part of a join.
PART = 1024
#: Words of 64 parity bits for each class.
PARITIES = 8

_FACTORS = np.random.default_rng(97).integers(1, 1 << 31, TREES * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_OFFSETS = np.random.default_rng(98).integers(0, 1 << 32, TREES * DEPTH, dtype=np.uint32)


def shingle_sets(data: np.ndarray, at: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one after another, and where each text's begin."""
    words = find_words(data, at)
    every, first = shingle_hashes(words.hashes(lower=True), words.first, size)
    sets = []
    for i in range(len(first) - 1):
        one = np.sort(every[first[i]:first[i + 1]])
        sets.append(one[np.concatenate(([True], one[1:] != one[:-1]))] if len(one) else one)
    starts = np.zeros(len(sets) + 1, np.int64)
    np.cumsum([len(s) for s in sets], out=starts[1:])
    return np.concatenate(sets) if sets else every, starts


def _digests(members: np.ndarray, starts: np.ndarray) -> list[bytes | None]:
    """16 bytes for each set, None for the empty one."""
    full = np.flatnonzero(np.diff(starts))
    out: list[bytes | None] = [None] * (len(starts) - 1)
    if len(full):
        low = np.add.reduceat(mix(members), starts[full])
        high = np.add.reduceat(mix(members ^ np.uint64(0x5851F42D4C957F2D)), starts[full])
        raw = np.stack([mix(low + np.diff(starts)[full].astype(np.uint64)), mix(high)], 1).astype(">u8").tobytes()
        for k, i in enumerate(full):
            out[i] = raw[16 * k:16 * k + 16]
    return out


def labels(members: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """TREES labels of DEPTH one-byte min-hashes for each set that is not empty, the first value in the top byte."""
    full = np.flatnonzero(np.diff(starts))
    values = (members >> np.uint64(32)).astype(np.uint32)
    out = np.zeros((len(full), TREES), np.uint64)
    for j in range(TREES * DEPTH if len(full) else 0):
        least = np.minimum.reduceat(values * _FACTORS[j] + _OFFSETS[j], starts[full])
        byte = (mix(least.astype(np.uint64) + np.uint64(j)) >> np.uint64(56)) << np.uint64(8 * (DEPTH - 1 - j % DEPTH))
        out[:, j // DEPTH] |= byte
    return out.view(np.int64)


def parities(members: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """PARITIES words for each set that is not empty: a bit is set if an odd number of members fall on it."""
    full = np.flatnonzero(np.diff(starts))
    place = members % np.uint64(64 * PARITIES)
    bit = np.uint64(1) << (place & np.uint64(63))
    out = np.zeros((len(full), PARITIES), np.uint64)
    for j in range(PARITIES if len(full) else 0):
        out[:, j] = np.bitwise_xor.reduceat(np.where(place >> np.uint64(6) == j, bit, np.uint64(0)), starts[full])
    return out.view(np.int64)


def _signatures(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, to, data, at in slices(batch.column(1)):
                members, starts = shingle_sets(data, at, size)
                full = np.diff(starts) > 0
                before = np.concatenate(([0], np.cumsum(full))).astype(np.int32)
                trees, odd = (pa.ListArray.from_arrays(pa.array(before * np.int32(values.shape[1])), pa.array(values.reshape(-1)))
                              for values in (labels(members, starts), parities(members, starts)))
                yield pa.record_batch([batch.column(0).slice(row, to - row), pa.array(_digests(members, starts), pa.binary()),
                                       pa.array(np.diff(starts)), trees, odd], ["id", "node", "n", "labels", "odd"])
    return run


def _sets(size: int, wanted: bytes):
    """(node, members) of the classes in the map."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, at in slices(batch.column(0)):
                members, starts = shingle_sets(data, at, size)
                nodes = _digests(members, starts)
                keys = np.asarray([int.from_bytes(node[9:], "big") if node else 0 for node in nodes], np.int64)
                held = np.flatnonzero(in_map(wanted, keys) & (np.diff(starts) > 0)).tolist()
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(np.diff(starts)[held]))).astype(np.int32)),
                    pa.array(np.concatenate([np.empty(0, np.int32)] + [
                        (members[starts[i]:starts[i + 1]] >> np.uint64(16)).astype(np.uint32).view(np.int32) for i in held])))
                yield pa.record_batch([pa.array([nodes[i] for i in held], pa.binary()), lists], ["node", "members"])
    return run


def _key(node: Column) -> Column:
    """The last seven bytes of a class's digest as a number, its key in the map."""
    return F.conv(F.hex(F.substring(node, 10, 7)), 16, 10).cast("long")


def _prefix(depth: int) -> Column:
    return F.shiftrightunsigned("label", 8 * (DEPTH - depth))


def _regions(rows: DataFrame, *columns: str, depths: Iterable[int]) -> DataFrame:
    """`tree, depth, prefix` of the regions of each row at `depths`, and these columns."""
    at = F.explode(F.array(*[F.struct(F.lit(d).alias("depth"), _prefix(d).alias("prefix")) for d in depths]))
    return rows.select("tree", *columns, at.alias("at")).select("tree", *columns, "at.depth", "at.prefix")


def _pairs(rows: DataFrame, left: str, right: str) -> DataFrame:
    return rows.where(F.col(left) != F.col(right)).select(
        F.greatest(left, right).alias("a"), F.least(left, right).alias("b")).distinct()


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union. The second join's key may be one leader of very many: its
    side is one row per key, so Spark splits the rest freely."""
    one = sets.select(F.col("node").alias("a"), F.col("members").alias("ma"))
    two = sets.select(F.col("node").alias("b"), F.col("members").alias("mb"))
    both = pairs.join(one, "a").join(two, "b")
    common = F.size(F.array_intersect("ma", "mb")).cast("long")
    union = F.size("ma").cast("long") + F.size("mb") - F.col("common")
    return both.withColumn("common", common).where(100 * F.col("common") >= percent * union).select("a", "b")


def _leaders(live: DataFrame, runs: DataFrame) -> DataFrame:
    """Candidates (a, b) of every class with the leaders of its regions at MIN_DEPTH and at DEPTH."""
    agreeing = live.join(runs, ["tree", "label"]).groupBy("node").agg(F.sum(F.log1p("n")).alias("score"))
    region = ["tree", "depth", "prefix"]
    keyed = _regions(live.join(agreeing, "node"), "node", "score", depths=(MIN_DEPTH, DEPTH))
    lead = keyed.groupBy(*region).agg(F.max(F.struct("score", "node")).alias("top"), F.count("*").alias("n"))
    return _pairs(keyed.join(lead.where("n > 1").select(*region, F.col("top.node").alias("lead")), region), "node", "lead")


def _stretches(live: DataFrame, runs: DataFrame) -> DataFrame:
    """`live` with the stretch each row is sorted in: the shortest prefix that at most REGION classes share."""
    region = ["tree", "depth", "prefix"]
    keyed = _regions(runs, "label", "n", depths=range(MIN_DEPTH, DEPTH))
    large = keyed.groupBy(*region).agg(F.sum("n").alias("n")).where(F.col("n") > REGION).select(*region)
    # A region within a small one is small, so the depth is the number of large ones that a label is in.
    deep = keyed.join(large, region, "left_semi").groupBy("tree", "label", "n").agg((F.count("*") + MIN_DEPTH).cast("int").alias("below"))
    depth = F.coalesce("below", F.lit(MIN_DEPTH))
    deals = F.when(depth == DEPTH, F.ceil(F.col("n") / REGION)).otherwise(1)
    dealt = F.xxhash64("node", "tree")
    placed = live.join(deep, ["tree", "label"], "left").withColumn("depth", depth).withColumn("deals", deals)
    return placed.select(
        "tree", "label", "node", "depth", F.expr(f"shiftrightunsigned(label, cast(8 * ({DEPTH} - depth) as int))").alias("prefix"),
        F.pmod(dealt, "deals").alias("deal"), dealt.alias("turn"))


def _neighbours(rows: DataFrame, belongs: DataFrame, nearest: int, farthest: int, percent: int) -> DataFrame:
    """Candidates (a, b) that stand `nearest` to `farthest` places apart in a stretch and are not connected yet.

    With sizes of together S and D members in one set only, 100 * intersection >= percent * union says that
    (100 + percent) * D <= (100 - percent) * S, and parities differ in at most D bits.
    """
    held = rows.join(belongs, "node", "left").withColumn("component", F.coalesce("component", "node"))
    stretch = ["tree", "depth", "prefix", "deal"]
    mixed = held.groupBy(*stretch).agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low != high")
    order = Window.partitionBy(*stretch).orderBy("label", "turn", "node")

    def may_link(x):
        apart = F.zip_with("odd", x["odd"], lambda p, q: F.bit_count(p.bitwiseXOR(q)))
        bits = F.aggregate(apart, F.lit(0), lambda total, n: total + n)
        return (100 + percent) * bits <= (100 - percent) * (F.col("n") + x["n"])

    ahead = [F.lag(F.struct("node", "component", "n", "odd"), k).over(order) for k in range(nearest, farthest + 1)]
    near = F.filter(F.array(*ahead), lambda x: (x["component"] != F.col("component")) & may_link(x))
    contested = held.join(mixed.select(*stretch), stretch, "left_semi")
    return _pairs(contested.withColumn("near", near).select("node", F.explode("near.node").alias("other")), "node", "other")


def _meeting(left: DataFrame, right: DataFrame, keys: list[str], percent: int, *more: Column) -> DataFrame:
    """Candidates (a, b) of rows with the same keys that are not connected yet, unless sizes or parities rule them out."""
    one, two = (side.select(*keys, *[F.col(c).alias(f"{c}_{name}") for c in side.columns if c not in keys])
                for side, name in ((left, "a"), (right, "b")))
    total = F.col("n_a") + F.col("n_b")
    bits = sum((F.bit_count(F.col(f"odd{j}_a").bitwiseXOR(F.col(f"odd{j}_b"))) for j in range(PARITIES)), F.lit(0))
    met = one.join(two, keys).where((F.col("node_a") > F.col("node_b")) & (F.col("component_a") != F.col("component_b"))
                                    & (100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
                                    & ((100 + percent) * bits <= (100 - percent) * total))
    for condition in more:
        met = met.where(condition)
    return met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")).distinct()


def _remaining(live: DataFrame, classes: DataFrame, sets: DataFrame, belongs: DataFrame, percent: int) -> DataFrame:
    """Candidates (a, b) of all classes that share a region and are not connected yet."""
    held = classes.join(belongs, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "n", *[
        F.col("odd")[j].alias(f"odd{j}") for j in range(PARITIES)])
    region = ["tree", "prefix"]
    rows = live.select("tree", _prefix(MIN_DEPTH).alias("prefix"), "node").join(held, "node")
    open_ = staged(rows.groupBy(*region).agg(F.count("*").alias("size"), F.min("component").alias("low"), F.max("component").alias("high"))
                   .where("low != high").select(*region, "size"), "open")
    few = staged(rows.join(open_.where(F.col("size") <= REGION).drop("size"), region), "few")
    large = rows.join(open_.where(F.col("size") > REGION).drop("size"), region, "left_semi").select("node").distinct()
    # The rarest shingles of each class in large regions: as many as one that links it must be among.
    own = staged(held.join(large, "node").join(sets, "node").withColumn("members", F.array_distinct("members")), "large")
    every = own.select("node", "component", F.explode("members").alias("member"))
    common = every.groupBy("member").agg(F.count("*").alias("often"), (F.min("component") != F.max("component")).alias("open"))
    order = every.join(common, "member").groupBy("node").agg(F.array_sort(F.collect_list(F.struct("often", "member", "open"))).alias("order"))
    size = F.size("members")
    first = F.greatest(size - F.floor((percent * F.col("n") + 99) / 100).cast("int") + 1, F.lit(0))
    rarest = own.join(order, "node").withColumn("first", first).select(
        "node", "component", "n", *[f"odd{j}" for j in range(PARITIES)], size.alias("size"),
        F.posexplode(F.slice("order", F.lit(1), F.col("first"))).alias("place", "at")).where("at.open")
    rarest = staged(rarest.withColumn("member", F.col("at.member")).withColumn("after", F.col("size") - F.col("place")).drop("at", "size", "place"), "rarest")
    parts = rarest.groupBy("member").agg(F.ceil(F.count("*") / PART).alias("parts"), F.count("*").alias("classes")).where("classes > 1").drop("classes")
    dealt = rarest.join(parts, "member")
    left = dealt.withColumn("part", F.pmod(F.xxhash64("node", "member"), "parts")).drop("parts")
    right = dealt.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1))).drop("parts")
    # `after` members, this one included, are left in each set: no more can be common if this is the first.
    enough = (100 + percent) * F.least("after_a", "after_b") >= percent * (F.col("n_a") + F.col("n_b"))
    return _meeting(few, few, region, percent).unionByName(_meeting(left, right, ["member", "part"], percent, enough)).distinct()


def _grouped(texts: DataFrame, shingle: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The staged signatures of `texts` (id, text), and `node, component` of every class."""
    kind = texts.schema["id"].dataType.simpleString()
    signed = staged(texts.mapInArrow(_signatures(shingle), f"id {kind}, node binary, n long, labels array<long>, odd array<long>"), "signatures")
    belongs = _connected(texts, signed, shingle, percent)
    known = signed.where("node IS NOT NULL").groupBy("node").agg(F.min("id").alias("least"))
    return signed, known.join(belongs, "node", "left").withColumn("component", F.coalesce("component", "node"))


def near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 2,
                    percent: int = 80) -> DataFrame:
    """`<id_col>, n_shingles, component_id, kept` for every row of `docs`.

    Texts are linked if 100 * intersection >= percent * union of their sets of `shingle`-word shingles (A-Z as a-z);
    `component_id` is the smallest id reachable, `kept` marks its rows. Null and empty texts have no shingles and are
    linked with nothing: they are components of their own. Rows that repeat an id are nodes of their own, so that
    every row of the smallest id of a group is kept. A row without an id is linked as others are and takes part in no
    minimum: its `component_id` is null if no id is reachable, and it is not kept. Other columns are not read.
    """
    signed, known = _grouped(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), shingle, percent)
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    named = known.join(least, "component").select("node", "component_id")
    both = signed.join(named, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return both.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), own.alias("component_id"),
                       F.coalesce(F.col("id") == own, F.lit(False)).alias("kept"))


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near duplicates: that of the smallest id, null ids last, and of rows with that id the one
    whose text and other columns hash least; of rows that are equal in all columns one stays. Rows without shingles all stay.

    Rows are told apart by id and a hash of all columns, so that only these meet the groups in joins; the rows themselves
    are joined once with those that stay.
    """
    mark = F.xxhash64(*docs.columns)
    rows = docs.select(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), mark.alias("mark")).alias("id"),
                       F.col(text_col).alias("text"))
    signed, known = _grouped(rows, shingle, percent)
    least = known.groupBy("component").agg(F.min("least").alias("row")).select("row.id", "row.mark")
    empty = signed.where("node IS NULL").select("id.id", "id.mark").distinct()
    own_id, own_mark, every = fresh(docs, "_stay", "_mark", "_all")
    stay = staged(least.withColumn("all", F.lit(False)).unionByName(empty.withColumn("all", F.lit(True))), "stay") \
        .select(F.col("id").alias(own_id), F.col("mark").alias(own_mark), F.col("all").alias(every))
    met = docs.join(stay, F.col(id_col).eqNullSafe(F.col(own_id)) & (mark == F.col(own_mark)))
    once = met.where(~F.col(every)).dropDuplicates([own_id, own_mark])
    return met.where(F.col(every)).unionByName(once).select(*docs.columns)


def _joined(belongs: DataFrame, more: DataFrame) -> DataFrame:
    """`belongs` after further links: only the components that these touch are connected anew."""
    def named(side: str) -> DataFrame:
        return belongs.select(F.col("node").alias(side), F.col("component").alias(f"{side}_in"))

    between = more.join(named("a"), "a", "left").join(named("b"), "b", "left").select(
        F.coalesce("a_in", "a").alias("a"), F.coalesce("b_in", "b").alias("b"))
    moved = staged(components(between), "moved").select(F.col("node").alias("was"), F.col("component").alias("becomes"))
    nodes = more.select(F.col("a").alias("node")).unionByName(more.select(F.col("b").alias("node"))).distinct()
    alone = nodes.join(belongs, "node", "left_anti").select("node", F.col("node").alias("component"))
    return belongs.unionByName(alone).join(moved, F.col("component") == F.col("was"), "left").select(
        "node", F.coalesce("becomes", "component").alias("component"))


def _connected(texts: DataFrame, signed: DataFrame, shingle: int, percent: int) -> DataFrame:
    """`node, component` of the classes that are linked with others."""
    classes = staged(signed.where("node IS NOT NULL").groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "labels", "odd")]), "classes")
    rows = staged(classes.select("node", F.posexplode("labels").alias("tree", "label")), "trees")
    shared = rows.groupBy("tree", _prefix(MIN_DEPTH).alias("prefix")).count().where("count > 1")
    live = staged(rows.withColumn("prefix", _prefix(MIN_DEPTH)).join(shared, ["tree", "prefix"], "left_semi").drop("prefix"), "live")
    runs = staged(live.groupBy("tree", "label").agg(F.count("*").alias("n")), "runs")
    wanted = key_map(live.select(_key(F.col("node")).alias("key")), "key")
    sets = staged(texts.select("text").mapInArrow(_sets(shingle, wanted), "node binary, members array<int>")
                  .dropDuplicates(["node"]), "sets")
    tested = staged(_leaders(live, runs), "pairs")
    belongs = staged(components(_confirmed(tested, sets, percent)), "components")
    stretches = staged(_stretches(live, runs).join(classes.drop("labels"), "node"), "stretches")
    nearest, farthest = 1, 4
    while nearest < REGION:
        pairs = staged(_neighbours(stretches, belongs, nearest, farthest, percent).join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.unionByName(pairs)
        more = staged(_confirmed(pairs, sets, percent), "links")
        if more.isEmpty():
            break
        belongs = staged(_joined(belongs, more), "components")
        nearest, farthest = farthest + 1, min(REGION, 3 * farthest)
    rest = staged(_remaining(live, classes, sets, belongs, percent).join(tested, ["a", "b"], "left_anti"), "pairs")
    more = staged(_confirmed(rest, sets, percent), "links")
    return belongs if more.isEmpty() else staged(_joined(belongs, more), "components")
