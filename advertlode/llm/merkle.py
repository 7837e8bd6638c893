"""Merkle fixity audit of WARC files.

The leaves of a file's tree are the hashes of its records, at their offsets. A node stands for a range of offsets: RANGE
bytes at the lowest level, FAN times as many at each level above, the whole file at the root. Its hash covers its
children in order with their places. Replicas are compared at the root; only children of nodes that differ are looked at
further, down to the records. Nodes are rows: a level is one aggregation of the level below, with at most FAN children
(or the records that begin in RANGE bytes) in a group, and a step down is a join on the nodes that differ.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import staged

RANGE, FAN = 1 << 16, 16


def warc_record(page_id: Column, url: Column, html: Column) -> Column:
    """A page as the bytes of a WARC response record; null counts as empty."""
    body = F.coalesce(html, F.lit(""))
    head = F.concat(F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")),
                    F.lit(">\r\nWARC-Target-URI: "), F.coalesce(url, F.lit("")), F.lit("\r\nContent-Length: "),
                    F.octet_length(body).cast("string"), F.lit("\r\n\r\n"))
    return F.concat(head, body, F.lit("\r\n\r\n"))


def leaves(records: DataFrame, *, file_col: str = "file", order_col: str = "seq", record_col: str = "record",
           also: tuple[str, ...] = ()) -> DataFrame:
    """`file, seq, offset, length, hash`, and the columns `also`, of records that stand in their files in the order of `order_col`. Only lengths
    and hashes are shuffled. Null records are empty; of records with one place, the one with the lesser hash is first."""
    record = F.coalesce(F.col(record_col), F.lit(""))
    rows = records.select(F.col(file_col).alias("file"), F.col(order_col).alias("seq"), F.octet_length(record).cast("long").alias("length"),
                          F.sha2(record.cast("binary"), 256).alias("hash"), *also)
    before = Window.partitionBy("file").orderBy("seq", "hash").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)))


def _node(children: str) -> Column:
    """One hash over children (place, hash) in order."""
    listed = F.transform(F.array_sort(F.collect_list(F.struct(F.col(children).alias("place"), "hash"))),
                         lambda x: F.concat_ws(" ", x["place"].cast("string"), x["hash"]))
    return F.sha2(F.array_join(listed, "\n"), 256)


def levels(rows: DataFrame, depth: int) -> list[DataFrame]:
    """The nodes `file, place, hash` of each level, from the ranges of RANGE bytes up to the root, `depth` levels."""
    out = [staged(rows.groupBy("file", F.floor(F.col("offset") / RANGE).alias("range")).agg(_node("offset").alias("hash"))
                  .withColumnRenamed("range", "place"), "level")]
    for _ in range(1, depth):
        above = out[-1].withColumn("above", F.floor(F.col("place") / FAN))
        out.append(staged(above.groupBy("file", "above").agg(_node("place").alias("hash")).withColumnRenamed("above", "place"), "level"))
    return out


def depth_for(longest: int) -> int:
    """Levels until one node spans a file of so many bytes."""
    depth = 1
    while RANGE * FAN ** (depth - 1) < longest:
        depth += 1
    return depth


def _differing(one: DataFrame, other: DataFrame) -> DataFrame:
    """`file, place` of nodes that differ or that one side lacks."""
    other = other.select(F.col("file").alias("file2"), F.col("place").alias("place2"), F.col("hash").alias("hash2"))
    both = one.join(other, F.col("file").eqNullSafe(F.col("file2")) & (F.col("place") == F.col("place2")), "full")
    return both.where(~F.col("hash").eqNullSafe(F.col("hash2"))).select(
        F.coalesce("file", "file2").alias("file"), F.coalesce("place", "place2").alias("place"))


def _below(nodes: DataFrame, marked: DataFrame, above: Column) -> DataFrame:
    """The nodes whose parent is marked."""
    marked = marked.select(F.col("file").alias("in_file"), F.col("place").alias("in_place"))
    return nodes.join(marked, F.col("file").eqNullSafe(F.col("in_file")) & (above == F.col("in_place")), "left_semi")


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """`file, offset, seq, length, kind` of the records in which two replicas (as `leaves` gives them) differ: `changed`,
    `missing` in the replica or `extra` there. Records are matched by file, offset and place in the order; equal rows on both sides are equal."""
    primary, replica = staged(primary, "primary"), staged(replica, "replica")
    longest = primary.unionByName(replica).agg(F.max(F.col("offset") + 1)).first()[0]
    depth = depth_for(longest or 1)
    one, other = levels(primary, depth), levels(replica, depth)
    marked = _differing(one[-1], other[-1])
    for level in reversed(range(depth - 1)):
        above = F.floor(F.col("place") / FAN)
        marked = staged(_differing(_below(one[level], marked, above), _below(other[level], marked, above)), "differing")
    within = F.floor(F.col("offset") / RANGE)
    names = ["file", "offset", "seq", "length", "hash"]
    left = _below(primary, marked, within).select(*names)
    right = _below(replica, marked, within).select(*[F.col(n).alias(f"r_{n}") for n in names])
    same = F.col("file").eqNullSafe(F.col("r_file")) & (F.col("offset") == F.col("r_offset")) & F.col("seq").eqNullSafe(F.col("r_seq"))
    kind = F.when(F.col("r_hash").isNull(), "missing").when(F.col("hash").isNull(), "extra").otherwise("changed")
    return left.join(right, same, "full").where(~F.col("hash").eqNullSafe(F.col("r_hash"))).select(
        *[F.coalesce(n, f"r_{n}").alias(n) for n in names[:4]], kind.alias("kind"))
