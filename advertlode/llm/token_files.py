"""Token files: the ids of all documents in order, compressed by a static range asymmetric numeral system.

A token file is a folder of Parquet files whose rows are segments: whole documents of about SEGMENT ids that follow each
other, one table of frequencies, and the independent blocks (`rans.py`) that share it. Parquet gives the commit: a lost
executor's part is written again, and readers see whole files only. Segments are decoded in parallel, and inside one
every block, or every checkpoint of a block, can be read on its own.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .rans import Decoder, Table, encode_block
from .tokens import encoder
from .words import SLICE_BYTES

#: Ids in a segment, but that a document is never cut, and ids in a block.
SEGMENT, BLOCK = 1 << 20, 1 << 18
END = 2

_SEGMENTS = ("shard long, segment long, n_tokens long, doc_ids array<{id}>, lengths array<long>, table binary, "
             "blocks array<binary>")


def in_order(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`id, text` in ascending order of id over partitions and within them; equal ids follow their texts' hash, so
    that one id on many rows is no hot key. Null ids come first."""
    tie = F.xxhash64("text")
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.repartitionByRange(F.col("id"), tie).sortWithinPartitions("id", tie, "text")


def _segment(parts: list[tuple[pa.Array, np.ndarray, np.ndarray]], shard: int, segment: int) -> pa.RecordBatch:
    """The row of one segment from (ids of documents, their lengths, their tokens)."""
    doc_ids = pa.concat_arrays([p[0] for p in parts])
    lengths, flat = (np.concatenate([p[k] for p in parts]) for k in (1, 2))
    table = Table.of(flat)
    blocks = [encode_block(flat[i:i + BLOCK], table) for i in range(0, len(flat), BLOCK)]
    whole = pa.array([0, len(doc_ids)], pa.int32())
    return pa.record_batch([pa.array([shard]), pa.array([segment]), pa.array([len(flat)]), pa.ListArray.from_arrays(whole, doc_ids),
                            pa.ListArray.from_arrays(whole, pa.array(lengths)), pa.array([table.dump()], pa.binary()),
                            pa.array([blocks], pa.list_(pa.binary()))],
                           ["shard", "segment", "n_tokens", "doc_ids", "lengths", "table", "blocks"])


def _encoded(path: str, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, shard, segment = encoder(path), TaskContext.get().partitionId(), 0
        parts: list[tuple[pa.Array, np.ndarray, np.ndarray]] = []
        held = 0
        for batch in batches:
            for row, texts in text_slices(batch.column(1)):
                flat, counts = tokens.encode(texts)
                flat = np.insert(flat, np.cumsum(counts), np.uint32(end))  # an end after each document
                until = np.concatenate(([0], np.cumsum(counts + 1)))
                begin = 0
                while begin < len(counts):
                    # Up to and with the document that fills the segment.
                    to = min(len(counts), int(np.searchsorted(until, until[begin] + SEGMENT - held)))
                    parts.append((batch.column(0).slice(row + begin, to - begin), np.diff(until[begin:to + 1]), flat[until[begin]:until[to]]))
                    held += int(until[to] - until[begin])
                    begin = to
                    if held >= SEGMENT:
                        yield _segment(parts, shard, segment)
                        parts, held, segment = [], 0, segment + 1
        if held:
            yield _segment(parts, shard, segment)
    return run


def text_slices(texts: pa.Array, limit: int = 2 * SLICE_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of consecutive texts of about `limit` bytes."""
    texts = texts.fill_null("").cast(pa.large_string())
    at = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
    row = 0
    while row < len(texts):
        to = min(len(texts), max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1))
        yield row, texts.slice(row, to - row)
        row = to


def write_token_files(docs: DataFrame, path: str, tokenizer: str, *, id_col: str = "doc_id", text_col: str = "text",
                      end: int = END) -> None:
    """Encode every text, append the id `end`, and write all ids in ascending order of document id to the folder `path`.

    Null and empty texts are their end id alone. Equal document ids stay rows of their own. One shuffle, of the texts.
    """
    rows = in_order(docs, id_col, text_col)
    kind = rows.schema["id"].dataType.simpleString()
    rows.mapInArrow(_encoded(tokenizer, end), _SEGMENTS.format(id=kind)).write.option("compression", "uncompressed").parquet(path)


def decoded_segments(segments: DataFrame) -> DataFrame:
    """`shard, segment, place, doc_id, at, ids_crc32, n_tokens` of every document, from the blocks alone; `at` counts the
    ids before it in its segment, `place` the documents. Damaged blocks raise."""
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    return segments.select("shard", "segment", "doc_ids", "lengths", "table", "blocks").mapInArrow(
        _digest, f"shard long, segment long, place long, doc_id {kind}, at long, n_tokens long, ids_crc32 long")


def _segment_ids(row: dict) -> np.ndarray:
    decoder = Decoder(Table.load(row["table"]))
    return np.concatenate([decoder.block(raw) for raw in row["blocks"]])


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in ("shard", "segment", "table", "blocks")}
            plain = np.ascontiguousarray(_segment_ids(row), "<u4")
            lengths = np.asarray(batch.column("lengths")[i].values)
            until = np.concatenate(([0], np.cumsum(lengths)))
            if until[-1] != len(plain):
                raise ValueError("the documents' lengths do not add up to the ids")
            sums = [zlib.crc32(plain[a:b]) for a, b in zip(until[:-1].tolist(), until[1:].tolist())]
            yield pa.record_batch([pa.array(np.full(len(lengths), row["shard"])), pa.array(np.full(len(lengths), row["segment"])),
                                   pa.array(np.arange(len(lengths))), batch.column("doc_ids")[i].values,
                                   pa.array(until[:-1]), pa.array(lengths), pa.array(sums, pa.int64())],
                                  ["shard", "segment", "place", "doc_id", "at", "n_tokens", "ids_crc32"])


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            row = {name: batch.column(name)[i].as_py() for name in ("table", "blocks")}
            ids = _segment_ids(row).astype(np.int32)
            until = np.concatenate(([0], np.cumsum(np.asarray(batch.column("lengths")[i].values)))).astype(np.int32)
            yield pa.record_batch([batch.column("doc_ids")[i].values, pa.ListArray.from_arrays(pa.array(until), pa.array(ids))],
                                  ["doc_id", "ids"])


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id, ids` of every document, the end id included."""
    segments = spark.read.parquet(path)
    kind = segments.schema["doc_ids"].dataType.elementType.simpleString()
    return segments.select("doc_ids", "lengths", "table", "blocks").mapInArrow(_documents, f"doc_id {kind}, ids array<int>")


def _before(value: str, *order: str, within: str | None = None) -> Column:
    window = (Window.partitionBy(within) if within else Window.partitionBy()).orderBy(*order)
    return F.coalesce(F.sum(value).over(window.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).cast("long")


def token_digests(spark: SparkSession, path: str) -> DataFrame:
    """`doc_id, start, n_tokens, ids_crc32` of every document in token files.

    `start` is the number of ids before the document: those of the shards before its own, one row per shard, of the
    segments before its own in the shard, and of the documents before it in the segment.
    """
    segments = spark.read.parquet(path)
    sizes = segments.select("shard", "segment", "n_tokens")
    shards = sizes.groupBy("shard").agg(F.sum("n_tokens").alias("n")).withColumn("ahead", _before("n", "shard"))
    starts = sizes.withColumn("within", _before("n_tokens", "segment", within="shard")).join(
        shards.select("shard", "ahead"), "shard").select("shard", "segment", (F.col("ahead") + F.col("within")).alias("ahead"))
    return decoded_segments(segments).join(starts, ["shard", "segment"]).select(
        "doc_id", (F.col("ahead") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
