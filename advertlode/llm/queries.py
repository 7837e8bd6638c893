"""One query for each operator, over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import (bisectors, cube, line_spread, lsh_forest, merkle, order_minhash, path_ratios, periodic_runs, pivot_index, pu_quality, separators,
               string_tiling)
from .stages import table, token_files, tokenizer_path
from .tables import shared_path, staged


def op1_rans_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token files of all documents, and what is read back from them."""
    return token_files(spark, table(spark, sf_dir, "documents"), sf_dir)


def op2_path_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of all pages."""
    return path_ratios.extracted(table(spark, sf_dir, "pages"))


def op3_separator_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document, counted in flat files that do not know where documents begin."""
    docs, path = table(spark, sf_dir, "documents"), shared_path(spark, "flat-files")
    separators.write_flat_files(docs, path, tokenizer_path(), ordered=False)
    files = spark.read.parquet(path)
    return separators.named(files, separators.documents(files))


#: Of each 97 pages by id, the second copy has a changed byte, a record cut short or no record for one each.
_DAMAGE = 97
_PER_FILE = 1000


def op4_merkle_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged records of a second copy of all pages as WARC files. The copy is damaged by a rule on page ids."""
    pages = table(spark, sf_dir, "pages")
    records = pages.select(F.floor(F.col("page_id") / _PER_FILE).alias("file"), F.col("page_id").alias("seq"), "page_id",
                           merkle.warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
    part = F.col("page_id") % _DAMAGE
    half = F.floor(F.length("record") / 2).cast("int")
    kept = F.when(part == 0, F.overlay("record", F.lit("\x00"), half, F.lit(1))).when(
        part == 1, F.substring(F.col("record"), F.lit(1), half)).otherwise(F.col("record"))
    # The copy's index is the first copy's: records keep their offsets, and one that is lost leaves a gap. Its hashes are those
    # of the same rows, so repeated ids stay rows of their own; ids that are null are under no rule.
    copied = records.select("*", F.sha2(kept.cast("binary"), 256).alias("own"), F.octet_length(kept).cast("long").alias("own_length"),
                            part.eqNullSafe(F.lit(2)).alias("lost"))
    both = staged(merkle.leaves(copied, also=("own", "own_length", "lost")), "copies")
    replica = both.where(~F.col("lost")).select("file", "seq", "offset", F.col("own_length").alias("length"), F.col("own").alias("hash"))
    return merkle.audit(both.drop("own", "own_length", "lost"), replica).select(F.col("seq").alias("page_id"), "file", F.col("offset").alias("record_offset"), "length", "kind")


def op5_string_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents hold benchmark items."""
    return string_tiling.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of sources takes."""
    rows = cube.mixed(table(spark, sf_dir, "documents"))
    return rows.withColumn("_row", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))).select(
        "doc_id", "size", "source_size", "target",
        (cube.own_copies(F.col("copies"), F.col("times"), F.col("_row")) * F.col("size")).cast("long").alias("taken"))


def op7_line_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that many sources carry."""
    rows = line_spread.without_boilerplate(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.col("_lines").alias("n_lines"), F.col("_removed").alias("n_removed"), F.md5("text").alias("text_md5"))


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return order_minhash.followed(table(spark, sf_dir, "documents"))


def op9_pu_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents."""
    docs = table(spark, sf_dir, "documents")
    return pu_quality.quality_scores(docs, pu_quality.learned(docs, table(spark, sf_dir, "labels")))


def op10_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"))


def op11_pivot_permutations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate vectors of each label."""
    return pivot_index.near_vectors(table(spark, sf_dir, "embeddings"))


def op12_bisector_tournament(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of all vectors, with the sums of their distances."""
    found = bisectors.clustered(table(spark, sf_dir, "embeddings"))
    names = spark.createDataFrame([(c, hashlib.sha256(",".join(map(str, v)).encode()).hexdigest()) for c, v in enumerate(found.centroids)],
                                  "cluster int, centroid_sha256 string")
    sums = found.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("sum"))
    # One row per centroid, so neither the window nor the joins move vectors.
    own = sums.withColumn("total", F.sum("sum").over(Window.partitionBy())).join(F.broadcast(names), "cluster").select(
        "cluster", F.col("sum").cast("long").alias("cluster_inertia"), F.col("total").cast("long").alias("inertia"), "centroid_sha256")
    return found.rows.join(F.broadcast(own), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _with_repeated_tails(docs: DataFrame) -> DataFrame:
    """`doc_id, text`, where every tenth document by the crc32 of its id repeats its words from one place on."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    place = F.floor(hashed / 10)

    def repeated(words: Column) -> Column:
        n = F.size(words)
        a = F.when(n > 0, place % F.nullif(n, F.lit(0)))
        period = 1 + F.floor((n - a) / (3 + place % 8))
        return F.when(n == 0, F.lit("")).otherwise(F.concat_ws(" ", F.slice(words, F.lit(1), a.cast("int")), F.transform(
            F.sequence(a, F.lit(1).cast("long") * n - 1), lambda i: F.get(words, (a + (i - a) % period).cast("int")))))

    # A function of one-element arrays binds its argument once.
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    tail = F.get(F.transform(F.array(words), repeated), F.lit(0))
    return docs.select("doc_id", F.when(hashed % 10 == 0, tail).otherwise(F.col("text")).alias("text"))


def op13_recompressed_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words in all documents, every tenth with a repeated tail, and digests of the texts without repeats."""
    found = periodic_runs.periodic_runs(_with_repeated_tails(table(spark, sf_dir, "documents")))
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], -r["start"], -r["period"])))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    listed = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(F.lit(""))
    rows = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), top.alias("top"), F.sha2(listed, 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))
    length, start, period = F.col("top")["length"], -F.col("top")["col2"], -F.col("top")["col3"]
    return rows.select("doc_id", "n_runs", start.alias("start"), length.alias("length"), period.alias("period"),
                       F.floor(1000 * length / period).cast("long").alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


def _clusters_sql(k: int = bisectors.K, dim: int = bisectors.DIM, rounds: int = bisectors.ROUNDS) -> str:
    """All distances in every round; the least of `distance * k + number` is the nearest, the smaller number among equals."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
        near{r} AS (
            SELECT r, min(far * {k} + number) AS best FROM (
                SELECT r, number, sum((parts.v - c.v) * (parts.v - c.v))::BIGINT AS far
                FROM parts JOIN centroids{r} c USING (place) GROUP BY r, number) GROUP BY r)""")
        if r < rounds:
            steps.append(f"""
        sums{r} AS (
            SELECT best % {k} AS number, place, sum(v)::BIGINT AS s, count(*) AS n FROM parts JOIN near{r} USING (r) GROUP BY ALL),
        centroids{r + 1} AS (
            SELECT c.number, c.place, coalesce((s - ((s % n) + n) % n) // n, c.v) AS v
            FROM centroids{r} c LEFT JOIN sums{r} USING (number, place))""")
    return f"""
        WITH kept AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({bisectors.SCALE} * x::DOUBLE)::BIGINT) AS x
            FROM embeddings
            WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dim}),
        parts AS (SELECT r, unnest(range({dim})) AS place, unnest(x) AS v FROM kept),
        centroids0 AS (
            SELECT number, unnest(range({dim})) AS place, unnest(x) AS v FROM (
                SELECT x, row_number() OVER (ORDER BY sha256('{bisectors.SEED}:' || vec_id)) - 1 AS number FROM kept)
            WHERE number < {k}),{",".join(steps)},
        found AS (SELECT r, (best % {k})::INTEGER AS cluster, best // {k} AS distance FROM near{rounds}),
        names AS (SELECT number, sha256(string_agg(v::VARCHAR, ',' ORDER BY place)) AS centroid_sha256 FROM centroids{rounds} GROUP BY number)
        SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
               sum(distance) OVER ()::BIGINT AS inertia, centroid_sha256
        FROM found JOIN kept USING (r) JOIN names ON number = cluster"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_rans_token_files, op2_path_ratios, op3_separator_scan, op4_merkle_audit, op5_string_tiling,
                            op6_cube_mix, op7_line_spread, op8_order_minhash, op9_pu_quality, op10_lsh_forest, op11_pivot_permutations,
                            op12_bisector_tournament, op13_recompressed_runs)}

SQL: dict[str, str] = {
    "op4_merkle_audit": rf"""
        WITH records AS (
            SELECT page_id, page_id // {_PER_FILE} AS file,
                   'WARC/1.0' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
                   || page_id || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '') || chr(13) || chr(10)
                   || 'Content-Length: ' || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10)
                   || coalesce(html, '') || chr(13) || chr(10) || chr(13) || chr(10) AS record
            FROM pages),
        placed AS (
            SELECT *, strlen(record) AS length,
                   coalesce(sum(strlen(record)) OVER (PARTITION BY file ORDER BY page_id
                            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS record_offset
            FROM records)
        SELECT page_id, file, record_offset::BIGINT AS record_offset, length::BIGINT AS length,
               CASE WHEN page_id % {_DAMAGE} = 2 THEN 'missing' ELSE 'changed' END AS kind
        FROM placed WHERE page_id % {_DAMAGE} IN (0, 1, 2)""",
    "op7_line_spread": f"""
        WITH lines AS (
            SELECT row_number() OVER () AS r, doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
                   generate_subscripts(string_split(text, chr(10)), 1) AS place
            FROM documents),
        bad AS (
            SELECT trim(line, ' ') AS line FROM lines WHERE trim(line, ' ') <> '' GROUP BY 1
            HAVING count(DISTINCT source) >= {line_spread.SITES})
        SELECT doc_id, count(*) AS n_lines, count(bad.line) AS n_removed,
               md5(coalesce(string_agg(lines.line, chr(10) ORDER BY place) FILTER (WHERE bad.line IS NULL), '')) AS text_md5
        FROM lines LEFT JOIN bad ON trim(lines.line, ' ') = bad.line GROUP BY doc_id""",
    "op12_bisector_tournament": _clusters_sql(),
}
