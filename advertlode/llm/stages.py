"""The stages of the corpus pipeline: (spark, docs, sf_dir) to a DataFrame. All but the last return the columns of `docs`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .cube import mix
from .lsh_forest import one_of_each
from .pu_quality import THRESHOLD, learned, scored
from .string_tiling import decontaminated
from .tables import fresh, shared_path
from .token_files import token_digests, write_token_files


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    """The public byte-level BPE of 50,257 ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts. It learns from the given documents and their labels."""
    model = learned(docs, table(spark, sf_dir, "labels"))
    score, = fresh(docs, "_score")
    return scored(docs, model, score).where(F.col(score) >= THRESHOLD).select(*docs.columns)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return one_of_each(docs, shingle=5, percent=80)


def clean_of_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that do not hold a benchmark item."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mixed_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix(docs)


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the documents, and what is read back from them."""
    path = shared_path(spark, "token-files")
    write_token_files(docs, path, tokenizer_path())
    return token_digests(spark, path)
