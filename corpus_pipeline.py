"""From raw documents to token files: each stage is one operator, written as Parquet and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from advertlode.llm import stages
from advertlode.llm.tables import staged

STAGES = [
    ("quality", stages.good_quality),
    ("near_duplicates", stages.one_of_each_group),
    ("decontamination", stages.clean_of_benchmark),
    ("mix", stages.mixed_to_targets),
    ("token_files", stages.token_files),
]

#: The classifier and the sampling are no SQL; `tests/llm` compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the `documents` of `sf_dir`."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
