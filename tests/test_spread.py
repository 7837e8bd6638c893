"""Steps that cost much for each row have as many tasks as a shuffle, however few bytes or files the rows come from."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from advertlode.operators import org_index
from advertlode.plans import inputs


@pytest.fixture
def one_file(spark, tmp_path):
    day = F.lit("2024-01-01").cast("timestamp_ntz")
    spark.range(400).select(F.col("id").alias("o_orderkey"), (F.col("id") % 3).alias("o_custkey"), F.lit("5-LOW").alias("o_orderpriority"),
                            day.alias("o_orderdate"), F.lit(1.5).alias("o_totalprice")).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    spark.range(3).select(F.col("id").alias("c_custkey"), F.lit("n").alias("c_name"), F.lit("m").alias("c_mktsegment")).coalesce(1).write.parquet(
        f"{tmp_path}/customer.parquet")
    return str(tmp_path)


def tasks(df):
    return df.select(F.spark_partition_id().alias("p")).distinct().count()


@pytest.mark.parametrize("made", [inputs.advert_pages, inputs.list_pages])
def test_pages_of_one_file(spark, one_file, made):
    pages = made(spark, one_file)
    assert pages.count() == 400 and tasks(pages) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_names_against_phrases(spark):
    names = spark.range(400).selectExpr("concat('navn ', id) AS name").coalesce(1)
    phrases = spark.createDataFrame([("navn 7", 1)], "phrase string, place int")
    found = org_index.best_phrases(names, phrases, threshold=0.1)
    assert found.count() == 400 and tasks(found) == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_phrases_that_cannot_win_are_not_sorted(monkeypatch):
    phrases = org_index._Phrases([f"navn {i:05}" for i in range(5000)])
    sorted_sizes, argsort = [], np.argsort
    monkeypatch.setattr(org_index.np, "argsort", lambda bound, **how: sorted_sizes.append(len(bound)) or argsort(bound, **how))
    assert phrases.best("navn 01234", 95.0) == (100.0, 1234) and sorted_sizes[0] < 500
