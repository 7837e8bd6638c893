import os
import random

import pytest

from advertlode.session import builder

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (builder("tests", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"})
               .master(f"local[{min(8, os.cpu_count())}]").getOrCreate())
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def column(spark):
    """Values of a column function over a list of texts."""
    def values(function, texts):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
        found = rows.select("i", function(F.col("t")).alias("v")).collect()
        return [r.v for r in sorted(found, key=lambda r: r.i)]

    return values


@pytest.fixture
def texts():
    """Random texts from pieces, the same ones every time."""
    def make(pieces, count=1500, longest=12, seed=1):
        rng = random.Random(seed)
        return ["".join(rng.choices(pieces, k=rng.randrange(longest + 1))) for _ in range(count)]

    return make


def assert_same(inputs, found, expected):
    wrong = [(i, f, e) for i, f, e in zip(inputs, found, expected) if f != e]
    assert not wrong, wrong[:5]


@pytest.fixture
def same():
    return assert_same
