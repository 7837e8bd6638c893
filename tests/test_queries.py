"""Every registered query against its SQL on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from advertlode.plans.oracle import ORACLE
from advertlode.plans.queries import QUERIES

from .conftest import SF

TYPES = {"bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "boolean": "BOOLEAN", "double": "DOUBLE"}
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    with duckdb.connect() as connection:
        for name in TABLES.split():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
        yield connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    answer = duck.execute(ORACLE[name])
    types = {c[0]: str(c[1]) for c in answer.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    order = [list(types).index(c) for c in columns]

    def plain(value):
        return round(value, 9) if isinstance(value, float) and math.isfinite(value) else value

    expected = sorted((tuple(plain(r[i]) for i in order) for r in answer.fetchall()), key=repr)
    found = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=repr)
    assert found == expected and found


def test_entry(spark):
    assert entry.entry(spark).columns == entry.queries()["advert_rows"](spark, SF).columns
