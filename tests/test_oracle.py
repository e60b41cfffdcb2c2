"""Every query with SQL gives what DuckDB gives on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from opinera.plans import platform  # noqa: F401
from opinera.plans.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _plain(value):
    if value is None or value is pd.NA or value != value:
        return None
    if type(value).__name__ in ("float", "Decimal", "float64"):
        return round(float(value), 9)
    return value.item() if hasattr(value, "item") else value


def _rows(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted((tuple(map(_plain, r)) for r in frame.itertuples(index=False)), key=repr)


@pytest.fixture(scope="module")
def tables():
    if not os.path.isdir(FOLDER):
        pytest.skip("no test tables")
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, tables, name):
    assert _rows(QUERIES[name](spark, FOLDER).toPandas()) == _rows(tables.sql(SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_gives_rows(spark, tables, name):
    assert QUERIES[name](spark, FOLDER).count() > 0
