"""Every registered query against its SQL on the smallest test tables."""

import decimal
import math
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as registry  # noqa: E402

SF_DIR = registry.SMOKE_DIR
QUERIES, ORACLES = registry.queries(), registry.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"create view {path.stem} as select * from '{path}'")
    return connection


def plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def bag(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in data)


def test_every_query_has_an_oracle():
    """Those that SQL cannot express have tests of their own beside their operators."""
    own = {name for name in QUERIES if name == "pipeline" or name.startswith("op")}
    assert set(QUERIES) - own <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ORACLES)
def test_query_matches_oracle(spark, oracle, name):
    df = QUERIES[name](spark, SF_DIR)
    cursor = oracle.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert bag(df.columns, df.collect()) == bag(columns, cursor.fetchall())


def test_entry_returns_one_row_per_order(spark):
    assert registry.entry(spark).count() == 1500
