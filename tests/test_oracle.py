"""Every registered query against its SQL, value by value."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from courtline.fixtures.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SQL = entry_module.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    return connection


def _sorted(rows):
    clean = [tuple(None if isinstance(v, float) and math.isnan(v) else v for v in row) for row in rows]
    return sorted(map(repr, clean))


def test_every_query_has_sql():
    assert set(QUERIES) <= set(SQL) and set(QUERIES) <= set(entry_module.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    result = entry_module.queries()[name](spark, SF_DIR)
    expected = duck.execute(SQL[name])
    columns = [d[0] for d in expected.description]
    assert sorted(columns) == sorted(result.columns)
    want = _sorted(expected.fetchall())
    got = _sorted(tuple(row[c] for c in columns) for row in result.collect())
    assert want, "an empty result proves nothing"
    assert got == want


def test_entry(spark):
    sheet = entry_module.entry(spark)
    assert sheet.count() == 1473
    assert "spread_bet" in sheet.columns


def test_expected_branch_counts(spark):
    flags = entry_module.queries()["value_flags"](spark, SF_DIR)
    def counts(column):
        return sorted(row["count"] for row in flags.groupBy(column).count().collect())
    assert counts("spread_recommendation") == [240, 605, 628]
    assert counts("total_recommendation") == [320, 479, 674]
    assert counts("moneyline_recommendation") == [448, 1025]
