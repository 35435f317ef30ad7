"""Every registered query against its SQL twin on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
import __spark_entry__ as entry_point  # noqa: E402
from playbill.plans import catalog  # noqa: E402

FOLDER = Path("/root/testdata/sf0.001")
QUERIES, ORACLES = catalog.QUERIES, catalog.ORACLES

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def sql():
    connection = duckdb.connect()
    for file in FOLDER.glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def order(row):
    return tuple((value is None, str(value)) for value in row)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_agrees_with_sql(spark, sql, name):
    df = QUERIES[name](spark, str(FOLDER))
    relation = sql.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(relation.columns)
    places = [relation.columns.index(column) for column in df.columns]
    expected = sorted((tuple(row[i] for i in places) for row in relation.fetchall()), key=order)
    assert sorted(map(tuple, df.collect()), key=order) == expected
    assert expected


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


def test_all_are_registered():
    assert set(QUERIES) <= set(entry_point.queries()) and set(ORACLES) <= set(entry_point.oracle_sql())
