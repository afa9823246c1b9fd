"""Every registered query against its SQL on DuckDB, at the smallest scale."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from runloom.plans import QUERIES as registered
from tools.check_queries import canonical

SMALL = "/root/testdata/sf0.001"
OWN = set(registered)
QUERIES = {name: run for name, run in entry.queries().items() if name in OWN}
ORACLES = {name: sql for name, sql in entry.oracle_sql().items() if name in OWN}
ROWS_ONLY = {"plain_page_texts"}


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return connection


def test_every_query_has_an_oracle():
    assert set(QUERIES) - set(ORACLES) == ROWS_ONLY and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, database, name):
    mine = QUERIES[name](spark, SMALL).toPandas()
    assert len(mine)
    if name in ORACLES:
        theirs = database.execute(ORACLES[name]).df()
        assert sorted(mine.columns) == sorted(theirs.columns)
        assert canonical(mine) == canonical(theirs)


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
