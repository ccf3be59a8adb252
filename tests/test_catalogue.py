"""Every registered query with SQL against that SQL, on the smallest tables."""

import glob
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as driver

DATA = "/root/testdata/sf0.001"
QUERIES, ORACLES = driver.queries(), driver.oracle_sql()


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.sql(f"CREATE VIEW {path.rsplit('/', 1)[1][:-8]} AS FROM '{path}'")
    return con


def plain(value):
    return round(value, 9) if isinstance(value, float) else value


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, oracle, name):
    made = QUERIES[name](spark, DATA)
    found = oracle.sql(ORACLES[name])
    columns = sorted(made.columns)
    assert columns == sorted(found.columns)
    got = Counter(tuple(plain(r[c]) for c in columns) for r in made.collect())
    places = [found.columns.index(c) for c in columns]
    assert got == Counter(tuple(plain(r[i]) for i in places) for r in found.fetchall())


def test_every_query_is_checked_or_listed():
    assert set(ORACLES) <= set(QUERIES)
    alone = {n for n in set(QUERIES) - set(ORACLES) if not n.startswith("op") and n != "pipeline"}
    assert alone == {"trace_markdown", "turn_prompts"}


def test_entry(spark):
    assert driver.entry(spark).count() > 0
