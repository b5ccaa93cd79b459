"""Every query with a SQL twin gives the SQL result on the smallest tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
# By default the order-dependent families (splits, encoders, resampling, evaluation, duplicates);
# TABULON_ALL_QUERIES=1 runs every query, as check.py does.
FAMILIES = ("b", "d", "e", "l", "w", "x")
ALL = os.environ.get("TABULON_ALL_QUERIES") == "1"
NAMES = [n for n in entry.oracle_sql() if ALL or n.startswith(FAMILIES)]

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables are absent")


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for f in sorted(os.listdir(FOLDER)):
        con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM '{FOLDER}/{f}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, db, name):
    df = entry.queries()[name](spark, FOLDER)
    cols = sorted(df.columns)
    got = sorted(repr(tuple(r)) for r in df.select(*[f"`{c}`" for c in cols]).collect())
    picked = ", ".join('"' + c + '"' for c in cols)
    want = sorted(repr(r) for r in db.execute(f"SELECT {picked} FROM ({entry.oracle_sql()[name]})").fetchall())
    assert got == want


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 57 and "threshold" in df.columns
