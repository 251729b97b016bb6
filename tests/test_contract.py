"""The driver's contract, and every query with SQL against DuckDB on the smallest tables."""

import glob
import os
import re

import duckdb
import pytest

import __spark_entry__ as entry

DATA = "/root/testdata/sf0.001"
SQL = {k: v for k, v in entry.oracle_sql().items() if not re.match(r"op\d+_|pipeline$", k)}
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="tables aren't here")


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM read_parquet('{path}')")
    return c


def plain(frame, cols):
    def one(v):
        if v is None or str(v) in ("<NA>", "nan", "NaT"):
            return "null"
        return str(int(v)) if isinstance(v, float) and v == int(v) else str(v)

    return sorted(tuple(map(one, row)) for row in frame[cols].itertuples(index=False))


def test_names_agree():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).columns == ["lang", "kind", "n_lines", "n_sparse_docs"]
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(SQL))
def test_against_sql(spark, con, name):
    ours, theirs = entry.queries()[name](spark, DATA).toPandas(), con.sql(SQL[name]).df()
    cols = sorted(ours.columns)
    assert cols == sorted(theirs.columns)
    assert plain(ours, cols) == plain(theirs, cols)
