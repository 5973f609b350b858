"""Every registered query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

SQL = entry.oracle_sql()


@pytest.fixture(scope="session")
def duck(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(df):
    def shown(v):
        if isinstance(v, float):
            return "null" if v != v else f"{v:.6f}"
        return "null" if v is None or v is pd.NA or v is pd.NaT else str(v)

    return sorted(tuple(shown(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, duck, sf, name):
    assert plain(entry.queries()[name](spark, sf).toPandas()) == plain(duck.execute(SQL[name]).df())


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(SQL)))
def test_queries_without_sql_run(spark, sf, name):
    rows = entry.queries()[name](spark, sf)
    assert rows.columns and rows.limit(5).collect() is not None


def test_entry(spark):
    assert entry.entry(spark).count() == 8


def test_core_does_not_know_the_subpackage():
    root = os.path.join(os.path.dirname(entry.__file__), "marrow")
    for path in glob.glob(f"{root}/**/*.py", recursive=True):
        if f"{os.sep}llm{os.sep}" not in path:
            assert "marrow.llm" not in open(path, encoding="utf-8").read(), path
