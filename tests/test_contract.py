"""Driver contract: entry() smoke and every registered query vs its DuckDB oracle."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from logloom import schemas  # noqa: E402
from oracle_check import TABLES, rows_of  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == schemas.REPORT_COLUMNS
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(E.catalog.QUERIES) == set(E.catalog.ORACLE)
    assert set(E.oracle_sql()) <= set(E.queries())
    assert len(E.catalog.QUERIES) >= 45


@pytest.mark.parametrize("name", sorted(E.catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(cols) == sorted(ocols)
    assert rows_of(cols, rows) == rows_of(ocols, res.fetchall())
