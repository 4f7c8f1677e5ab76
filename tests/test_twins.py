"""Every registered query with a SQL twin equals DuckDB on the smallest tables;
every other registered query runs and keeps its schema."""

import duckdb
import pytest

from tests.conftest import SMALL
from tools.check import TABLES, digest

import __spark_entry__ as entry

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_twin(spark, con, name):
    sdf = QUERIES[name](spark, SMALL)
    cur = con.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    srows = [tuple(r) for r in sdf.collect()]
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(sdf.columns, srows)[0] == digest(dcols, drows)[0]


FAST_NO_SQL = [n for n in sorted(QUERIES) if n not in SQL and n in (
    "m3_m4_bayes_trend", "i6_i7_model_run_roundtrip", "x7_compare_feature_sets")]


@pytest.mark.parametrize("name", FAST_NO_SQL)
def test_rows_only(spark, name):
    df = QUERIES[name](spark, SMALL)
    assert df.count() > 0 and len(df.columns) > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert set(df.columns) >= {"brand", "model", "slot", "rmse"} and df.count() > 0
