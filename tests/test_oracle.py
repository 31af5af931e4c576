"""Every registered query against its DuckDB oracle (row count, columns, order-insensitive values)."""

import math

import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
SF = SF_SMALL


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    if hasattr(v, "isoformat"):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    if hasattr(v, "tolist"):
        return _norm(v.tolist())
    return str(v)


def _rows(cols, recs):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in recs)


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("key", sorted(E.oracle_sql()))
def test_matches_oracle(spark, duck, key):
    sdf = E.queries()[key](spark, SF)
    s_cols, s_recs = sdf.columns, [tuple(r) for r in sdf.collect()]
    rel = duck.sql(E.oracle_sql()[key])
    o_cols, o_recs = rel.columns, rel.fetchall()
    assert sorted(s_cols) == sorted(o_cols)
    assert len(s_recs) == len(o_recs)
    assert _rows(s_cols, s_recs) == _rows(o_cols, o_recs)


@pytest.mark.parametrize("key", sorted(set(E.queries()) - set(E.oracle_sql())))
def test_rows_only_keys_run(spark, key):
    df = E.queries()[key](spark, SF)
    assert df.count() > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and "engagement_quartile" in df.columns
