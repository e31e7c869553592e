"""Every registered query against its DuckDB oracle on sf0.001 (layer 2),
and the driver contract of ``__spark_entry__``."""

import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from common import SF_SMALL
from tidemill.sources.tables import TABLES

QUERIES = E.queries()
ORACLE = E.oracle_sql()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else f"{v:.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.columns == ["window_end", "item_id", "cnt", "rn"] and df.count() >= 0
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    cols, rows = df.columns, [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert rows is not None
        return
    res = duck.execute(ORACLE[name])
    ocols, orows = [d[0] for d in res.description], res.fetchall()
    assert sorted(cols) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(cols, rows) == _digest(ocols, orows)
