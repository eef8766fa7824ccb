"""Every registered query against its DuckDB oracle on the smallest scale
(the driver repeats this at sf0.01)."""

import datetime as dt
import hashlib
import math

import duckdb
import pytest

import __spark_entry__ as E
from riskloom.fixtures import BASE_TABLES
from riskloom.plans import catalog
from tests.conftest import SF_SMALL

#: Of the panel engine; the other queries are tested in a folder of their own.
QUERIES = {name: E.queries()[name] for name in catalog.queries()}
ORACLE = catalog.oracle_sql()


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(round(v, 9))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(_norm(x) for x in v) + "]"
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return hashlib.sha256("\n".join(sorted("|".join(_norm(r[i]) for i in order) for r in rows)).encode()).hexdigest()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only <= {"surrogate_id", "src_matrix_errors"}, rows_only
    assert len(QUERIES) >= 100


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = duck.execute(ORACLE[name])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)
