"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from gridloom.plans.registry import ORACLE, QUERIES as OWN
from gridloom.sources.tables import TABLES

QUERIES = {name: fn for name, fn in entry.queries().items() if name in OWN}


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def test_every_query_has_an_oracle_or_is_declared_rows_only():
    rows_only = set(QUERIES) - set(ORACLE)
    assert rows_only == {"listing"}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, sf_dir, duck, name):
    df = QUERIES[name](spark, sf_dir)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLE[name])
    dcols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, srows) == _rows(dcols, res.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE)))
def test_rows_only_queries_run(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).count() > 0


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.columns[:3] == ["time", "lat_idx", "lon_idx"]
    assert df.count() > 0
