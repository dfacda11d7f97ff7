"""Differential test: every registered query against its DuckDB SQL at sf0.001."""

import math

import duckdb
import pytest

import __spark_entry__ as E

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


@pytest.fixture(scope="module")
def con(sf_small):
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    return c


def _key(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, v)
    if isinstance(v, int):
        return (2, float(v))
    return (3, str(v))


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return [cols[i] for i in order], sorted((tuple(r[i] for i in order) for r in rows),
                                            key=lambda r: [_key(x) for x in r])


def _same(a, b):
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        a, b = float(a), float(b)
        if math.isnan(a) or math.isnan(b):
            return math.isnan(a) and math.isnan(b)
        if math.isinf(a) or math.isinf(b):
            return a == b
        return abs(a - b) <= 1e-9 * max(1.0, abs(a), abs(b))
    return a == b


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, sf_small, con, name):
    sdf = E.queries()[name](spark, sf_small)
    sc, sr = _rows(sdf.columns, [tuple(r) for r in sdf.collect()])
    cur = con.execute(E.oracle_sql()[name])
    oc, orr = _rows([c[0] for c in cur.description], cur.fetchall())
    assert sc == oc
    assert len(sr) == len(orr)
    for r1, r2 in zip(sr, orr):
        assert all(_same(a, b) for a, b in zip(r1, r2)), (r1, r2)


def test_every_query_has_an_oracle():
    from panelrep.plans.catalog import QUERIES

    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["Model", "Scenario", "Region", "Item", "Variable", "Year", "Unit", "Value"]
    assert df.count() > 0
