"""Every named query with a SQL form must give the same rows as that SQL."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def canonical(rows, order):
    def cell(v):
        if v is None:
            return (0, "")
        if isinstance(v, bool):
            return (1, int(v))
        if isinstance(v, float) and v.is_integer() and math.isfinite(v):
            return (1, int(v))
        return (1, v) if not isinstance(v, str) else (2, v)

    return sorted(tuple(cell(r[i]) for i in order) for r in rows)


def close(a, b):
    (ka, va), (kb, vb) = a, b
    if ka != kb:
        return False
    if isinstance(va, (int, float)) and isinstance(vb, (int, float)):
        return va == vb or math.isclose(va, vb, rel_tol=1e-9, abs_tol=1e-9)
    return va == vb


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_same_rows(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    res = duck.execute(entry.oracle_sql()[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(got) == len(want)
    names = sorted(cols)
    a = canonical(got, [df.columns.index(c) for c in names])
    b = canonical(want, [cols.index(c) for c in names])
    exact = a == b
    if not exact:
        bad = [(x, y) for x, y in zip(a, b) if not all(close(p, q) for p, q in zip(x, y))]
        assert not bad, f"{names}: {len(bad)} of {len(a)} differ, first {bad[:3]}"


def test_every_sql_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


ROWS_ONLY = sorted(set(entry.queries()) - set(entry.oracle_sql()))


@pytest.mark.parametrize("name", ROWS_ONLY)
def test_rows_only_queries_run(spark, name):
    assert len(entry.queries()[name](spark, SF).take(1)) == 1
