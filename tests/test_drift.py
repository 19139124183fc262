"""Drift of two periods from daily sketches against drift from all rows."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from beforehand.operators import drift, reports
from beforehand.operators.rolling import DAY, Rolling, rolling

from .helpers import txn, txns

START = date(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    h = lambda k: F.pmod(F.xxhash64("id", F.lit(k)), F.lit(100_000)) / 100_000
    day = (F.col("id") % 20).cast("int")
    return spark.range(60_000).select(
        F.date_add(F.lit(START), day).alias("txn_date"),
        (F.exp(h(1) * 3) + F.when(day >= 10, h(2)).otherwise(0.0)).alias("shifted"),
        F.when(h(3) < 0.4, 0.0).when(h(3) < 0.5, None).when(h(3) < 0.51, float("nan")).otherwise(F.round(h(4), 2)).alias("lumpy"),
        (F.col("id") % 7).alias("whole"),
    ).cache()


@pytest.mark.parametrize("column", ["shifted", "lumpy", "whole"])
@pytest.mark.parametrize("reference,actual", [((0, 10), (10, 20)), ((0, 1), (3, 17)), ((5, 9), (5, 9))])
def test_stored_drift_is_within_its_error(rows, column, reference, actual):
    period = lambda p: tuple(str(START + timedelta(days=d)) for d in p)
    sketches = drift.daily_sketches(rows, ["shifted", "lumpy", "whole"])
    got = drift.stored_drift(sketches, period(reference), period(actual)).where(F.col("column") == column)
    part = lambda p: rows.where(F.col("txn_date").between(*(START + timedelta(days=d) for d in (p[0], p[1] - 1))) & ~F.isnan(F.col(column).cast("double")))
    exact = {r.bin: r for r in reports.column_drift(part(reference), part(actual), column).collect()}
    mine = {r.bin: r for r in got.collect()}
    n_ref, n_act = (sum(r[c] for r in exact.values()) for c in ("n_ref", "n_act"))
    assert sum(r.n_ref for r in mine.values()) == pytest.approx(n_ref) and sum(r.n_act for r in mine.values()) == pytest.approx(n_act)
    for i in set(exact) | set(mine):
        a, b = exact.get(i), mine.get(i)
        assert abs((a.n_ref if a else 0) - (b.n_ref if b else 0)) <= 4 * drift.RANK_ERROR * n_ref
        assert abs((a.n_act if a else 0) - (b.n_act if b else 0)) <= 4 * drift.RANK_ERROR * n_act
    assert sum(r.psi for r in mine.values()) == pytest.approx(sum(r.psi for r in exact.values()), abs=0.02)


def test_sketches_of_single_days_merge_to_those_of_all(rows):
    by_day = drift.daily_sketches(rows, ["shifted"])
    assert by_day.count() == 20 and by_day.agg(F.sum("n")).first()[0] == 60_000
    nulls = drift.daily_sketches(rows, ["lumpy"]).agg(F.sum("n"), F.sum("nulls")).first()
    missing = rows.where("lumpy is null or isnan(lumpy)").count()
    assert tuple(nulls) == (60_000 - missing, missing) and missing > 3_000


def test_no_rows_no_drift(rows):
    sketches = drift.daily_sketches(rows, ["shifted"])
    assert drift.stored_drift(sketches, ("2024-01-01", "2024-01-05"), ("2030-01-01", "2030-02-01")).count() == 0
    empty = drift.daily_sketches(rows.limit(0), ["shifted"])
    assert empty.count() == 0


def test_an_approximate_count_does_not_depend_on_other_keys(spark):
    """The light key alone, and beside a heavy one."""
    rng = random.Random(3)
    light = [txn(i, i * 20, card="light", merchant=f"m{rng.randint(0, 400)}") for i in range(300)]
    heavy = [txn(1000 + i, i * 3, card="heavy", merchant=f"m{i % 50}") for i in range(700)]
    specs = [Rolling("n", "approx_distinct", DAY, "merchant_id")]
    from beforehand.operators.skew import profile_keys

    found = []
    for rows in (light, light + heavy):
        df = txns(spark, *rows)
        out = rolling(df, "card_id", "txn_time", specs, profile=profile_keys(df, "card_id", "txn_time", heavy_rows=500))
        found.append({r.txn_id: r.n for r in out.where("card_id = 'light'").collect()})
    exact = rolling(txns(spark, *light), "card_id", "txn_time", [Rolling("n", "distinct", DAY, "merchant_id")])
    assert found[0] == found[1] == {r.txn_id: r.n for r in exact.collect()}
