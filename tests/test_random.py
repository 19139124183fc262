"""Operators against brute force on generated rows."""

from datetime import timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from beforehand.operators.joins import asof_join
from beforehand.operators.quality import dedup
from beforehand.operators.rolling import Rolling, rolling, since_last
from beforehand.operators.skew import profile_keys

from .helpers import BASE, by_id, txn, txns

ROW = st.tuples(
    st.sampled_from(["a", "b", None]),
    st.one_of(st.integers(0, 40), st.integers(0, 300_000)),
    st.sampled_from(["x", "y", None]),
    st.one_of(st.none(), st.integers(0, 500).map(lambda cents: cents / 100)),
)
SLOW = settings(
    max_examples=6, deadline=None, derandomize=True,
    suppress_health_check=[HealthCheck.function_scoped_fixture, HealthCheck.too_slow],
)


def rows_of(drawn):
    return [txn(i, s, card=c, country=m, amount=a) for i, (c, s, m, a) in enumerate(drawn)]


def second(row):
    return int((row[2] - BASE) / timedelta(seconds=1))


@SLOW
@given(st.lists(ROW, min_size=1, max_size=30), st.sampled_from([1, 30, 86_400]))
def test_rolling_matches_its_definition(spark, drawn, span):
    rows = rows_of(drawn)
    specs = [Rolling("n", "count", span), Rolling("s", "sum", span, "amount"),
             Rolling("d", "distinct", span, "txn_country")]
    df = txns(spark, *rows)
    got = {route: by_id(rolling(df, "card_id", "txn_time", specs, route), "n", "s", "d") for route in ("window", "sweep")}
    for r in rows:
        seen = [o for o in rows if o[1] == r[1] and second(r) - span <= second(o) <= second(r) - 1]
        want = (len(seen), sum(o[3] or 0 for o in seen), len({o[6] for o in seen} - {None}))
        for route in got:
            n, s, d = got[route][r[0]]
            assert (n, round(s, 6), d) == (want[0], round(want[1], 6), want[2]), (route, r)


@SLOW
@given(st.lists(ROW, min_size=1, max_size=30), st.sampled_from([1, 3, 1000]))
def test_previous_row_matches_its_definition(spark, drawn, slice_rows):
    rows = rows_of(drawn)
    df = txns(spark, *rows)
    profile = profile_keys(df, "card_id", "txn_time", heavy_rows=4)
    out = since_last(
        df, "card_id", "txn_time", "txn_id", changed={"txn_country": "flip"}, profile=profile, slice_rows=slice_rows
    )
    got = by_id(out, "secs_since_last", "flip")
    for r in rows:
        earlier = [o for o in rows if o[1] == r[1] and (second(o), o[0]) < (second(r), r[0])]
        last = max(earlier, key=lambda o: (second(o), o[0]), default=None)
        flip = int(last is not None and None not in (last[6], r[6]) and last[6] != r[6])
        assert got[r[0]] == (second(r) - second(last) if last else -1, flip)


@SLOW
@given(st.lists(ROW, min_size=1, max_size=20), st.lists(ROW, max_size=20), st.booleans(), st.sampled_from([1, 1000]))
def test_asof_matches_its_definition(spark, drawn, other, strict, slice_rows):
    rows, lookups = rows_of(drawn), [txn(100 + i, *r[2:3], card=r[1]) for i, r in enumerate(rows_of(other))]
    left, right = txns(spark, *rows), txns(spark, *lookups).withColumnRenamed("txn_id", "hit")
    both = left.select("card_id", "txn_time").unionByName(right.select("card_id", "txn_time"))
    profile = profile_keys(both, "card_id", "txn_time", heavy_rows=5)
    out = asof_join(left, right, "card_id", "txn_time", "txn_time", ["hit"], strict, profile, slice_rows)
    got = by_id(out, "hit")
    for r in rows:
        seen = [o for o in lookups if r[1] is not None and o[1] == r[1] and (o[2] < r[2] or (not strict and o[2] == r[2]))]
        assert got[r[0]] == (max(seen, key=lambda o: (o[2], o[0]))[0] if seen else None)


@SLOW
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 9)), min_size=1, max_size=20))
def test_dedup_keeps_the_earliest(spark, drawn):
    df = txns(spark, *[txn(k, s) for k, s in drawn])
    got = by_id(dedup(df, ["txn_id"], ["txn_time"]), "txn_time")
    assert {k: int((t - BASE).total_seconds()) for k, t in got.items()} == {
        k: min(s for j, s in drawn if j == k) for k, _ in drawn
    }
