"""Buckets, encodings, context and joins on hand-written rows."""

import re
from collections import Counter
from datetime import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from beforehand.operators import encoding, joins
from beforehand.operators.buckets import bucket_counts, rolling_buckets
from beforehand.operators.reports import partition_sizes, shuffle_sizes
from beforehand.operators.skew import profile_keys, profile_many
from beforehand.plans import features as plan
from beforehand.sources.schemas import Timeline

from .helpers import by_id, frame, plan_of, txn, txns

H = 3600


def merchant_view(spark, df, distinct="exact"):
    return plan.merchant_history(df, df, profile_keys(df, "merchant_id", "txn_time"), distinct)


def test_current_hour_is_hidden(spark):
    df = txns(spark, txn(1, 10 * H + 300), txn(2, 10 * H + 3000), txn(3, 11 * H + 600))
    assert by_id(merchant_view(spark, df), "merch_cnt_7d") == {1: 0, 2: 0, 3: 2}


def test_repeated_member_sums_per_hour_but_is_one_in_the_sketch(spark):
    df = txns(spark, txn(1, 0), txn(2, H), txn(3, 2 * H), txn(4, 3 * H))
    assert by_id(merchant_view(spark, df), "merch_ncards_24h")[4] == 3
    assert by_id(merchant_view(spark, df, "sketch"), "merch_ncards_24h")[4] == 1


def test_bucket_join_takes_the_same_values_with_and_without_salt(spark):
    df = txns(spark, *[txn(i, i * 400, merchant="hot" if i % 3 else "cold") for i in range(60)])
    profile = profile_keys(df, "merchant_id", "txn_time", heavy_rows=30)
    rolled = rolling_buckets(bucket_counts(df, "merchant_id", "txn_time", "card_id"), "merchant_id", "a", "b")
    rows = df.withColumn("hr_ts", F.unix_timestamp(F.date_trunc("hour", "txn_time")))
    plain = rows.join(rolled, ["merchant_id", "hr_ts"], "left")
    salted = joins.salted_join(
        rows, rolled, ["merchant_id", "hr_ts"], profile, ["txn_id"], "left", rows_per_salt=1, group_micros=H * 10**6
    )
    assert by_id(plain, "a", "b") == by_id(salted, "a", "b")


def history(spark, *rows, hist_end="2024-02-01", cutoff="2024-03-01"):
    return encoding.known_history(
        txns(spark, *rows), "txn_time", "is_fraud", "label_confirmed_at", hist_end, cutoff
    )


def test_smoothing(spark):
    h = history(spark, txn(1, 0, fraud=1, confirmed=datetime(2024, 1, 12)))
    te = encoding.target_encoding(encoding.tally(h, ["merchant_id"]), "merchant_id", prior=0.01)
    assert te.first()["merchant_id_te"] == pytest.approx(0.0571428571428)


@pytest.mark.parametrize(
    "cutoff, known", [("2024-01-25", 0), ("2024-01-29", 0), ("2024-01-29 00:00:01", 1), ("2024-02-05", 1)]
)
def test_label_counts_only_when_confirmed_strictly_before_the_cutoff(spark, cutoff, known):
    h = history(spark, txn(1, 0, fraud=1, confirmed=datetime(2024, 1, 29)), cutoff=cutoff)
    assert h.first()["known"] == known


def test_history_ends_strictly_before_its_end(spark):
    rows = [txn(1, datetime(2024, 1, 31, 23, 59, 59)), txn(2, datetime(2024, 2, 1))]
    assert [r.txn_id for r in history(spark, *rows).collect()] == [1]


def test_empty_history_is_a_clear_error_unless_a_prior_is_given(spark):
    df = txns(spark, txn(1, 0))
    line = Timeline(hist_end="2020-01-01")
    profiles = profile_many(df, plan.ENCODED, "txn_time")
    with pytest.raises(PySparkException, match="no history"):
        plan.encodings(df, df, line, profiles).collect()
    got = plan.encodings(df, df, line, profiles, prior=0.25).first()
    assert (got["merchant_id_te"], got["mcc_te"]) == (0.25, 0.25)


def test_unseen_key_gets_the_prior_and_neutral_context(spark):
    df = txns(spark, txn(1, 0, merchant="old"), txn(2, datetime(2024, 2, 2), merchant="new", mcc=9))
    line = Timeline(hist_end="2024-02-01", label_cutoff="2024-03-01")
    out = plan.encodings(df, df, line, profile_many(df, plan.ENCODED, "txn_time"))
    assert by_id(out, "merchant_id_te", "mcc_te")[2] == (0.0, 0.0)
    dim = frame(spark, "merchant_id string, merchant_country string, merchant_risk_tier string",
                ("old", "US", "high"))
    ctx = plan.context(df, dim)
    assert by_id(ctx, "cross_border", "risk_tier_num", "is_ecom") == {1: (0, 2, 1), 2: (None, 0, 1)}
    gaps = plan.context(txns(spark, txn(1, 0, merchant="old", country=None, channel=None)), dim)
    assert by_id(gaps, "cross_border", "is_ecom") == {1: (None, None)}


def test_weekend(spark):
    rows = [txn(1, datetime(2024, 1, 12, 23, 59)), txn(2, datetime(2024, 1, 13)),
            txn(3, datetime(2024, 1, 14, 23, 59)), txn(4, datetime(2024, 1, 15))]
    dim = frame(spark, "merchant_id string, merchant_country string, merchant_risk_tier string", ("m", "US", "low"))
    assert by_id(plan.context(txns(spark, *rows), dim), "is_weekend") == {1: 0, 2: 1, 3: 1, 4: 0}


@pytest.mark.parametrize("heavy_rows", [10**6, 1])
def test_row_mode_learns_a_label_only_when_it_arrives(spark, heavy_rows):
    rows = [
        txn(1, datetime(2024, 1, 1), fraud=1, confirmed=datetime(2024, 1, 20)),
        txn(2, datetime(2024, 1, 15)),
        txn(3, datetime(2024, 1, 20)),  # confirmed at this very instant: not yet known
        txn(4, datetime(2024, 1, 25)),
    ]
    df = txns(spark, *rows)
    profile = profile_keys(df, "merchant_id", "txn_time", heavy_rows=heavy_rows)
    out = encoding.target_encoding_asof(
        df, "merchant_id", "txn_time", "is_fraud", "label_confirmed_at", k=1, prior=0.0, profile=profile, slice_rows=2
    )
    assert by_id(out, "merchant_id_te") == {1: 0.0, 2: 0.0, 3: 0.0, 4: 1 / 4}


def test_version_lookup_by_period(spark):
    rows = [txn(1, datetime(2024, 1, 3), fraud=1, confirmed=datetime(2024, 2, 10)), txn(2, datetime(2024, 2, 5)),
            txn(3, datetime(2024, 3, 5))]
    df = txns(spark, *rows)
    te = encoding.target_encoding_by_period(df, "merchant_id", "txn_time", "is_fraud", "label_confirmed_at", k=1)
    got = {r.period.month: (r.n, r.hits) for r in te.collect()}
    assert got == {2: (1, 0), 3: (2, 1), 4: (3, 1)}
    seen = joins.asof_join(df, te, "merchant_id", "txn_time", "period", ["merchant_id_te"], strict=False)
    assert by_id(seen, "merchant_id_te") == {1: None, 2: 0.0, 3: pytest.approx((1 + 0.5) / 3)}


# ---- joins


def skewed(spark):
    big = spark.range(400).select(
        "id", F.when(F.col("id") % 4 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 40)).alias("key")
    )
    small = frame(spark, "key string, tag int", ("hot", 1), *[(f"k{i}", i) for i in range(30)])
    return big, small


def test_all_join_strategies_give_the_same_rows(spark):
    big, small = skewed(spark)
    hot = profile_keys(big, "key", heavy_rows=50)
    assert [h[0] for h in hot.heavy] == ["hot"]

    def rows(df):
        return Counter(tuple(r) for r in df.select("id", "key", "tag").collect())

    want = rows(big.join(small, "key"))
    assert sum(want.values()) > 100
    assert rows(joins.merge_join(big, small, "key")) == want
    assert rows(joins.salted_join(big, small, "key", hot, rows_per_salt=10)) == want
    assert rows(joins.salted_join(big, small, "key", None)) == want
    assert rows(joins.lookup_join(big, small, "key", how="inner")) == want
    left = rows(big.join(small, "key", "left"))
    assert rows(joins.salted_join(big, small, "key", hot, how="left", rows_per_salt=10)) == left
    assert rows(joins.lookup_join(big, small, "key")) == left


def test_join_plans(spark):
    big, small = skewed(spark)
    hot = profile_keys(big, "key", heavy_rows=50)
    merged = plan_of(joins.merge_join(big, small, "key"))
    assert "SortMergeJoin" in merged and "Broadcast" not in merged
    assert "SortMergeJoin" in plan_of(joins.salted_join(big, small, "key", hot, rows_per_salt=10))
    cast = plan_of(joins.lookup_join(big, small, "key", how="inner"))
    assert "BroadcastHashJoin" in cast and "Exchange hashpartitioning" not in cast


def test_a_large_side_is_not_broadcast(spark):
    big, small = skewed(spark)
    assert "SortMergeJoin" in plan_of(joins.lookup_join(big, small, "key", limit=10))
    assert not joins.fits_broadcast(small, rows=10**9)
    out = joins.lookup_join(big, small, "key", rows=10**9, profile=profile_keys(big, "key", heavy_rows=50))
    assert "BroadcastHashJoin [key" not in plan_of(out)
    assert out.count() == 400


def test_salting_refuses_joins_it_would_duplicate(spark):
    big, small = skewed(spark)
    with pytest.raises(ValueError):
        joins.salted_join(big, small, "key", None, how="full")


def test_salt_evens_out_partitions(spark):
    big, _ = skewed(spark)
    salt = F.pmod(F.xxhash64("id"), F.lit(8))
    before = partition_sizes(big.repartition(16, "key")).first()
    after = partition_sizes(big.withColumn("s", salt).repartition(16, "key", "s")).first()
    assert after.max_rows < before.max_rows
    assert shuffle_sizes(big, ["key"], 16).first() == before
    assert shuffle_sizes(big.withColumn("s", salt), ["key", "s"], 16).first() == after
    assert before.partitions <= 16


@pytest.mark.parametrize("strict, want", [(True, {1: None, 2: 1, 3: 2}), (False, {1: 1, 2: 2, 3: 2})])
@pytest.mark.parametrize("heavy_rows", [10**6, 1])
def test_asof_join(spark, strict, want, heavy_rows):
    left = txns(spark, txn(1, 10), txn(2, 20), txn(3, 400))
    right = frame(spark, "card_id string, t timestamp, v int",
                  ("c", left.where("txn_id=1").first().txn_time, 1),
                  ("c", left.where("txn_id=2").first().txn_time, 2), ("other", left.first().txn_time, 9))
    profile = profile_keys(left, "card_id", "txn_time", heavy_rows=heavy_rows)
    out = joins.asof_join(left, right, "card_id", "txn_time", "t", ["v"], strict, profile, slice_rows=1)
    assert by_id(out, "v") == want


def test_asof_join_does_not_match_missing_keys(spark):
    left = txns(spark, txn(1, 10, card=None))
    right = frame(spark, "card_id string, t timestamp, v int", (None, datetime(2024, 1, 1), 1))
    assert by_id(joins.asof_join(left, right, "card_id", "txn_time", "t", ["v"]), "v") == {1: None}


# ---- the whole table


def pipeline_input(spark):
    rows = [
        txn(i, i * 30_011 % 1_800_000, card=f"c{i % 7}", amount=float(i % 13), merchant="hot" if i % 3 else f"m{i % 5}",
            country=("US", "GB")[i % 2], declined=int(i % 11 == 0), fraud=int(i % 17 == 0), mcc=i % 4,
            confirmed=datetime(2024, 1, 12) if i % 17 == 0 else None)
        for i in range(150)
    ]
    dim = frame(spark, "merchant_id string, merchant_country string, merchant_risk_tier string",
                ("hot", "US", "high"), ("m1", "GB", "med"))
    return txns(spark, *rows).withColumn("txn_date", F.to_date("txn_time")), dim


def test_card_windows_share_one_exchange_and_one_sort(spark):
    df, _ = pipeline_input(spark)
    plan_text = plan_of(plan.card_history(df))
    assert plan_text.count("Exchange hashpartitioning(card_id") == 1
    assert plan_text.count("Sort [card_id") == 1


def test_light_cards_share_one_exchange_beside_a_heavy_one(spark):
    df, _ = pipeline_input(spark)
    one = df.withColumn("card_id", F.when(F.col("txn_id") % 3 == 0, "big").otherwise(F.col("card_id")))
    profile = profile_keys(one, "card_id", "txn_time", heavy_rows=40)
    assert [h[0] for h in profile.heavy] == ["big"]
    out = plan.card_history(one, profile)
    # by card alone: the light windows, and the small table of slice ends
    assert len(re.findall(r"Exchange hashpartitioning\(card_id#\d+, \d+\)", plan_of(out))) == 2
    a = by_id(out, "secs_since_last", "country_changed", "card_cnt_7d", "card_nmerch_24h")
    b = by_id(plan.card_history(one), "secs_since_last", "country_changed", "card_cnt_7d", "card_nmerch_24h")
    assert a == b


def test_encodings_are_lazy(spark):
    df, _ = pipeline_input(spark)
    sc = spark.sparkContext
    sc.setJobGroup("lazy", "encodings")
    h = encoding.known_history(df, "txn_time", "is_fraud", "label_confirmed_at", "2024-02-01", "2024-03-01")
    encoding.target_encoding(encoding.tally(h, ["merchant_id"]), "merchant_id")
    assert len(sc.statusTracker().getJobIdsForGroup("lazy")) == 0
    sc.setJobGroup("other", "")


def test_feature_table_same_with_low_and_high_bars(spark, monkeypatch):
    df, dim = pipeline_input(spark)
    line = Timeline(hist_end="2024-01-15", label_cutoff="2024-01-14")
    whole = {r.txn_id: r for r in plan.feature_table(df, dim, line).collect()}
    real = profile_many
    monkeypatch.setattr(plan, "profile_many", lambda d, k, t=None: real(d, k, t, heavy_rows=15))
    split = {r.txn_id: r for r in plan.feature_table(df, dim, line).collect()}
    assert whole.keys() == split.keys()
    for k, want in whole.items():
        got = split[k].asDict()
        for name, v in want.asDict().items():
            assert got[name] == (pytest.approx(v) if isinstance(v, float) else v), (k, name)


def test_range_build_equals_whole_build(spark):
    df, dim = pipeline_input(spark)
    line = Timeline(hist_end="2024-01-15", label_cutoff="2024-01-14")
    whole = {r.txn_id: r for r in plan.feature_table(df, dim, line).collect()}
    part = {r.txn_id: r for r in plan.feature_range(df, dim, line, "2024-01-24", "2024-01-26").collect()}
    assert part and set(part) == {k for k, r in whole.items() if str(r.txn_date) in ("2024-01-24", "2024-01-25")}
    for k, r in part.items():
        assert r.asDict() == whole[k].asDict()


def test_ranges_from_the_state_of_earlier_ones(spark, tmp_path):
    """Every range equals the whole build and reads its own days and the lead-in alone."""
    from datetime import date, timedelta

    from beforehand.sources import tables

    df, dim = pipeline_input(spark)
    line = Timeline(hist_end="2024-01-15", label_cutoff="2024-01-14")
    whole = {r.txn_id: r for r in plan.feature_table(df, dim, line).collect()}
    raw, state = str(tmp_path / "raw"), str(tmp_path / "state")
    tables.write_partitioned(df, raw)
    stored = tables.read_transactions(spark, raw)
    days = sorted({str(r.txn_date) for r in whole.values()})
    first, last = date.fromisoformat(days[0]), date.fromisoformat(days[-1])
    assert (last - first).days > plan.lead_in_days() + 4
    got, start = {}, first
    while start <= last:
        end = start + timedelta(days=7)
        part = plan.feature_range(stored, dim, line, str(start), str(end), state=state)
        scans = [s for s in plan_of(part).split("FileScan")[1:] if "/raw]" in s.split("ReadSchema")[0]]
        lead = start - timedelta(days=plan.lead_in_days())
        assert scans
        for s in scans:
            wanted = s.split("PartitionFilters: [")[1].split("]")[0]
            assert f">= {lead}" in wanted and f"<= {end}" in wanted, wanted
        got |= {r.txn_id: r for r in part.collect()}
        start = end
    assert got.keys() == whole.keys()
    for k, r in got.items():
        want = whole[k].asDict()
        assert {n: v for n, v in r.asDict().items()} == {n: (pytest.approx(v) if isinstance(v, float) else v) for n, v in want.items()}
    # a range built again gives the same, and one that begins elsewhere finds its own start
    for a, b in ((first + timedelta(days=7), first + timedelta(days=14)), (first + timedelta(days=9), first + timedelta(days=10))):
        for r in plan.feature_range(stored, dim, line, str(a), str(b), state=state).collect():
            assert r.secs_since_last == whole[r.txn_id].secs_since_last and r.card_cnt_7d == whole[r.txn_id].card_cnt_7d


def test_merchant_history_and_row_encoding_never_peek(spark):
    df, _ = pipeline_input(spark)
    df = df.cache()

    def features(rows):
        merch = by_id(merchant_view(spark, rows), "merch_cnt_7d", "merch_ncards_24h")
        te = by_id(
            encoding.target_encoding_asof(rows, "merchant_id", "txn_time", "is_fraud", "label_confirmed_at"),
            "merchant_id_te",
        )
        return merch, te

    whole = features(df)
    for cut in (20, 77, 149):
        t = df.where(F.col("txn_id") == cut).first().txn_time
        # nothing at or after t, and no label confirmed at or after t
        known = F.when(F.col("label_confirmed_at") < F.lit(t), F.col("label_confirmed_at"))
        before = df.where(F.col("txn_time") < F.lit(t)).withColumn("label_confirmed_at", known)
        row = df.where(F.col("txn_id") == cut)
        merch, te = features(before.unionByName(row))
        assert merch[cut] == whole[0][cut]
        assert te[cut] == pytest.approx(whole[1][cut])
    df.unpersist()


def test_counts_read_only_the_columns_they_need(spark):
    from beforehand.plans.queries import QUERIES

    text = plan_of(QUERIES["card_rolling_counts"](spark, "/root/testdata/sf0.001"))
    assert re.findall(r"ReadSchema: struct<([^>]*)>", text) == ["event_id:bigint,ts:timestamp_ntz,user_id:bigint"]
    te = plan_of(QUERIES["te_mcc_build"](spark, "/root/testdata/sf0.001"))
    assert "PushedFilters: [IsNotNull(ts), LessThan(ts," in te


@pytest.mark.parametrize("case_keys", [0, 16])
def test_key_values_by_case_and_by_table_agree(spark, monkeypatch, case_keys):
    from beforehand.operators import skew

    monkeypatch.setattr(skew, "CASE_KEYS", case_keys)
    df = txns(spark, *[txn(i, i, card=("a", "b", None)[i % 3]) for i in range(9)])
    profile = profile_keys(df, "card_id", "txn_time", heavy_rows=1)
    out = skew.with_key_values(df, profile, [("a", 7, 1), (None, 8, 2)], ["x", "y"])
    assert by_id(out, "x", "y") == {i: ((7, 1), (None, None), (8, 2))[i % 3] for i in range(9)}
