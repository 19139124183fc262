"""Even slices, keys beyond the list, and a profile of one scan."""

import re

import pytest
from pyspark.sql import functions as F

from beforehand.functions import epoch_micros
from beforehand.operators import encoding, joins, skew
from beforehand.operators.rolling import DAY, HOUR, Rolling, rolling, since_last
from beforehand.operators.skew import profile_keys, profile_many

from .helpers import plan_of


def burst(spark, n=200_000, light=300):
    """One key with all but two rows within an hour of a year, and light keys."""
    df = spark.range(n + light).select(
        F.when(F.col("id") < n, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 7)).alias("card_id"),
        F.col("id").alias("txn_id"),
        F.timestamp_seconds(
            F.when(F.col("id") == 0, 1_700_000_000)
            .when(F.col("id") == 1, 1_731_536_000)
            .otherwise(1_710_000_000 + F.pmod(F.col("id") * 7919, F.lit(3_600_000)) / 1000)
        ).alias("txn_time"),
        (F.col("id") % 13).cast("string").alias("txn_country"),
        (F.col("id") % 5 == 0).cast("long").alias("is_fraud"),
        F.lit(None).cast("timestamp").alias("label_confirmed_at"),
    )
    return df.withColumn(
        "label_confirmed_at", F.when(F.col("is_fraud") == 1, F.col("txn_time") + F.expr("interval 10 minutes"))
    )


@pytest.fixture(scope="module")
def bursty(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("burst"))
    burst(spark).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def test_a_burst_is_cut_evenly(bursty):
    profile = profile_keys(bursty, "card_id", "txn_time", heavy_rows=5_000)
    assert [h[:2] for h in profile.heavy] == [("hot", 200_000)]
    cut = skew.with_slice(bursty, profile, epoch_micros("txn_time"), slice_rows=1_000)
    sizes = {r[0]: r[1] for r in cut.groupBy("_slice").count().collect()}
    assert sizes.pop(-1) == 300
    assert sum(sizes.values()) == 200_000 and max(sizes.values()) < 2_000
    spans = cut.where("_slice >= 0").groupBy("_slice").agg(F.min("txn_time").alias("a"), F.max("txn_time").alias("b")).orderBy("_slice").collect()
    assert all(x.b < y.a for x, y in zip(spans, spans[1:]))


def test_a_sliced_burst_gives_the_same_rows(bursty):
    df = bursty.where("txn_id % 10 < 2 OR card_id <> 'hot'")
    profile = profile_keys(df, "card_id", "txn_time", heavy_rows=5_000)
    args = dict(changed={"txn_country": "changed"})
    whole = since_last(df, "card_id", "txn_time", "txn_id", **args)
    split = since_last(df, "card_id", "txn_time", "txn_id", profile=profile, slice_rows=500, **args)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, split.collect()))

    probes = df.select("txn_id", "card_id", F.col("txn_time").alias("at"))
    notes = df.where("txn_id % 3 = 0").select("card_id", "txn_time", F.col("txn_id").alias("seen"))
    plain = joins.asof_join(probes, notes, "card_id", "at", "txn_time", ["seen"])
    cut = joins.asof_join(probes, notes, "card_id", "at", "txn_time", ["seen"], profile=profile, slice_rows=500)
    assert sorted(plain.collect()) == sorted(cut.collect())

    te = ["card_id", "txn_time", "is_fraud", "label_confirmed_at"]
    big = profile_keys(df, "card_id", "txn_time", heavy_rows=10**9)
    whole = encoding.target_encoding_asof(df, *te, profile=big)
    split = encoding.target_encoding_asof(df, *te, profile=profile, slice_rows=500)
    rounded = lambda d: sorted(map(tuple, d.select("txn_id", F.round("card_id_te", 9)).collect()))
    assert rounded(whole) == rounded(split)


def test_rows_of_one_instant_share_a_slice(spark):
    df = spark.range(4_000).select(F.lit("a").alias("k"), F.timestamp_seconds(F.least("id", F.lit(1_000))).alias("t"))
    profile = profile_keys(df, "k", "t", heavy_rows=10)
    cut = skew.with_slice(df, profile, epoch_micros("t"), slice_rows=100)
    assert cut.groupBy("t").agg(F.count_distinct("_slice").alias("n")).agg(F.max("n")).first()[0] == 1
    sizes = sorted(r[1] for r in cut.groupBy("_slice").count().collect())
    assert sizes[-2] <= 200 and sizes[-1] >= 3_000


def test_missing_times_and_keys_are_kept(spark):
    df = spark.range(3_000).select(
        F.when(F.col("id") % 2 == 0, "a").alias("k"), F.when(F.col("id") % 5 > 0, F.timestamp_seconds("id")).alias("t"), "id"
    )
    profile = profile_keys(df, "k", "t", heavy_rows=10)
    cut = skew.with_slice(df, profile, epoch_micros("t"), slice_rows=100)
    assert cut.count() == 3_000 and cut.where("_slice < 0").count() == 0
    assert cut.where("t IS NULL AND _slice <> 0").count() == 0
    assert cut.select("k", "_slice").distinct().count() > 30


@pytest.fixture(scope="module")
def many_hot(spark):
    """Twenty keys of 400 rows, none the largest, and light ones."""
    return spark.range(8_100).select(
        F.when(F.col("id") < 8_000, F.concat(F.lit("h"), F.col("id") % 20)).otherwise(F.concat(F.lit("l"), F.col("id") % 9)).alias("card_id"),
        F.col("id").alias("txn_id"),
        F.timestamp_seconds(1_710_000_000 + F.pmod(F.col("id") * 7919, F.lit(90_000))).alias("txn_time"),
        (F.col("id") % 3).cast("string").alias("txn_country"),
        (F.col("id") % 4 == 0).cast("long").alias("is_fraud"),
        F.timestamp_seconds(1_710_000_000 + F.pmod(F.col("id") * 7919, F.lit(90_000)) + 500).alias("label_confirmed_at"),
    )


@pytest.mark.parametrize("max_heavy", [1, 10_000])
def test_keys_beyond_the_list_are_split_too(many_hot, monkeypatch, max_heavy):
    df = many_hot
    profile = profile_keys(df, "card_id", "txn_time", heavy_rows=100, max_heavy=max_heavy)
    assert profile.truncated == (max_heavy == 1) and len(profile.heavy) == min(max_heavy, 20)
    assert len(profile.above(100)) == 20
    cut = skew.with_slice(df, profile, epoch_micros("txn_time"), slice_rows=50)
    assert cut.where("_slice >= 0").count() == 8_000
    assert cut.groupBy("card_id", "_slice").count().agg(F.max("count")).first()[0] <= 100
    light, heavy = profile.split(df)
    assert light.count() == 100 and heavy.count() == 8_000

    whole = since_last(df, "card_id", "txn_time", "txn_id")
    split = since_last(df, "card_id", "txn_time", "txn_id", profile=profile, slice_rows=50)
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, split.collect()))
    notes = df.where("txn_id % 3 = 0").select("card_id", "txn_time", F.col("txn_id").alias("seen"))
    probes = df.select("txn_id", "card_id", F.col("txn_time").alias("at"))
    plain = joins.asof_join(probes, notes, "card_id", "at", "txn_time", ["seen"])
    walked = joins.asof_join(probes, notes, "card_id", "at", "txn_time", ["seen"], profile=profile, slice_rows=50)
    assert sorted(plain.collect()) == sorted(walked.collect())
    te = ["card_id", "txn_time", "is_fraud", "label_confirmed_at"]
    rounded = lambda d: sorted(map(tuple, d.select("txn_id", F.round("card_id_te", 9)).collect()))
    none = profile_keys(df, "card_id", "txn_time", heavy_rows=10**9)
    assert rounded(encoding.target_encoding_asof(df, *te, profile=none)) == rounded(
        encoding.target_encoding_asof(df, *te, profile=profile, slice_rows=50)
    )

    small = df.select("card_id").distinct().withColumn("tier", F.length("card_id"))
    salted = joins.salted_join(df, small, "card_id", profile, ["txn_id"], rows_per_salt=50, strategy=None)
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, df.join(small, "card_id").collect()))
    counts = dict(joins._salts_per_key(profile, 50, None))
    assert len(counts) == 20 and set(counts.values()) == {8}

    specs = [Rolling("n", "count", HOUR), Rolling("members", "distinct", DAY, "txn_country")]
    auto = rolling(df, "card_id", "txn_time", specs, profile=profile)
    window = rolling(df, "card_id", "txn_time", specs, route="window")
    assert sorted(map(tuple, auto.collect())) == sorted(map(tuple, window.collect()))


def test_profile_of_three_keys_scans_once(spark, bursty, monkeypatch):
    plans = []
    real = type(bursty).collect

    def collect(self):
        got = real(self)
        plans.append(plan_of(self).split("Initial Plan")[0])
        return got

    monkeypatch.setattr(type(bursty), "collect", collect)
    found = profile_many(bursty, ["card_id", "txn_country", "is_fraud"], "txn_time", heavy_rows=20_000)
    assert len(plans) == 1 and plans[0].count("FileScan") == 1 and plans[0].count("Expand") == 1
    for key, profile in found.items():
        alone = profile_keys(bursty, key, "txn_time", heavy_rows=20_000)
        assert alone == profile
        rows = bursty.groupBy(key).count()
        assert (profile.keys, profile.rows) == (rows.count(), 200_300)
        assert {h[0]: h[1] for h in profile.heavy} == {r[0]: r[1] for r in rows.collect() if r[1] > 20_000}


def test_micro_sweep_of_a_burst(bursty):
    df = bursty.where("txn_id % 40 < 2 OR card_id <> 'hot'")
    specs = [
        Rolling("n", "count", 10), Rolling("total", "sum", 60, "txn_id"), Rolling("members", "distinct", 30, "txn_country")
    ]
    swept = rolling(df, "card_id", "txn_time", specs, route="sweep", grain="micro")
    window = rolling(df, "card_id", "txn_time", specs, route="window", grain="micro")
    assert sorted(map(tuple, swept.select("txn_id", "n", "total", "members").collect())) == sorted(
        map(tuple, window.select("txn_id", "n", "total", "members").collect())
    )


def test_running_totals_over_even_slices(spark):
    events = spark.range(5_000).select(
        F.when(F.col("id") % 3 > 0, "a").alias("k"), F.when(F.col("id") < 4_900, F.col("id") % 40).otherwise(F.col("id")).alias("at"),
        F.lit(1).cast("long").alias("x"),
    ).groupBy("k", "at").agg(F.sum("x").alias("x"), F.sum("x").alias("y"))
    even = skew.running_totals(events, "k", "at", ["x"], ["y"], slice_rows=10)
    days = skew.running_totals(events, "k", "at", ["x"], ["y"], width=10**9)
    assert sorted(map(str, even.collect())) == sorted(map(str, days.collect()))


def test_second_grain_members_on_a_long_calendar(bursty):
    df = bursty.where("txn_id % 100 < 2 OR card_id <> 'hot'")
    specs = [Rolling("members", "distinct", DAY, "txn_country")]
    swept = rolling(df, "card_id", "txn_time", specs, route="sweep")
    window = rolling(df, "card_id", "txn_time", specs, route="window")
    assert sorted(map(tuple, swept.select("txn_id", "members").collect())) == sorted(
        map(tuple, window.select("txn_id", "members").collect())
    )


def shuffles(df):
    """Numbers of partitions that are asked for outright."""
    return [int(n) for n in re.findall(r"hashpartitioning\(.*, (\d+)\), REPARTITION_BY_NUM", plan_of(df))]


def test_a_sweep_is_dealt_out_by_its_rows(spark, many_hot, monkeypatch):
    """However few partitions the session starts with, a task's share is the same at every size."""
    specs = [Rolling("n", "count", HOUR), Rolling("total", "sum", DAY, "txn_id"), Rolling("members", "distinct", DAY, "txn_country")]
    df = many_hot.withColumn("card_id", F.when(F.col("card_id") != "h3", F.col("card_id")))
    names = ["txn_id", "card_id", "n", "total", "members"]
    same = lambda d: sorted(map(str, d.select(*names).collect()))
    window = same(rolling(df, "card_id", "txn_time", specs, route="window"))
    assert not shuffles(rolling(df, "card_id", "txn_time", specs, route="sweep"))
    monkeypatch.setattr(skew, "TASK_ROWS", 200)
    profile = profile_keys(df, "card_id", "txn_time", heavy_rows=100)
    for made in (
        rolling(df, "card_id", "txn_time", specs, route="sweep"),
        rolling(df, "card_id", "txn_time", specs, route="sweep", profile=profile),
        rolling(df, "card_id", "txn_time", specs, profile=profile),
        rolling(df, "card_id", "txn_time", specs, route="sweep", grain="micro"),
    ):
        assert len(shuffles(made)) >= 5 and set(shuffles(made)) == {41}
        assert same(made) == window
    half = rolling(df.where("txn_id < 4050"), "card_id", "txn_time", specs, route="sweep")
    assert set(shuffles(half)) == {21}
