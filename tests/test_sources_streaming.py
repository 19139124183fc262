"""Readers, writers, snapshots, jobs and streams."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from beforehand.operators import quality
from beforehand.operators.buckets import bucket_counts
from beforehand.plans import jobs
from beforehand.session import shared_dir
from beforehand.sources import landing, schemas, snapshots, standin, tables
from beforehand.streaming import counters

from .helpers import TXN, by_id, frame, plan_of, txn, txns

SF = "/root/testdata/sf0.001"


def daily(spark):
    rows = [txn(i, datetime(2024, 1, 10 + i % 4, i % 24)) for i in range(40)]
    return txns(spark, *rows)


def test_landing_twice_leaves_one_copy(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = daily(spark)
    landing.land_raw(quality.concat(df, df), path)
    landing.land_raw(df, path)
    back = tables.read_transactions(spark, path)
    assert back.count() == 40 and back.select("txn_id").distinct().count() == 40


def test_rerun_of_one_day_leaves_other_days_alone(spark, tmp_path):
    path = str(tmp_path / "raw")
    df = tables.normalise(daily(spark))
    tables.write_partitioned(df, path)
    day = df.where("txn_date = '2024-01-11'").withColumn("amount", F.lit(99.0))
    tables.write_partitioned(day, path)
    back = tables.read_transactions(spark, path)
    assert back.count() == 40
    assert {str(r.txn_date) for r in back.where("amount = 99").collect()} == {"2024-01-11"}


def test_range_scan_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "raw")
    tables.write_partitioned(tables.normalise(daily(spark)), path)
    part = tables.read_transactions(spark, path, "2024-01-11", "2024-01-12")
    assert part.count() == 10
    text = plan_of(part.select("txn_id"))
    assert "PartitionFilters: [isnotnull(txn_date" in text
    assert "ReadSchema: struct<txn_id:bigint,txn_time:timestamp>" in text


def test_flat_input_and_zoneless_times_are_normalised(spark, tmp_path):
    path = str(tmp_path / "flat.parquet")
    df = daily(spark).withColumn("txn_time", F.col("txn_time").cast("timestamp_ntz"))
    df.write.parquet(path)
    back = tables.read_transactions(spark, path)
    assert dict(back.dtypes)["txn_time"] == "timestamp" and dict(back.dtypes)["txn_date"] == "date"


def test_schema_check_names_the_column(spark):
    df = daily(spark)
    with pytest.raises(schemas.SchemaError, match="amount"):
        schemas.check_schema(df.drop("amount"), schemas.TRANSACTIONS, tables.KEYS)
    with pytest.raises(schemas.SchemaError, match="declined"):
        schemas.check_schema(df.withColumn("declined", F.lit("x")), schemas.TRANSACTIONS, tables.KEYS)


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "snap")
    a, b = spark.range(3), spark.range(5)
    assert snapshots.history(spark, root).count() == 0
    with pytest.raises(LookupError):
        snapshots.read_snapshot(spark, root)
    assert snapshots.write_snapshot(a, root) == 0
    first = snapshots.history(spark, root).first().committed_at
    assert snapshots.write_snapshot(b, root, "REPLACE") == 1
    assert snapshots.read_snapshot(spark, root, version=0).count() == 3
    assert snapshots.read_snapshot(spark, root, as_of=first).count() == 3
    assert snapshots.read_snapshot(spark, root).count() == 5
    got = {(r.version, r.operation, r["rows"]) for r in snapshots.history(spark, root).collect()}
    assert got == {(0, "WRITE", 3), (1, "REPLACE", 5)}


def test_an_unfinished_snapshot_is_invisible(spark, tmp_path):
    root = str(tmp_path / "snap")
    snapshots.write_snapshot(spark.range(3), root)
    spark.range(9).write.parquet(f"{root}/data/snapshot_id=1")
    assert snapshots.read_snapshot(spark, root).count() == 3
    assert snapshots.write_snapshot(spark.range(4), root) == 1
    assert snapshots.read_snapshot(spark, root).count() == 4


def test_metrics_json(spark, tmp_path):
    path = str(tmp_path / "metrics")
    m = frame(spark, "split string, metric string, value double", ("a", "recall@1%FPR", 0.5), ("b", "n", 3.0))
    tables.write_metrics(m, path)
    assert {tuple(r) for r in tables.read_metrics(spark, path).where("value is not null").collect()} == {
        ("a", "recall@1%FPR", 0.5), ("b", "n", 3.0)}


def test_metrics_json_with_plain_numbers(spark, tmp_path):
    f = tmp_path / "m.json"
    f.write_text('{\n "run": {"pr_auc": 0.7, "n": 5},\n "best_iter": 12\n}')
    assert {tuple(r) for r in tables.read_metrics(spark, str(f)).collect()} == {
        ("run", "pr_auc", 0.7), ("run", "n", 5.0), ("best_iter", "best_iter", 12.0)}


def test_clustered_files_are_ordered(spark, tmp_path):
    path = str(tmp_path / "c")
    tables.cluster_write(spark.range(1000).withColumn("k", F.col("id") % 97), path, ["k", "id"], partitions=4)
    ranges = (
        spark.read.parquet(path).groupBy(F.input_file_name()).agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
        .orderBy("lo").collect()
    )
    assert len(ranges) == 4
    assert all(a.hi <= b.lo for a, b in zip(ranges, ranges[1:]))


def test_windows_over_a_bucketed_table_do_not_shuffle(spark, tmp_path):
    from beforehand.plans.features import card_history

    tables.create_schema(spark, "by_card", str(tmp_path / "by_card"))
    df = tables.normalise(daily(spark)).withColumn("card_id", F.concat(F.lit("c"), F.col("txn_id") % 5))
    tables.write_table(df, "by_card.silver", bucket_by=(4, "card_id"), sort_by=["card_id", "txn_time"])
    stored = spark.table("by_card.silver")
    assert "Exchange" not in plan_of(card_history(stored))
    names = ("card_cnt_7d", "secs_since_last")
    assert by_id(card_history(stored), *names) == by_id(card_history(df), *names)


def test_a_table_with_a_key_beyond_a_bucket_is_not_bucketed(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables._buckets_even, "__defaults__", (10,))
    tables.create_schema(spark, "uneven", str(tmp_path / "uneven"))
    df = tables.normalise(daily(spark))  # one card
    tables.write_table(df, "uneven.silver", bucket_by=(4, "card_id"), sort_by=["card_id", "txn_time"])
    assert spark.table("uneven.silver").count() == 40
    assert spark.sql("DESCRIBE EXTENDED uneven.silver").where("col_name = 'Num Buckets'").count() == 0


def test_shared_dir_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = shared_dir(spark, "x"), shared_dir(spark, "x")
    assert a != b and a.startswith(root)


def test_jobs_end_to_end(spark, tmp_path):
    raw, out = str(tmp_path / "in"), str(tmp_path / "features")
    t = standin.transactions(spark, "/root/testdata/sf0.01").drop("score")
    landing.land_raw(t, f"{raw}/transactions")
    standin.merchants(spark, "/root/testdata/sf0.01").write.parquet(f"{raw}/merchants.parquet")
    profile = jobs.build(spark, raw, f"{raw}/merchants.parquet", out, standin.TIMELINE, snapshot_root=str(tmp_path / "s"))
    assert [r.is_fraud for r in profile.collect()] == [0, 1]
    assert snapshots.read_snapshot(spark, str(tmp_path / "s")).count() == 10_000

    before = spark.read.parquet(out).agg(F.sum("card_cnt_7d"), F.sum("secs_since_last"), F.count("*")).first()
    # the same rows again pass the drift rule; a table with rows added does not
    again = lambda r: jobs.build(
        spark, r, f"{raw}/merchants.parquet", str(tmp_path / "again"), standin.TIMELINE,
        snapshot_root=str(tmp_path / "s"), max_drift=0.1,
    )
    again(raw)
    more = spark.read.parquet(f"{raw}/transactions")
    other = str(tmp_path / "more")
    more.unionByName(more.withColumn("txn_id", F.col("txn_id") + 10**9)).write.parquet(f"{other}/transactions")
    with pytest.raises(quality.GateError, match="row_drift"):
        again(other)
    jobs.build(spark, raw, f"{raw}/merchants.parquet", out, standin.TIMELINE, "2024-01-20", "2024-01-22")
    assert spark.read.parquet(out).agg(F.sum("card_cnt_7d"), F.sum("secs_since_last"), F.count("*")).first() == before

    metrics = jobs.train(spark, out, str(tmp_path / "results"), standin.TIMELINE, trees=3)
    got = {(r.split, r.metric): r.value for r in metrics.collect()}
    for run in ("A_honest_valid", "A_honest_test", "B_oracle_test", "random_split_holdout"):
        assert 0 <= got[run, "pr_auc"] <= 1 and 0 <= got[run, "recall@1%FPR"] <= 1
    assert got["A_honest_test", "n"] == 2006 and got["A_honest", "A_best_iter"] in (1, 2, 3)
    assert got["label_maturity", "positives"] == 120 and got["label_maturity", "known"] == 114
    assert ("business_threshold", "threshold") in got
    with pytest.raises(quality.GateError, match="pr_auc"):
        jobs.gate(metrics, floor=1.01)
    jobs.gate(metrics, floor=0.0, max_gap=1.0)
    from beforehand.operators.model import load_model, score
    from beforehand.sources.schemas import MODEL_INPUTS

    again = score(load_model(str(tmp_path / "results/model")), spark.read.parquet(out), MODEL_INPUTS)
    assert again.where("p between 0 and 1").count() == 10_000

    found = jobs.skew(spark, raw, f"{raw}/merchants.parquet")
    counts = {found[j].count() for j in ("sort_merge", "salted", "broadcast")}
    assert len(counts) == 1 and found["top_keys"].first().merchant_id == 0


def test_copied_input_stops_the_build(spark, tmp_path):
    raw = str(tmp_path / "in")
    t = standin.transactions(spark, SF)
    tables.write_partitioned(quality.concat(t, t), f"{raw}/transactions")
    standin.merchants(spark, SF).write.parquet(f"{raw}/merchants.parquet")
    with pytest.raises(quality.GateError, match="duplicate_rows"):
        jobs.build(spark, raw, f"{raw}/merchants.parquet", str(tmp_path / "o"), standin.TIMELINE)


# ---- streaming


def write_batches(spark, path, *batches):
    for rows in batches:
        frame(spark, TXN, *rows).coalesce(1).write.mode("append").parquet(path)


def test_stream_buckets_equal_batch_buckets(spark, tmp_path):
    path = str(tmp_path / "in")
    rows = [txn(i, i * 700, merchant=f"m{i % 3}") for i in range(60)]
    write_batches(spark, path, rows[:30], rows[30:])
    batch = spark.read.parquet(path)
    stream = counters.file_stream(spark, batch, path, files_per_batch=1)
    counters.run_available(counters.bucket_stream(stream, "merchant_id", "txn_time"), str(tmp_path / "o"), str(tmp_path / "c"))
    got = {(r.merchant_id, r.hr_ts): r.n for r in spark.read.parquet(str(tmp_path / "o")).collect()}
    closed = batch.agg(F.unix_timestamp(F.max("txn_time"))).first()[0] - 3600
    want = {
        (r.merchant_id, r.hr_ts): r.n
        for r in bucket_counts(batch, "merchant_id", "txn_time", "card_id").collect()
        if r.hr_ts + 3600 <= closed
    }
    assert got == want and got


def test_late_rows_are_left_out_and_repeats_dropped(spark, tmp_path):
    path = str(tmp_path / "in")
    # the watermark of a batch filters the batch after the next
    write_batches(
        spark, path, [txn(1, 0), txn(2, 20_000)], [txn(2, 20_000), txn(4, 40_000)], [txn(3, 10), txn(4, 40_000)]
    )
    files = counters.file_stream(spark, spark.read.parquet(path), path, files_per_batch=1)
    clean = counters.dedup_stream(files, "txn_id", "txn_time")
    counters.run_available(clean.select("txn_id"), str(tmp_path / "o"), str(tmp_path / "c"))
    assert sorted(r.txn_id for r in spark.read.parquet(str(tmp_path / "o")).collect()) == [1, 2, 4]


def test_names_by_id(spark):
    assert by_id(txns(spark, txn(1, 0)), "amount") == {1: 10.0}


# ---- landing


def landed(spark, path):
    rows = tables.read_transactions(spark, path).collect()
    return sorted((r.txn_id or 0, str(r.txn_date), r.amount) for r in rows)


def test_rows_without_a_time_are_kept(spark, tmp_path):
    path = str(tmp_path / "raw")
    timeless = lambda *ids: txns(spark, *[txn(i, 0, amount=float(i)) for i in ids]).withColumn("txn_time", F.lit(None).cast("timestamp"))
    landing.land_raw(quality.concat(timeless(1), txns(spark, txn(2, 5, amount=2.0))), path)
    landing.land_raw(quality.concat(timeless(3), txns(spark, txn(4, 5, amount=4.0))), path)
    landing.land_raw(timeless(1, 3), path)
    assert landed(spark, path) == [(1, "None", 1.0), (2, "2024-01-10", 2.0), (3, "None", 3.0), (4, "2024-01-10", 4.0)]
    # a time makes the row known
    landing.land_raw(txns(spark, txn(3, 9, amount=9.0)), path)
    assert landed(spark, path)[2] == (3, "2024-01-10", 9.0)


@pytest.mark.parametrize("later_first", [False, True])
def test_one_row_for_a_key_of_two_days(spark, tmp_path, later_first):
    path = str(tmp_path / "raw")
    day = 86_400
    early, later = txns(spark, txn(1, 10, amount=1.0), txn(2, 20)), txns(spark, txn(1, day + 10, amount=5.0), txn(3, 2 * day))
    for batch in (later, early) if later_first else (early, later):
        landing.land_raw(batch, path)
        landing.land_raw(batch, path)
    assert landed(spark, path) == [(1, "2024-01-10", 1.0), (2, "2024-01-10", 10.0), (3, "2024-01-12", 10.0)]
    # the day whose only row gave way is gone
    assert not (tmp_path / "raw/txn_date=2024-01-11").exists() or landed(spark, path)
    assert tables.read_transactions(spark, path).where("txn_date = '2024-01-11'").count() == 0


def test_landing_reads_only_days_of_its_keys(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "raw")
    day = 86_400
    landing.land_raw(txns(spark, *[txn(i, i * day) for i in range(12)]), path)
    asked = []
    real = landing.on_days
    monkeypatch.setattr(landing, "on_days", lambda days: asked.append(days) or real(days))
    landing.land_raw(txns(spark, txn(3, 20 * day), txn(50, 20 * day)), path)
    assert {str(d) for days in asked for d in days} == {"2024-01-13", "2024-01-30"}
    assert [r[:2] for r in landed(spark, path)][3] == (3, "2024-01-13") and len(landed(spark, path)) == 13


def test_tables_without_keys_folder_get_one(spark, tmp_path):
    path = str(tmp_path / "raw")
    tables.write_partitioned(tables.normalise(daily(spark)), path)
    moved = daily(spark).withColumn("txn_time", F.col("txn_time") + F.expr("interval 30 days")).limit(7)
    landing.land_raw(moved, path)
    back = tables.read_transactions(spark, path)
    assert back.count() == 40 and back.select("txn_id").distinct().count() == 40


def test_random_deliveries_leave_the_first_row_of_each_key(spark, tmp_path):
    import random

    rng, path, all_rows = random.Random(4), str(tmp_path / "raw"), []
    for _ in range(4):
        rows = [txn(rng.randint(1, 25), rng.randint(0, 5) * 86_400 + rng.randint(0, 3), amount=float(rng.randint(1, 99))) for _ in range(12)]
        all_rows += rows
        landing.land_raw(txns(spark, *rows), path)
    want = {}
    for r in sorted(all_rows, key=lambda r: (r[2], r[1], r[3])):
        want.setdefault(r[0], (r[0], str(r[2].date()), r[3]))
    assert landed(spark, path) == sorted(want.values())
