"""Named queries over the test tables: one per operator, each over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import ratio_to_baseline, share_with_current
from ..operators import buckets, drift, encoding, evaluation, joins, model, quality, reports
from ..operators.rolling import DAY, HOUR, MINUTE, WEEK, Rolling, rolling, since_last, since_last_flagged
from ..operators.skew import profile_keys, profile_many
from ..session import shared_dir
from ..sources import landing, snapshots, standin, tables
from ..sources.schemas import MODEL_INPUTS
from ..streaming import counters
from ..streaming.rolling import rolling_rows
from . import features as plan

TIMELINE = standin.TIMELINE
# Low bars that send a share of the keys down the heavy-key route at any scale.
HOT_CARD_ROWS = 60
HOT_MERCHANT_ROWS = 100
HOT_SLICE_ROWS = 40
BACKFILL = [("2023-12-01", "2024-01-12"), ("2024-01-12", "2024-01-22"), ("2024-01-22", "2024-03-01")]


def _r(*names: str, digits: int = 4):
    return [F.round(n, digits).alias(n) for n in names]


def txns(spark: SparkSession, sf: str, country: bool = False) -> DataFrame:
    return standin.transactions(spark, sf, country)


# ---- rolling, card side


def card_rolling_counts(spark, sf):
    names = ["card_cnt_1h", "card_cnt_24h", "card_cnt_7d"]
    specs = [s for s in plan.card_specs() if s.name in names]
    return rolling(txns(spark, sf), "card_id", "txn_time", specs).select("txn_id", *names)


def card_rolling_amounts(spark, sf):
    names = ["card_sum_24h", "card_sum_7d", "card_mean_7d"]
    specs = [s for s in plan.card_specs() if s.name in names]
    return rolling(txns(spark, sf), "card_id", "txn_time", specs).select("txn_id", *_r(*names, digits=8))


CARD_COUNTS = ["card_cnt_1h", "card_cnt_24h", "card_cnt_7d", "card_nmerch_24h", "card_ncountry_1h",
               "card_declines_10m"]
CARD_AMOUNTS = ["card_sum_24h", "card_sum_7d", "card_mean_7d"]


def card_rolling_sweep(spark, sf):
    df = rolling(txns(spark, sf, country=True), "card_id", "txn_time", plan.card_specs(), route="sweep")
    return df.select("txn_id", *CARD_COUNTS, *_r(*CARD_AMOUNTS, digits=8))


def card_rolling_hot_split(spark, sf):
    t = txns(spark, sf, country=True)
    profile = profile_keys(t, "card_id", "txn_time", heavy_rows=HOT_CARD_ROWS)
    df = rolling(t, "card_id", "txn_time", plan.card_specs(), profile=profile)
    return df.select("txn_id", *CARD_COUNTS, *_r(*CARD_AMOUNTS, digits=8))


def card_rolling_micros(spark, sf):
    """Frames on the timestamp itself: earlier rows of the same second count."""
    specs = [Rolling("card_cnt_1h", "count", HOUR), Rolling("card_sum_24h", "sum", DAY, "amount")]
    df = rolling(txns(spark, sf), "card_id", "txn_time", specs, grain="micro")
    return df.select("txn_id", "card_cnt_1h", *_r("card_sum_24h"))


def merchant_rolling_micros_sweep(spark, sf):
    specs = [Rolling("merch_cnt_1h", "count", HOUR), Rolling("merch_ncards_24h", "distinct", DAY, "card_id")]
    df = rolling(txns(spark, sf), "merchant_id", "txn_time", specs, route="sweep", grain="micro")
    return df.select("txn_id", "merch_cnt_1h", "merch_ncards_24h")


def card_distinct_exact(spark, sf):
    specs = [s for s in plan.card_specs() if s.agg == "distinct"]
    return rolling(txns(spark, sf, country=True), "card_id", "txn_time", specs).select(
        "txn_id", "card_nmerch_24h", "card_ncountry_1h"
    )


def card_distinct_approx(spark, sf):
    specs = [s for s in plan.card_specs(approximate=True) if s.agg == "approx_distinct"]
    return rolling(txns(spark, sf, country=True), "card_id", "txn_time", specs).select(
        "txn_id", "card_nmerch_24h", "card_ncountry_1h"
    )


def card_declines_10m(spark, sf):
    spec = [Rolling("card_declines_10m", "sum", 10 * MINUTE, "declined")]
    return rolling(txns(spark, sf), "card_id", "txn_time", spec).select("txn_id", "card_declines_10m")


def card_velocity_ratios(spark, sf):
    specs = [s for s in plan.card_specs() if s.name in ("card_mean_7d", "card_sum_24h")]
    return rolling(txns(spark, sf), "card_id", "txn_time", specs).select(
        "txn_id",
        F.round(ratio_to_baseline("amount", "card_mean_7d"), 4).alias("amt_ratio_7d"),
        F.round(share_with_current("amount", "card_sum_24h"), 4).alias("amt_over_card_sum_24h"),
    )


def _since_last(spark, sf, heavy_rows=None, slice_rows=None):
    t = txns(spark, sf, country=True)
    bar = {"heavy_rows": heavy_rows} if heavy_rows else {}
    return since_last(
        t, "card_id", "txn_time", "txn_id", changed={"txn_country": "country_changed"},
        profile=profile_keys(t, "card_id", "txn_time", **bar), slice_rows=slice_rows,
    )


def time_since_last(spark, sf):
    return _since_last(spark, sf).select("txn_id", "secs_since_last")


def country_changed(spark, sf):
    return _since_last(spark, sf).select("txn_id", "country_changed")


def since_last_hot_split(spark, sf):
    df = _since_last(spark, sf, HOT_CARD_ROWS, HOT_SLICE_ROWS)
    return df.select("txn_id", "secs_since_last", "country_changed")


def secs_since_decline(spark, sf):
    df = since_last_flagged(txns(spark, sf), "card_id", "txn_time", "txn_id", "declined", "secs_since_decline")
    return df.select("txn_id", "secs_since_decline")


# ---- rolling, merchant side


def merchant_hourly_buckets(spark, sf):
    return buckets.bucket_counts(txns(spark, sf), "merchant_id", "txn_time", "card_id")


def merchant_rolling_bucketed(spark, sf):
    hourly = buckets.bucket_counts(txns(spark, sf), "merchant_id", "txn_time", "card_id")
    return buckets.rolling_buckets(hourly, "merchant_id", "merch_cnt_7d", "merch_ncards_24h")


def merchant_distinct_hll(spark, sf):
    hourly = buckets.bucket_counts(txns(spark, sf), "merchant_id", "txn_time", "card_id", distinct="sketch")
    return buckets.rolling_buckets(hourly, "merchant_id", "merch_cnt_7d", "merch_ncards_24h", sketched=True)


def merchant_bucket_joinback(spark, sf):
    t = txns(spark, sf)
    profile = profile_keys(t, "merchant_id", "txn_time", heavy_rows=HOT_MERCHANT_ROWS)
    return plan.merchant_history(t, t, profile).select("txn_id", "merch_cnt_7d", "merch_ncards_24h")


def merchant_rolling_count_sweep(spark, sf):
    specs = [Rolling("merch_cnt_24h", "count", DAY), Rolling("merch_cnt_7d", "count", WEEK),
             Rolling("merch_sum_24h", "sum", DAY, "amount")]
    df = rolling(txns(spark, sf), "merchant_id", "txn_time", specs, route="sweep")
    return df.select("txn_id", "merch_cnt_24h", "merch_cnt_7d", *_r("merch_sum_24h"))


def merchant_rolling_distinct_sweep(spark, sf):
    specs = [Rolling("merch_ncards_24h", "distinct", DAY, "card_id")]
    df = rolling(txns(spark, sf), "merchant_id", "txn_time", specs, route="sweep")
    return df.select("txn_id", "merch_ncards_24h")


# ---- target encoding


def _history(t):
    return encoding.known_history(
        t, "txn_time", "is_fraud", "label_confirmed_at", TIMELINE.hist_end, TIMELINE.label_cutoff
    )


def te_merchant_build(spark, sf):
    te = encoding.target_encoding(encoding.tally(_history(txns(spark, sf)), ["merchant_id"]), "merchant_id")
    return te.select("merchant_id", *_r("merchant_id_te", digits=6))


def te_mcc_build(spark, sf):
    te = encoding.target_encoding(encoding.tally(_history(txns(spark, sf)), ["mcc"]), "mcc")
    return te.select("mcc", *_r("mcc_te", digits=6))


def te_applied_with_prior(spark, sf):
    t = txns(spark, sf)
    df = plan.encodings(t, t, TIMELINE, profile_many(t, plan.ENCODED, "txn_time"))
    return df.select("txn_id", *_r("merchant_id_te", "mcc_te", digits=6))


def te_merchant_row_asof(spark, sf):
    df = encoding.target_encoding_asof(
        txns(spark, sf), "merchant_id", "txn_time", "is_fraud", "label_confirmed_at"
    )
    return df.select("txn_id", *_r("merchant_id_te", digits=6))


def te_row_asof_hot_split(spark, sf):
    t = txns(spark, sf)
    df = encoding.target_encoding_asof(
        t, "merchant_id", "txn_time", "is_fraud", "label_confirmed_at", prior=0.05,
        profile=profile_keys(t, "merchant_id", "txn_time", heavy_rows=HOT_MERCHANT_ROWS),
        slice_rows=HOT_SLICE_ROWS,
    )
    return df.select("txn_id", *_r("merchant_id_te", digits=6))


def te_weekly_versions(spark, sf):
    te = encoding.target_encoding_by_period(
        txns(spark, sf), "merchant_id", "txn_time", "is_fraud", "label_confirmed_at", period="week"
    )
    return te.select(
        "merchant_id", F.unix_timestamp("period").alias("period_ts"), "n", "hits", *_r("merchant_id_te", digits=6)
    )


def te_weekly_applied(spark, sf):
    """Each transaction with the encoding version in force at its time."""
    t = txns(spark, sf)
    te = encoding.target_encoding_by_period(
        t, "merchant_id", "txn_time", "is_fraud", "label_confirmed_at", period="week"
    )
    out = joins.asof_join(t, te, "merchant_id", "txn_time", "period", ["merchant_id_te"], strict=False)
    return out.select("txn_id", *_r("merchant_id_te", digits=6))


# ---- context and joins


def dim_enrich_context(spark, sf):
    return plan.context(txns(spark, sf, country=True), standin.merchants(spark, sf)).select(
        "txn_id", "cross_border", "is_ecom", "risk_tier_num"
    )


def calendar_context(spark, sf):
    t = txns(spark, sf)
    return t.select(
        "txn_id",
        F.unix_timestamp("txn_time").alias("ts"),
        F.unix_timestamp(F.date_trunc("hour", "txn_time")).alias("hr_ts"),
        F.date_format("txn_date", "yyyy-MM-dd").alias("txn_date"),
        F.hour("txn_time").alias("hour_of_day"),
        plan.weekend_flag("txn_time").alias("is_weekend"),
    )


def _lines(spark, sf):
    return standin.skewed_lines(spark, sf).select("l_orderkey", "l_linenumber", "merchant_id", "l_extendedprice")


def _dim(spark, sf):
    return standin.merchants(spark, sf).select("merchant_id", "merchant_country", "merchant_risk_tier")


def join_sort_merge(spark, sf):
    return joins.merge_join(_lines(spark, sf), _dim(spark, sf), "merchant_id")


def join_salted(spark, sf):
    lines = _lines(spark, sf)
    hot = profile_keys(lines, "merchant_id", heavy_rows=2 * HOT_MERCHANT_ROWS)
    return joins.salted_join(lines, _dim(spark, sf), "merchant_id", hot, rows_per_salt=HOT_SLICE_ROWS)


def join_salted_all_keys(spark, sf):
    return joins.salted_join(_lines(spark, sf), _dim(spark, sf), "merchant_id", None)


def join_broadcast(spark, sf):
    return joins.lookup_join(_lines(spark, sf), _dim(spark, sf), "merchant_id", how="inner")


def join_lookup_left(spark, sf):
    return joins.lookup_join(_lines(spark, sf), _dim(spark, sf), "merchant_id")


def _last_amount(t, by, **kw):
    right = t.select(by, "txn_time", F.col("amount").alias("last_amount"), F.col("txn_id").alias("last_txn_id"))
    return joins.asof_join(t, right, by, "txn_time", "txn_time", ["last_txn_id", "last_amount"], **kw)


def asof_lookup(spark, sf):
    """The card's latest earlier transaction, found by (key, time)."""
    return _last_amount(txns(spark, sf), "card_id").select("txn_id", "last_txn_id", "last_amount")


def asof_lookup_hot_split(spark, sf):
    t = txns(spark, sf)
    profile = profile_keys(t, "merchant_id", "txn_time", heavy_rows=HOT_MERCHANT_ROWS)
    out = _last_amount(t, "merchant_id", profile=profile, slice_rows=HOT_SLICE_ROWS)
    return out.select("txn_id", "last_txn_id", "last_amount")


# ---- reports and quality


def key_skew_report(spark, sf):
    return reports.key_skew(txns(spark, sf), "merchant_id").select("merchant_id", "n", *_r("share", digits=6))


def key_skew_topk(spark, sf):
    return reports.top_keys(_lines(spark, sf), "merchant_id", 3).select("merchant_id", "n")


def ranked_share_report(spark, sf):
    """Rows per category with their percentage, through a CSV file."""
    counts = reports.key_skew(txns(spark, sf), "mcc").select(F.col("mcc").cast("string").alias("feature"), "n")
    path = shared_dir(spark, "ranked")
    tables.write_importance(reports.ranked_share(counts, "feature", "n"), path)
    return tables.read_importance(spark, path, "feature string, n long, n_pct double")


def key_attribute_lookup(spark, sf):
    """Each line's merchant category, looked up by key."""
    dim = standin.merchants(spark, sf).select("merchant_id", "mcc")
    found = joins.lookup_join(_lines(spark, sf), dim, "merchant_id")
    return found.groupBy("mcc").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.col("l_extendedprice").cast("decimal(18,2)")).cast("double"), 2).alias("total")
    )


def input_partitions(spark, sf):
    return reports.input_partitions(txns(spark, sf))


def partition_skew(spark, sf):
    lines = _lines(spark, sf)
    salt = F.pmod(F.xxhash64(*lines.columns), F.lit(joins.DEFAULT_SALTS))
    plain = reports.shuffle_sizes(lines, ["merchant_id"], 32)
    spread = reports.shuffle_sizes(lines, ["merchant_id", salt], 32)
    return plain.withColumn("layout", F.lit("key")).unionByName(spread.withColumn("layout", F.lit("key+salt")))


def dedup_transactions(spark, sf):
    t = txns(spark, sf)
    return quality.dedup(quality.concat(t, t, t), ["txn_id"], ["txn_time"]).select(
        "txn_id", "card_id", "merchant_id", "amount", "is_fraud"
    )


def quality_checks(spark, sf):
    t = txns(spark, sf)
    return quality.table_checks(quality.concat(t, t), "txn_id", ["label_confirmed_at", "merchant_id"]).select(
        "metric", *_r("value", digits=6)
    )


GATE_RULES = [("rows", "min", 1.0), ("duplicate_rows", "max", 0.0), ("null_rate_merchant_id", "max", 0.0),
              ("pr_auc", "min", 0.6)]


def quality_gate(spark, sf):
    t = txns(spark, sf)
    checks = quality.table_checks(quality.concat(t, t), "txn_id", ["merchant_id"])
    curve = evaluation.score_curve(t, "score", "is_fraud")
    measured = evaluation.ranking_metrics(curve).select(
        F.lit("pr_auc").alias("metric"), F.col("pr_auc").alias("value")
    )
    broken = quality.gate(quality.concat(checks, measured), GATE_RULES)
    return broken.select("metric", "op", "bound", *_r("value", digits=6))


def dataset_profile(spark, sf):
    p = reports.dataset_profile(txns(spark, sf), "txn_time", "is_fraud")
    return p.select(
        "rows", "positives", *_r("rate", digits=6),
        F.unix_timestamp("first_time").alias("first_ts"), F.unix_timestamp("last_time").alias("last_ts"),
    )


def _splits(spark, sf):
    return evaluation.temporal_split(txns(spark, sf), "txn_time", TIMELINE.ranges)


def label_maturity(spark, sf):
    train = _splits(spark, sf).where("split = 'train'")
    return reports.label_maturity(train, "is_fraud", "label_confirmed_at", standin.EARLY_CUTOFF).select(
        "positives", "known", *_r("known_share", digits=6)
    )


def temporal_split_counts(spark, sf):
    return _splits(spark, sf).groupBy("split").agg(
        F.count(F.lit(1)).alias("n"), F.sum("is_fraud").alias("positives")
    )


def union_splits(spark, sf):
    s = _splits(spark, sf)
    parts = [s.where(F.col("split") == name) for name in TIMELINE.ranges]
    return quality.concat(*parts).select("txn_id", "split", "amount")


def class_weight(spark, sf):
    train = _splits(spark, sf).where("split = 'train'")
    return reports.class_weight(train, "is_fraud").select("n_pos", "n_neg", *_r("pos_weight", digits=6))


def honest_labels(spark, sf):
    known = encoding.known_label("is_fraud", "label_confirmed_at", TIMELINE.label_cutoff)
    return txns(spark, sf).select("txn_id", known.alias("y_honest"), F.col("is_fraud").alias("y_oracle"))


def class_profile(spark, sf):
    f = feature_rows(spark, sf)
    return reports.class_profile(
        f, "is_fraud",
        {"cnt_24h": ("card_cnt_24h", 4), "secs_since_last": ("secs_since_last", 2),
         "amt_ratio_7d": ("amt_ratio_7d", 4), "declines_10m": ("card_declines_10m", 4),
         "merchant_te": ("merchant_id_te", 4)},
    )


def drift_from_sketches(spark, sf):
    """Amounts of the train days against the test days, from a sketch a day: whether the stability index and every
    bin's share stay within the stated error of those from all rows."""
    start, end = (TIMELINE.train, TIMELINE.test)
    path = shared_dir(spark, "sketches")
    tables.write_partitioned(drift.daily_sketches(txns(spark, sf), ["amount"]), path)
    stored = drift.stored_drift(spark.read.parquet(path), start, end)
    exact = psi_drift(spark, sf).select("bin", F.col("n_ref").alias("ref"), F.col("n_act").alias("act"))
    total = [F.sum(c).over(Window.partitionBy(F.lit(0))) for c in ("ref", "act")]  # ten rows
    exact = exact.withColumns({"ref_share": F.col("ref") / total[0], "act_share": F.col("act") / total[1]})
    off = lambda c: F.abs(F.col(f"n_{c}") / F.col(f"_{c}") - F.col(f"{c}_share"))
    sums = stored.agg(F.sum("n_ref").alias("_ref"), F.sum("n_act").alias("_act"))
    both = stored.join(exact, "bin", "full").crossJoin(F.broadcast(sums))
    bound = 4 * drift.RANK_ERROR
    return both.groupBy("column").agg(
        F.count("bin").alias("bins"),
        F.sum("ref").alias("n_ref"),
        F.sum("act").alias("n_act"),
        (F.max(off("ref")) <= bound).alias("ref_within"),
        (F.max(off("act")) <= bound).alias("act_within"),
    )


def psi_drift(spark, sf):
    s = _splits(spark, sf)
    d = reports.column_drift(s.where("split = 'train'"), s.where("split = 'test'"), "amount")
    return d.select("bin", "n_ref", "n_act", *_r("psi", digits=6))


# ---- evaluation


def _curve(spark, sf):
    return evaluation.score_curve(txns(spark, sf), "score", "is_fraud")


def average_precision(spark, sf):
    return evaluation.ranking_metrics(_curve(spark, sf)).select(*_r("pr_auc", digits=6))


def roc_auc(spark, sf):
    return evaluation.ranking_metrics(_curve(spark, sf)).select(*_r("roc_auc", digits=6))


def metrics_by_split(spark, sf):
    curve = evaluation.score_curve(_splits(spark, sf), "score", "is_fraud", by=["split"])
    return evaluation.ranking_metrics(curve, ["split"]).select(
        "split", *_r("pr_auc", "roc_auc", digits=6), "n", "n_pos"
    )


RECALLS = ["recall_1pct", "threshold_1pct", "recall_0_1pct", "threshold_0_1pct"]


def recall_at_fpr(spark, sf):
    return evaluation.recall_at_fpr(_curve(spark, sf)).select(*_r(*RECALLS, digits=6))


def recall_at_fpr_corners(spark, sf):
    points = evaluation.recall_at_fpr(_curve(spark, sf), corners_only=True)
    return points.select(*_r(*RECALLS, digits=6))


def leakage_gap_given_scores(spark, sf):
    """Average precision on a scattered holdout against the test period, for one score column."""
    s = _splits(spark, sf)
    scattered = s.where((F.col("txn_id") * 7919) % 10 >= 7)

    def pr_auc(rows, run):
        m = evaluation.ranking_metrics(evaluation.score_curve(rows, "score", "is_fraud"))
        return m.select(F.col("pr_auc").alias(run))

    both = quality.concat(pr_auc(scattered, "random_holdout"), pr_auc(s.where("split = 'test'"), "time_test"))
    random, timed = F.max("random_holdout"), F.max("time_test")
    out = both.agg(random.alias("random_holdout"), timed.alias("time_test"), *evaluation.leakage_gap(random, timed))
    return out.select(*_r("random_holdout", "time_test", "gap", digits=6), "alarm")


def _test_rows(spark, sf):
    return _splits(spark, sf).where("split = 'test'")


def cost_curve(spark, sf):
    c = evaluation.cost_curve(_test_rows(spark, sf), "score", "is_fraud", "amount")
    return c.select(*_r("threshold", "missed", "false_decline_cost", "cost"), "tp", "fp",
                    *_r("recall", "precision", digits=6))


def cost_threshold(spark, sf):
    c = evaluation.cost_curve(_test_rows(spark, sf), "score", "is_fraud", "amount")
    return evaluation.best_threshold(c).select(
        *_r("threshold", "cost", "missed", "false_decline_cost", digits=2), *_r("recall", "precision")
    )


def confusion_at_threshold(spark, sf):
    """Tuned on the validation split, reported on the test split."""
    s = _splits(spark, sf)
    tuned = evaluation.best_threshold(
        evaluation.cost_curve(s.where("split = 'valid'"), "score", "is_fraud", "amount")
    ).select("threshold")
    out = evaluation.confusion_at(s.where("split = 'test'"), "score", "is_fraud", tuned.scalar(), "amount")
    return out.select("tp", "fp", "fn", "tn", *_r("missed", digits=2), *_r("recall", "precision"))


def dedup_missing_keys(spark, sf):
    """Rows of one merchant in ten have lost their key: none of those is a copy of another."""
    t = txns(spark, sf).withColumn("txn_id", F.when(F.col("merchant_id") % 10 != 3, F.col("txn_id")))
    kept = quality.dedup(quality.concat(t, t), ["txn_id"], ["txn_time"])
    return kept.select("txn_id", "card_id", "merchant_id", "amount")


# ---- sources and sinks


def partitioned_roundtrip(spark, sf):
    """Land day-partitioned rows twice and read them back: still one copy."""
    path = shared_dir(spark, "landing")
    t = txns(spark, sf, country=True)
    landing.land_raw(t, path)
    landing.land_raw(t, path)
    back = tables.read_transactions(spark, path)
    return back.select("txn_id", "card_id", "amount", F.date_format("txn_date", "yyyy-MM-dd").alias("txn_date"))


def land_late_rows(spark, sf):
    """All rows but every day's first hour, then those, late. Some come again dated days later, some have no time.

    Each day holds all of its rows, each key one; rows of either batch without a time stay.
    """
    path = shared_dir(spark, "landing")
    t = txns(spark, sf, country=True)
    late = F.hour("txn_time") == 0
    new_id = (F.col("txn_id") + 1_000_000_000_000).alias("txn_id")
    timeless = t.where("txn_id % 50 = 0").withColumns({"txn_id": new_id, "txn_time": F.lit(None).cast("timestamp")}).drop("txn_date")
    timeless = tables.normalise(timeless)
    again = tables.normalise(t.where("txn_id % 20 = 3").withColumn("txn_time", F.expr("txn_time + interval 5 days")).drop("txn_date"))
    landing.land_raw(quality.concat(t.where(~late), timeless.where("txn_id % 100 = 0")), path)
    landing.land_raw(quality.concat(t.where(late), again, timeless.where("txn_id % 100 <> 0")), path)
    back = tables.read_transactions(spark, path)
    return back.select("txn_id", "card_id", "amount", F.date_format("txn_date", "yyyy-MM-dd").alias("txn_date"))


def pruned_range_scan(spark, sf):
    path = shared_dir(spark, "landing")
    tables.write_partitioned(txns(spark, sf, country=True), path)
    start, end = TIMELINE.train
    return tables.read_transactions(spark, path, start, end).select("txn_id", "amount")


def catalog_table_roundtrip(spark, sf):
    root = shared_dir(spark, "tables")
    schema = "t" + root[-12:]
    tables.create_schema(spark, schema, root)
    tables.write_table(txns(spark, sf), f"{schema}.bronze_transactions", "txn_date")
    tables.write_table(standin.merchants(spark, sf), f"{schema}.dim_merchant")
    t, m = spark.table(f"{schema}.bronze_transactions"), spark.table(f"{schema}.dim_merchant")
    return joins.lookup_join(t, m.drop("mcc"), "merchant_id").select("txn_id", "merchant_id", "merchant_country")


def bucketed_table_windows(spark, sf):
    """Card windows over a table stored by card: its rows need no shuffle."""
    root = shared_dir(spark, "bucketed")
    schema = "b" + root[-12:]
    tables.create_schema(spark, schema, root)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    tables.write_table(
        txns(spark, sf), f"{schema}.silver", bucket_by=(buckets, "card_id"), sort_by=["card_id", "txn_time"]
    )
    specs = [s for s in plan.card_specs() if s.name in ("card_cnt_24h", "card_cnt_7d")]
    df = rolling(spark.table(f"{schema}.silver"), "card_id", "txn_time", specs)
    return df.select("txn_id", "card_cnt_24h", "card_cnt_7d")


def clustered_files(spark, sf):
    path = shared_dir(spark, "clustered")
    tables.cluster_write(txns(spark, sf), path, ["card_id", "txn_time"])
    return tables.read_features(spark, path, ["txn_id", "card_id", "amount"])


def snapshot_asof_read(spark, sf):
    """Version 0 stays readable after version 1 replaced the rows."""
    root = shared_dir(spark, "snapshots")
    t = txns(spark, sf).select("txn_id", "card_id", "amount")
    snapshots.write_snapshot(t, root)
    snapshots.write_snapshot(t.withColumn("amount", F.col("amount") * 2), root, "REPLACE")
    return snapshots.read_snapshot(spark, root, version=0)


def snapshot_history(spark, sf):
    root = shared_dir(spark, "snapshots")
    t = txns(spark, sf).select("txn_id", "is_fraud")
    snapshots.write_snapshot(t, root)
    snapshots.write_snapshot(t.where("is_fraud = 1"), root, "REPLACE")
    return snapshots.history(spark, root).select("version", "operation", "rows")


def row_count_drift(spark, sf):
    """A build that lost the rows of one merchant in ten, against the version before it."""
    root = shared_dir(spark, "snapshots")
    t = txns(spark, sf).select("txn_id", "merchant_id")
    snapshots.write_snapshot(t, root)
    drift = quality.row_drift(t.where("merchant_id % 10 <> 3"), snapshots.history(spark, root))
    return drift.select("metric", *_r("value", digits=6))


def metrics_json_roundtrip(spark, sf):
    path = shared_dir(spark, "metrics")
    curve = evaluation.score_curve(_splits(spark, sf), "score", "is_fraud", by=["split"])
    m = evaluation.ranking_metrics(curve, ["split"]).where("split is not null")
    long = m.select("split", "pr_auc", "roc_auc").unpivot("split", ["pr_auc", "roc_auc"], "metric", "value")
    tables.write_metrics(long, path)
    return tables.read_metrics(spark, path).select("split", "metric", *_r("value", digits=6))


# ---- flagship


def feature_rows(spark, sf, approximate=False):
    return plan.feature_table(txns(spark, sf, country=True), standin.merchants(spark, sf), TIMELINE, approximate)


FEATURE_ROUNDED = ["card_sum_24h", "card_sum_7d", "card_mean_7d", "amt_ratio_7d", "amt_over_card_sum_24h",
                   "merchant_id_te", "mcc_te"]


def _feature_columns(df):
    plain = [c for c in MODEL_INPUTS if c not in FEATURE_ROUNDED]
    return df.select("txn_id", "card_id", "merchant_id", "is_fraud", *plain, *_r(*FEATURE_ROUNDED, digits=8))


def feature_table_full(spark, sf):
    return _feature_columns(feature_rows(spark, sf))


def feature_table_approx(spark, sf):
    return _feature_columns(feature_rows(spark, sf, approximate=True))


def silver_feature_table(spark, sf):
    """Bronze and dimension tables of the catalog to a feature table by day, read back."""
    root = shared_dir(spark, "silver")
    schema = "s" + root[-12:]
    tables.create_schema(spark, schema, root)
    tables.write_table(txns(spark, sf, country=True), f"{schema}.bronze_transactions", "txn_date")
    tables.write_table(standin.merchants(spark, sf), f"{schema}.dim_merchant")
    t, m = spark.table(f"{schema}.bronze_transactions"), spark.table(f"{schema}.dim_merchant")
    tables.write_table(plan.feature_table(t, m, TIMELINE), f"{schema}.silver_features", "txn_date")
    return _feature_columns(spark.table(f"{schema}.silver_features"))


def backfill_by_range(spark, sf):
    """The feature table built range by range into one folder, each range from the state of the last, then read back."""
    path, raw, state = (shared_dir(spark, label) for label in ("backfill", "landing", "state"))
    tables.write_partitioned(txns(spark, sf, country=True), raw)
    t, m = tables.read_transactions(spark, raw), standin.merchants(spark, sf)
    for start, end in BACKFILL:
        tables.write_partitioned(plan.feature_range(t, m, TIMELINE, start, end, state=state), path)
    return _feature_columns(tables.read_features(spark, path))


# ---- model


def _written_features(spark, sf):
    """The feature table written once and read back, split and with both labels."""
    path = shared_dir(spark, "features")
    tables.write_partitioned(feature_rows(spark, sf), path)
    f = evaluation.split_parts(spark.read.parquet(path), "txn_time", TIMELINE.ranges)
    return f.withColumn(
        "y_honest", encoding.known_label("is_fraud", "label_confirmed_at", TIMELINE.label_cutoff)
    )


def _fit(f, label, trees=10):
    rows = f.where("split in ('train', 'valid')").withColumn("in_valid", F.col("split") == "valid")
    rows = rows.withColumn("y", F.when(F.col("in_valid"), F.col("is_fraud")).otherwise(F.col(label)))
    return model.fit_gbt(rows, MODEL_INPUTS, "y", valid="in_valid", trees=trees)


def gbt_scores(spark, sf):
    """Test rows scored by a model that was saved and loaded again."""
    f = _written_features(spark, sf)
    path = shared_dir(spark, "model")
    model.save_model(_fit(f, "y_honest"), path)
    scored = model.score(model.load_model(path), f.where("split = 'test'"), MODEL_INPUTS)
    return scored.select("txn_id", "is_fraud", "p")


def gbt_rounds(spark, sf):
    """Average precision on the validation rows after each round, and whether the fit ends there."""
    rows = _written_features(spark, sf).where("split in ('train', 'valid')").withColumn("in_valid", F.col("split") == "valid")
    rows = rows.withColumn("y", F.when(F.col("in_valid"), F.col("is_fraud")).otherwise(F.col("y_honest")))
    whole = model.fit_gbt(rows.where("NOT in_valid"), MODEL_INPUTS, "y", trees=10, columns=0.8)
    found = model.rounds_by_average_precision(whole, rows.where("in_valid"), MODEL_INPUTS, "y")
    best = found.agg(F.max_by("round", F.struct("pr_auc", -F.col("round"))).alias("best"))
    return found.join(F.broadcast(best)).select("round", "pr_auc", (F.col("round") == F.col("best")).alias("is_best"))


def importance_topk(spark, sf):
    f = _written_features(spark, sf)
    return model.importance(f, _fit(f, "y_honest"), MODEL_INPUTS, 10)


def calibrated_scores(spark, sf):
    f = _written_features(spark, sf)
    scored = model.score(_fit(f, "y_honest"), f.where("split in ('valid', 'test')"), MODEL_INPUTS)
    fitted = model.fit_calibration(scored.where("split = 'valid'"), "p", "is_fraud")
    return model.calibrate(fitted, scored.where("split = 'test'"), "p", "p_calibrated").select(
        "txn_id", "p", "p_calibrated"
    )


def label_and_leakage_checks(spark, sf):
    """Test metrics with honest and with oracle labels, and the random-split gap."""
    f = _written_features(spark, sf)
    test = f.where("split = 'test'")

    def scored(fitted, rows, run):
        return model.score(fitted, rows, MODEL_INPUTS).select(F.lit(run).alias("run"), "is_fraud", "p")

    pool = evaluation.random_group_split(f.where("split is not null"), ["txn_id"])
    mixed = model.fit_gbt(pool.withColumn("held_out", ~F.col("in_train")), MODEL_INPUTS, "is_fraud",
                          valid="held_out", trees=10)
    path = shared_dir(spark, "scores")
    quality.concat(
        scored(_fit(f, "y_honest"), test, "honest_test"),
        scored(_fit(f, "is_fraud"), test, "oracle_test"),
        scored(mixed, pool.where(~F.col("in_train")), "random_holdout"),
    ).write.parquet(path)
    curve = evaluation.score_curve(spark.read.parquet(path), "p", "is_fraud", ["run"])
    runs = evaluation.ranking_metrics(curve, ["run"])

    def pr_auc(run):
        return F.max(F.when(F.col("run") == run, F.col("pr_auc")))

    return runs.agg(
        pr_auc("honest_test").alias("honest_test"),
        pr_auc("oracle_test").alias("oracle_test"),
        pr_auc("random_holdout").alias("random_holdout"),
        *evaluation.leakage_gap(pr_auc("random_holdout"), pr_auc("oracle_test")),
    )


# ---- streaming


def _event_stream(spark, sf):
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    like = standin.table(spark, sf, "events")
    events = counters.file_stream(spark, like, f"{sf}/events*.parquet")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _drained(spark, stream):
    out = shared_dir(spark, "stream")
    counters.run_available(stream, f"{out}/data", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/data")


def stream_hourly_counters(spark, sf):
    """Hourly counters of a stream of all events; hours the watermark has closed."""
    return _drained(spark, counters.bucket_stream(_event_stream(spark, sf), "user_id", "ts", "1 hour"))


def stream_rolling_counters(spark, sf):
    """Per-user counts of the last 24 hours at each hour start, from a stream."""
    return _drained(spark, counters.rolling_stream(_event_stream(spark, sf), "user_id", "ts", DAY))


def _closed(spark, sf, made):
    """All rows of a stream of events that is brought to its end."""
    events, close = counters.closing(_event_stream(spark, sf).drop("props"), "ts")
    out = shared_dir(spark, "stream")
    counters.run_closed(made(events), close, f"{out}/data", f"{out}/checkpoint")
    return spark.read.parquet(f"{out}/data")


def stream_hourly_distinct(spark, sf):
    """Rows and distinct kinds of event per user and hour, the last hours included."""
    return _closed(spark, sf, lambda e: counters.bucket_stream(e, "user_id", "ts", member="event_type"))


def stream_rolling_rows(spark, sf):
    """Each event with its user's counts, sums and mean of the last hour and day, from a stream."""
    specs = [
        Rolling("cnt_1h", "count", HOUR), Rolling("cnt_24h", "count", DAY), Rolling("sum_1h", "sum", HOUR, "value"),
        Rolling("sum_24h", "sum", DAY, "value"), Rolling("mean_24h", "mean", DAY, "value"),
    ]
    df = _closed(spark, sf, lambda e: rolling_rows(e, "user_id", "ts", specs, ["event_id"]))
    return df.select("event_id", "user_id", "cnt_1h", "cnt_24h", *_r("sum_1h", "sum_24h", "mean_24h", digits=8))


def stream_dedup(spark, sf):
    """A stream that delivers every event twice, reduced to one copy."""
    twice = _event_stream(spark, sf).unionByName(_event_stream(spark, sf))
    return _drained(spark, counters.dedup_stream(twice, "event_id", "ts").select("event_id", "user_id", "value"))


QUERIES = {
    f.__name__: f
    for f in [
        feature_table_full, card_rolling_counts, card_rolling_amounts, card_rolling_sweep,
        card_rolling_hot_split, card_rolling_micros, merchant_rolling_micros_sweep, card_distinct_exact, card_distinct_approx, card_declines_10m,
        card_velocity_ratios, time_since_last, country_changed, since_last_hot_split,
        secs_since_decline, merchant_hourly_buckets, merchant_rolling_bucketed,
        merchant_distinct_hll, merchant_bucket_joinback, merchant_rolling_count_sweep,
        merchant_rolling_distinct_sweep, te_merchant_build, te_mcc_build, te_applied_with_prior,
        te_merchant_row_asof, te_row_asof_hot_split, te_weekly_versions, te_weekly_applied, dim_enrich_context,
        calendar_context, join_sort_merge, join_salted, join_salted_all_keys, join_broadcast,
        join_lookup_left, asof_lookup, asof_lookup_hot_split, key_skew_report, key_skew_topk,
        ranked_share_report, key_attribute_lookup, input_partitions, partition_skew, dedup_transactions, quality_checks, quality_gate, dataset_profile,
        label_maturity, temporal_split_counts, dedup_missing_keys, land_late_rows, union_splits, class_weight, honest_labels,
        class_profile, psi_drift, drift_from_sketches, average_precision, roc_auc, metrics_by_split, recall_at_fpr,
        recall_at_fpr_corners, leakage_gap_given_scores, cost_curve, cost_threshold, confusion_at_threshold,
        partitioned_roundtrip, pruned_range_scan, catalog_table_roundtrip, bucketed_table_windows, clustered_files,
        snapshot_asof_read, snapshot_history, row_count_drift, metrics_json_roundtrip, silver_feature_table, feature_table_approx,
        gbt_scores, gbt_rounds, importance_topk, calibrated_scores, label_and_leakage_checks,
        stream_hourly_counters, stream_rolling_counters, stream_dedup, stream_hourly_distinct, stream_rolling_rows,
        backfill_by_range,
    ]
}
