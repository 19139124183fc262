"""Batch jobs with a command line: build, skew, train, gate.

    python -m beforehand.plans.jobs build --raw ... --merchants ... --out ...
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import in_range, known_label
from ..operators import drift, evaluation, joins, model, quality, reports
from ..operators.skew import profile_keys
from ..session import build_session, shared_dir
from ..sources import snapshots, tables
from ..sources.schemas import MODEL_INPUTS, Timeline
from .features import feature_range, feature_table

PR_AUC_FLOOR = 0.60
GAP_ALARM = 0.05
# What the class profile reports: its name, the input and its digits.
PROFILE_MEANS = {
    "cnt_1h": ("card_cnt_1h", 2),
    "secs_since_last": ("secs_since_last", 0),
    "amt_ratio_7d": ("amt_ratio_7d", 2),
    "declines_10m": ("card_declines_10m", 2),
    "merchant_te": ("merchant_id_te", 4),
}


def build(
    spark: SparkSession,
    raw: str,
    merchants: str,
    out: str,
    timeline: Timeline,
    start: str | None = None,
    end: str | None = None,
    snapshot_root: str | None = None,
    max_drift: float | None = None,
    state: str | None = None,
    sketches: str | None = None,
) -> DataFrame:
    """Check the input, write the feature table by day, and return its class profile.

    With ``start`` and ``end`` only those days are checked, rebuilt and overwritten: that their keys are on no other
    day is what landing sees to. ``state`` is the folder that ``feature_range`` carries on; ``sketches`` one
    that gets a sketch of every input a day, for ``stored_drift``. With ``max_drift`` a whole
    build fails before it writes if its rows differ by more than that share from the last snapshot's.
    """
    txns = tables.read_transactions(spark, f"{raw}/transactions")
    dim = tables.read_merchants(spark, merchants)
    asked = tables.read_transactions(spark, f"{raw}/transactions", start, end) if start else txns
    quality.enforce(
        quality.table_checks(asked, "txn_id", ["card_id", "txn_time", "merchant_id"]),
        [("rows", "min", 1.0), ("duplicate_rows", "max", 0.0), ("null_rate_card_id", "max", 0.0),
         ("null_rate_txn_time", "max", 0.0), ("null_rate_merchant_id", "max", 0.0)],
    )
    if snapshot_root and max_drift is not None and not start:
        known = snapshots.history(spark, snapshot_root)
        if known.take(1):  # a feature row for each transaction
            quality.enforce(quality.row_drift(txns, known), [("row_drift", "max", max_drift)])
    if start:
        df = feature_range(txns, dim, timeline, start, end, state=state)
    else:
        df = feature_table(txns, dim, timeline)
    tables.write_partitioned(df, out)
    written = tables.read_features(spark, out)
    made = tables.prune_dates(written, start, end).where(in_range("txn_time", start, end)) if start else written
    if sketches:
        tables.write_partitioned(drift.daily_sketches(made, MODEL_INPUTS), sketches)
    if snapshot_root:
        snapshots.write_snapshot(written, snapshot_root, "BACKFILL" if start else "BUILD")
    return reports.class_profile(made, "is_fraud", PROFILE_MEANS)


def skew(spark: SparkSession, raw: str, merchants: str, partitions: int = 32) -> dict[str, DataFrame]:
    """Key histogram, partition sizes with and without salt, and the three joins."""
    txns = tables.read_transactions(spark, f"{raw}/transactions").select("txn_id", "merchant_id", "amount")
    dim = tables.read_merchants(spark, merchants).select(
        "merchant_id", "merchant_country", "merchant_risk_tier"
    )
    salt = F.pmod(F.xxhash64("txn_id"), F.lit(joins.DEFAULT_SALTS))
    hot = profile_keys(txns, "merchant_id")
    return {
        "top_keys": reports.top_keys(txns, "merchant_id", 3),
        "by_key": reports.shuffle_sizes(txns, ["merchant_id"], partitions),
        "by_key_and_salt": reports.shuffle_sizes(txns, ["merchant_id", salt], partitions),
        "sort_merge": joins.merge_join(txns, dim, "merchant_id"),
        "salted": joins.salted_join(txns, dim, "merchant_id", hot, ["txn_id"]),
        "broadcast": joins.lookup_join(txns, dim, "merchant_id", "inner", profile=hot, row_key=["txn_id"]),
    }


def run_metrics(scored: DataFrame, score: str = "p", label: str = "is_fraud") -> DataFrame:
    """All ranking metrics of each value of ``split`` as ``split, metric, value`` rows."""
    by = ["split"]
    curve = evaluation.score_curve(scored, score, label, by)
    ranking = evaluation.ranking_metrics(curve, by)
    recall = evaluation.recall_at_fpr(curve, by=by, corners_only=True)
    # fixed values: names of the metrics file
    names = {
        "recall_1pct": "recall@1%FPR", "recall_0_1pct": "recall@0.1%FPR",
        "threshold_1pct": "threshold@1%FPR", "threshold_0_1pct": "threshold@0.1%FPR", "n_pos": "n_fraud",
    }
    parts = []
    for wide in (ranking, recall):
        found = [c for c in wide.columns if c not in by]
        cast = wide.select("split", *[F.col(c).cast("double").alias(names.get(c, c)) for c in found])
        parts.append(cast.unpivot(by, [f"`{c}`" for c in cast.columns[1:]], "metric", "value"))
    return quality.concat(*parts)


def train(spark: SparkSession, features: str, out: str, timeline: Timeline, trees: int = 50) -> DataFrame:
    """Fit with honest and with oracle labels, check for leakage, tune the threshold.

    Each model ends at its round of best average precision on the validation rows.
    Writes the metrics, the importances and the model below ``out`` and returns the metrics.
    """
    columns = ["txn_id", "txn_time", "txn_date", "is_fraud", "label_confirmed_at", *MODEL_INPUTS]
    f = evaluation.split_parts(tables.read_features(spark, features, columns), "txn_time", timeline.ranges)
    f = f.withColumn("y_honest", known_label("is_fraud", "label_confirmed_at", timeline.label_cutoff))
    valid, test = (f.where(F.col("split") == s) for s in ("valid", "test"))

    def fitted(label: str):
        rows = f.where("split in ('train', 'valid')").withColumn("in_valid", F.col("split") == "valid")
        y = F.when(F.col("in_valid"), F.col("is_fraud")).otherwise(F.col(label))
        return model.fit_best_round(rows.withColumn("y", y), MODEL_INPUTS, "y", "in_valid", trees)

    (honest, best), (oracle, _) = fitted("y_honest"), fitted("is_fraud")
    pool = evaluation.random_group_split(f, ["txn_id"]).withColumn("held_out", ~F.col("in_train"))
    mixed, _ = model.fit_best_round(pool, MODEL_INPUTS, "is_fraud", "held_out", trees)

    def scored(run: str, fitted_model, rows: DataFrame) -> DataFrame:
        return model.score(fitted_model, rows, MODEL_INPUTS).select(
            F.lit(run).alias("split"), "txn_id", "is_fraud", "amount", "p"
        )

    # every run scored once and written; the metrics read it several times
    scores_path = shared_dir(spark, "scores")
    quality.concat(
        scored("A_honest_valid", honest, valid),
        scored("A_honest_test", honest, test),
        scored("B_oracle_test", oracle, test),
        scored("random_split_holdout", mixed, pool.where("held_out")),
    ).write.partitionBy("split").parquet(scores_path)
    scores = spark.read.parquet(scores_path)
    honest_test = scores.where("split = 'A_honest_test'")
    cost = evaluation.best_threshold(evaluation.cost_curve(honest_test, "p", "is_fraud", "amount"))
    cost = cost.select(*[F.col(c).cast("double").alias(c) for c in cost.columns])
    maturity = reports.label_maturity(
        f.where("split = 'train'"), "is_fraud", "label_confirmed_at", timeline.label_cutoff
    )
    maturity = maturity.select(*[F.col(c).cast("double").alias(c) for c in maturity.columns])
    rounds = spark.createDataFrame([("A_honest", "A_best_iter", float(best))], "split string, metric string, value double")
    metrics = quality.concat(
        run_metrics(scores),
        rounds,
        cost.unpivot([], cost.columns, "metric", "value").withColumn("split", F.lit("business_threshold")),
        maturity.unpivot([], maturity.columns, "metric", "value").withColumn("split", F.lit("label_maturity")),
    )
    tables.write_metrics(metrics.withColumn("value", F.round("value", 4)), f"{out}/metrics")
    tables.write_importance(model.importance(f, honest, MODEL_INPUTS), f"{out}/feature_importance")
    model.save_model(honest, f"{out}/model")
    return tables.read_metrics(spark, f"{out}/metrics")


def gate(metrics: DataFrame, floor: float = PR_AUC_FLOOR, max_gap: float = GAP_ALARM) -> None:
    """Raise unless the honest test metric reaches the floor and the leakage gap is small."""

    def pr_auc(split: str):
        return F.max(F.when((F.col("split") == split) & (F.col("metric") == "pr_auc"), F.col("value")))

    row = metrics.agg(
        pr_auc("A_honest_test").alias("pr_auc"),
        (pr_auc("random_split_holdout") - pr_auc("B_oracle_test")).alias("leakage_gap"),
    )
    quality.enforce(
        row.unpivot([], row.columns, "metric", "value"),
        [("pr_auc", "min", floor), ("leakage_gap", "max", max_gap)],
    )


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="beforehand")
    sub = p.add_subparsers(dest="job", required=True)
    for name in ("build", "skew"):
        s = sub.add_parser(name)
        s.add_argument("--raw", required=True)
        s.add_argument("--merchants", required=True)
    b = sub.choices["build"]
    b.add_argument("--out", required=True)
    b.add_argument("--hist-end", required=True)
    b.add_argument("--label-cutoff", help="the end of the history unless given")
    b.add_argument("--start")
    b.add_argument("--end")
    b.add_argument("--snapshots")
    b.add_argument("--max-drift", type=float)
    b.add_argument("--sketches", help="folder for daily sketches of the model's inputs")
    b.add_argument("--state", help="folder for what a range build hands on to the next")
    t = sub.add_parser("train")
    t.add_argument("--features", required=True)
    t.add_argument("--out", required=True)
    t.add_argument("--label-cutoff", required=True)
    for name in ("train", "valid", "test"):
        t.add_argument(f"--{name}", nargs=2, required=True, metavar=("FROM", "TO"))
    g = sub.add_parser("gate")
    g.add_argument("--metrics", required=True)
    g.add_argument("--floor", type=float, default=PR_AUC_FLOOR)
    a = p.parse_args(argv)
    spark = build_session()
    if a.job == "build":
        line = Timeline(hist_end=a.hist_end, label_cutoff=a.label_cutoff)
        build(spark, a.raw, a.merchants, a.out, line, a.start, a.end, a.snapshots, a.max_drift, a.state, a.sketches).show()
    elif a.job == "skew":
        found = skew(spark, a.raw, a.merchants)
        for name in ("top_keys", "by_key", "by_key_and_salt"):
            found[name].show()
        for name in ("sort_merge", "salted", "broadcast"):
            found[name].explain()
    elif a.job == "train":
        line = Timeline(label_cutoff=a.label_cutoff, train=tuple(a.train), valid=tuple(a.valid), test=tuple(a.test))
        train(spark, a.features, a.out, line).show(100, truncate=False)
    else:
        gate(tables.read_metrics(spark, a.metrics), a.floor)


if __name__ == "__main__":
    main()
