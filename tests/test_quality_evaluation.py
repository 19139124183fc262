"""Quality gates and ranking metrics against hand values and brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from beforehand.operators import evaluation, quality, reports

from .helpers import by_id, frame, txn, txns


def scored(spark, pairs, schema="p double, y int"):
    return frame(spark, schema, *pairs)


# ---- quality


def test_copies_fail_the_gate_and_dedup_restores_the_rows(spark):
    clean = txns(spark, *[txn(i, i * 60) for i in range(20)])
    tripled = quality.concat(clean, clean, clean)
    rules = [("duplicate_rows", "max", 0.0)]
    with pytest.raises(quality.GateError, match="duplicate_rows"):
        quality.enforce(quality.table_checks(tripled, "txn_id", []), rules)
    back = quality.dedup(tripled, ["txn_id"], ["txn_time"])
    quality.enforce(quality.table_checks(back, "txn_id", []), rules)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, clean.collect()))
    assert back.columns == clean.columns


def test_dedup_keeps_the_first_in_order(spark):
    df = txns(spark, txn(1, 50, amount=5.0), txn(1, 10, amount=9.0), txn(1, 10, amount=3.0))
    assert by_id(quality.dedup(df, ["txn_id"], ["txn_time"]), "amount") == {1: 3.0}


def test_checks_count_rows_without_a_key(spark):
    df = txns(spark, txn(1, 0), txn(1, 1), txn(None, 2), txn(3, 3, country=None))
    got = {r.metric: r.value for r in quality.table_checks(df, "txn_id", ["txn_country"]).collect()}
    assert got == {"rows": 4.0, "distinct_keys": 2.0, "duplicate_rows": 2.0, "null_rate_txn_country": 0.25}


def test_gate_reports_floor_ceiling_and_missing_metrics(spark):
    m = frame(spark, "metric string, value double", ("a", 0.5), ("b", 2.0), ("c", None))
    rules = [("a", "min", 0.5), ("b", "max", 1.0), ("c", "min", 0.0), ("d", "min", 0.0)]
    assert {r.metric for r in quality.gate(m, rules).collect()} == {"b", "c", "d"}


# ---- splits


def test_split_edges(spark):
    rows = [txn(i, t) for i, t in enumerate(
        __import__("datetime").datetime.fromisoformat(s)
        for s in ("2024-01-10T23:59:59", "2024-01-11", "2024-01-17T23:59:59", "2024-01-18", "2024-01-22", "2024-01-25",
                  "2024-01-31"))]
    ranges = {"train": ("2024-01-11", "2024-01-18"), "valid": ("2024-01-18", "2024-01-21"),
              "test": ("2024-01-25", "2024-01-31")}
    got = by_id(evaluation.temporal_split(txns(spark, *rows), "txn_time", ranges), "split")
    assert list(got.values()) == [None, "train", "train", "valid", None, "test", None]


def test_random_split_keeps_copies_together(spark):
    df = txns(spark, *[txn(i % 50, i) for i in range(200)])
    sides = evaluation.random_group_split(df, ["txn_id"]).groupBy("txn_id").agg(
        F.count_distinct("in_train").alias("n")
    )
    assert {r.n for r in sides.collect()} == {1}
    share = evaluation.random_group_split(spark.range(5000), ["id"]).agg(F.avg(F.col("in_train").cast("int"))).first()[0]
    assert 0.67 < share < 0.73


# ---- ranking metrics


def brute(pairs):
    """AP, AUC and the full curve, by definition."""
    p = np.array([x for x, _ in pairs])
    y = np.array([b for _, b in pairs])
    pos, neg = y.sum(), (1 - y).sum()
    ap = prev = 0.0
    curve = []
    for s in sorted(set(p), reverse=True):
        tp, fp = y[p >= s].sum(), (1 - y)[p >= s].sum()
        ap += (tp - prev) / pos * tp / (tp + fp)
        prev = tp
        curve.append((s, tp, fp))
    wins = (p[y == 1][:, None] > p[y == 0][None, :]).sum() + 0.5 * (p[y == 1][:, None] == p[y == 0][None, :]).sum()
    return ap, wins / (pos * neg), curve, pos, neg


@pytest.mark.parametrize("ranges", [1, 3, 7, 200])
@pytest.mark.parametrize("seed", [1, 2])
def test_metrics_match_brute_force(spark, ranges, seed):
    rnd = random.Random(seed)
    pairs = [(rnd.choice([rnd.random(), rnd.randrange(10) / 10, 0.3]), int(rnd.random() < 0.2)) for _ in range(300)]
    curve = evaluation.score_curve(scored(spark, pairs), "p", "y", ranges=ranges)
    ap, auc, points, pos, neg = brute(pairs)
    got = evaluation.ranking_metrics(curve).first()
    assert got.pr_auc == pytest.approx(ap) and got.roc_auc == pytest.approx(auc)
    assert (got.n, got.n_pos) == (300, pos)
    assert sorted(((r.score, r.tp, r.fp) for r in curve.collect()), reverse=True) == [tuple(x) for x in points]
    r = evaluation.recall_at_fpr(curve, (0.1,)).first()
    s, tp, _ = [x for x in points if x[2] / neg <= 0.1][-1]
    assert (r.recall_10pct, r.threshold_10pct) == (pytest.approx(tp / pos), s)


@pytest.mark.parametrize("ranges", [1, 4, 50])
def test_corner_points_are_those_where_the_curve_bends(spark, ranges):
    rnd = random.Random(5)
    pairs = [(rnd.randrange(40) / 40, int(rnd.random() < 0.3)) for _ in range(120)]
    curve = evaluation.score_curve(scored(spark, pairs), "p", "y", ranges=ranges)
    _, _, points, _, _ = brute(pairs)
    tps, fps = np.array([x[1] for x in points]), np.array([x[2] for x in points])
    keep = np.r_[True, (np.diff(fps, 2) != 0) | (np.diff(tps, 2) != 0), True]
    want = [points[i][0] for i in range(len(points)) if keep[i]]
    assert sorted((r.score for r in evaluation.corner_points(curve).collect()), reverse=True) == want


def test_equal_scores(spark):
    curve = evaluation.score_curve(scored(spark, [(0.5, int(i == 0)) for i in range(10)]), "p", "y")
    m, r = evaluation.ranking_metrics(curve).first(), evaluation.recall_at_fpr(curve).first()
    assert (m.pr_auc, m.roc_auc) == (pytest.approx(0.1), 0.5)
    assert r.recall_1pct == 0.0 and math.isinf(r.threshold_1pct)


def test_perfect_scores(spark):
    pairs = [(0.9, 1), (0.8, 1), (0.2, 0), (0.1, 0)]
    curve = evaluation.score_curve(scored(spark, pairs), "p", "y")
    m, r = evaluation.ranking_metrics(curve).first(), evaluation.recall_at_fpr(curve).first()
    assert (m.pr_auc, m.roc_auc, r.recall_1pct, r.threshold_1pct) == (1.0, 1.0, 1.0, 0.8)


def test_no_positives_give_null_metrics(spark):
    curve = evaluation.score_curve(scored(spark, [(0.1, 0), (0.2, 0)]), "p", "y")
    m, r = evaluation.ranking_metrics(curve).first(), evaluation.recall_at_fpr(curve).first()
    assert m.pr_auc is None and m.roc_auc is None and r.recall_1pct is None


def test_groups_are_measured_apart(spark):
    rows = [("a", 0.9, 1), ("a", 0.1, 0), (None, 0.9, 0), (None, 0.1, 1)]
    df = scored(spark, rows, "g string, p double, y int")
    m = evaluation.ranking_metrics(evaluation.score_curve(df, "p", "y", by=["g"]), ["g"])
    assert {r.g: r.roc_auc for r in m.collect()} == {"a": 1.0, None: 0.0}


def test_null_scores_are_refused(spark):
    with pytest.raises(PySparkException, match="NULL score"):
        evaluation.score_curve(scored(spark, [(None, 0), (0.2, 1)]), "p", "y").collect()


# ---- cost


def test_every_cost_matches_brute_force(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([rnd.random(), rnd.randrange(100) / 100]), int(rnd.random() < 0.3), round(rnd.random() * 90, 2))
            for _ in range(300)]
    df = scored(spark, rows, "p double, y int, amount double")
    got = {r.threshold: r for r in evaluation.cost_curve(df, "p", "y", "amount").collect()}
    assert sorted(got) == evaluation.cost_grid() and len(got) == 91
    for t, r in got.items():
        missed = sum(a for p, y, a in rows if y and p < t)
        fp = sum(1 for p, y, _ in rows if not y and p >= t)
        tp = sum(1 for p, y, _ in rows if y and p >= t)
        assert r.missed == pytest.approx(missed) and r.cost == pytest.approx(missed + 5 * fp)
        assert (r.tp, r.fp) == (tp, fp) and r.precision == tp / max(tp + fp, 1)


def test_lowest_threshold_wins_a_cost_tie(spark):
    df = scored(spark, [(0.5, 1, 10.0), (0.01, 0, 1.0)], "p double, y int, amount double")
    best = evaluation.best_threshold(evaluation.cost_curve(df, "p", "y", "amount")).first()
    assert best.threshold == 0.05 and best.cost == 0.0


def test_tune_on_one_set_and_report_on_another(spark):
    schema = "p double, y int, amount double"
    tune = scored(spark, [(0.6, 1, 100.0), (0.4, 0, 1.0), (0.3, 0, 1.0)], schema)
    report = scored(spark, [(0.45, 1, 7.0), (0.405, 0, 1.0), (0.2, 1, 3.0)], schema)
    best = evaluation.best_threshold(evaluation.cost_curve(tune, "p", "y", "amount")).select("threshold")
    out = evaluation.confusion_at(report, "p", "y", best.scalar(), "amount").first()
    assert (out.tp, out.fp, out.fn, out.tn, out.missed) == (1, 0, 1, 1, 3.0)


# ---- reports


def test_label_maturity_and_class_weight(spark):
    dt = __import__("datetime").datetime
    df = txns(spark, txn(1, 0, fraud=1, confirmed=dt(2024, 1, 20)), txn(2, 1, fraud=1, confirmed=dt(2024, 1, 21)),
              txn(3, 2), txn(4, 3))
    r = reports.label_maturity(df, "is_fraud", "label_confirmed_at", "2024-01-21").first()
    assert (r.positives, r.known, r.known_share) == (2, 1, 0.5)
    w = reports.class_weight(df, "is_fraud").first()
    assert (w.n_pos, w.n_neg, w.pos_weight) == (2, 2, 1.0)


def test_drift_is_zero_for_the_same_rows_and_positive_when_shifted(spark):
    a = spark.range(1000).select(F.col("id").cast("double").alias("x"))
    b = a.select((F.col("x") + 400).alias("x"))
    total = lambda d: d.agg(F.sum("psi")).first()[0]
    assert total(reports.column_drift(a, a, "x")) == pytest.approx(0.0)
    assert total(reports.column_drift(a, b, "x")) > 0.5


def test_ranked_share(spark):
    df = frame(spark, "feature string, gain double", ("a", 1.0), ("b", 3.0), ("c", 0.0))
    assert [tuple(r) for r in reports.ranked_share(df, "feature", "gain", 2).collect()] == [("b", 3.0, 75.0), ("a", 1.0, 25.0)]


def test_partition_sizes_upper_median(spark):
    r = reports.partition_sizes(spark.range(10).repartition(1)).first()
    assert (r.partitions, r.median_rows, r.max_rows, r.max_over_median) == (1, 10, 10, 1.0)
    assert reports.partition_sizes(spark.range(0)).count() == 0


def test_row_drift_needs_an_earlier_version(spark):
    now = spark.range(90)
    seen = spark.createDataFrame([(0, 7), (1, 100)], "version long, rows long")
    value = lambda h: {r.metric: r.value for r in quality.row_drift(now, h).collect()}
    assert value(seen) == {"rows": 90.0, "rows_before": 100.0, "row_drift": 0.1}
    assert value(seen.limit(0))["row_drift"] is None
    for history, bound, broken in ((seen, 0.2, 0), (seen, 0.05, 1), (seen.limit(0), 0.2, 1)):
        rules = [("row_drift", "max", bound)]
        assert quality.gate(quality.row_drift(now, history), rules).count() == broken
