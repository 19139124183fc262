"""Training, scoring, importance and calibration on rows with a known signal."""

import pytest
from pyspark.sql import functions as F

from beforehand.operators import evaluation, model

FEATURES = ["signal", "noise", "gaps"]


@pytest.fixture(scope="module")
def rows(spark):
    h = F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000
    noise = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1000)) / 1000
    df = spark.range(4000).select("id", h.alias("signal"), noise.alias("noise"))
    return df.withColumns(
        {
            "y": ((F.col("signal") > 0.9) | ((F.col("noise") > 0.98) & (F.col("signal") > 0.5))).cast("int"),
            "gaps": F.when(F.col("id") % 3 == 0, F.col("noise")),
            "in_valid": F.col("id") % 4 == 0,
        }
    ).cache()


@pytest.fixture(scope="module")
def fitted(rows):
    return model.fit_gbt(rows, FEATURES, "y", valid="in_valid", trees=5, depth=3)


def test_scores_rank_the_signal(rows, fitted):
    scored = model.score(fitted, rows.where("in_valid"), FEATURES)
    assert scored.columns == [*rows.columns, "p"]
    m = evaluation.ranking_metrics(evaluation.score_curve(scored, "p", "y")).first()
    assert m.pr_auc > 0.9 and m.roc_auc > 0.95
    assert scored.where("gaps is null and p is null").count() == 0


def test_importance_puts_the_signal_first(rows, fitted):
    got = model.importance(rows, fitted, FEATURES).collect()
    assert [r.feature for r in got][0] == "signal"
    assert sum(r.gain_pct for r in got) == pytest.approx(100, abs=0.3)


def test_fit_is_repeatable(rows, fitted):
    again = model.fit_gbt(rows, FEATURES, "y", valid="in_valid", trees=5, depth=3)
    a, b = (model.score(m, rows, FEATURES).agg(F.sum("p")).first()[0] for m in (fitted, again))
    assert a == pytest.approx(b)


def test_calibration_is_monotone_and_right_on_average(rows, fitted):
    scored = model.score(fitted, rows, FEATURES)
    out = model.calibrate(model.fit_calibration(scored, "p", "y"), scored, "p", "p_cal")
    got = out.select("p", "p_cal", "y").toPandas().sort_values("p")
    assert (got.p_cal.diff().dropna() >= -1e-9).all()
    assert got.p_cal.mean() == pytest.approx(got.y.mean(), abs=0.01)


def test_early_stopping_uses_the_validation_rows(rows):
    few = model.fit_gbt(rows, FEATURES, "y", valid="in_valid", trees=40, depth=3, rate=0.9)
    assert few.stages[-1].getNumTrees < 40


def brute_precision(scores, labels):
    """Average precision over distinct scores."""
    at, hits, seen, out = sorted(set(scores), reverse=True), 0, 0, 0.0
    for cut in at:
        own = [y for p, y in zip(scores, labels) if p == cut]
        seen, hits = seen + len(own), hits + sum(own)
        out += sum(own) * hits / seen
    return out / sum(labels)


def test_the_best_round_is_that_of_scoring_each_prefix_alone(rows):
    whole = model.fit_gbt(rows.where("NOT in_valid"), FEATURES, "y", trees=8, depth=2, columns=0.5)
    valid = rows.where("in_valid")
    got = {r.round: r.pr_auc for r in model.rounds_by_average_precision(whole, valid, FEATURES, "y").collect()}
    want = {}
    for k in range(1, 9):
        scored = model.score(model.first_rounds(whole, k), valid, FEATURES).select("p", "y").collect()
        want[k] = brute_precision([r.p for r in scored], [r.y for r in scored])
    assert got == pytest.approx(want)
    best, rounds = model.fit_best_round(rows, FEATURES, "y", "in_valid", trees=8, depth=2, columns=0.5)
    assert rounds == min(k for k in want if want[k] == pytest.approx(max(want.values()))) == len(best.stages[-1].trees)


def test_prefixes_score_as_the_model_does(rows):
    whole = model.fit_gbt(rows, FEATURES, "y", trees=4, depth=3)
    last = model.round_scores(whole, rows.select("id", *FEATURES), FEATURES).where("round = 4").select("id", "p")
    both = last.join(model.score(whole, rows, FEATURES).select("id", F.col("p").alias("q")), "id")
    assert both.count() == 4000 and both.where("abs(p - q) > 1e-12").count() == 0
    assert [len(t.stages[-1].trees) for t in (whole, model.first_rounds(whole, 2))] == [4, 2]


def test_a_cut_model_is_saved_and_tells_importance(spark, rows, tmp_path):
    cut = model.first_rounds(model.fit_gbt(rows, FEATURES, "y", trees=4, depth=2), 1)
    model.save_model(cut, str(tmp_path / "m"))
    again = model.load_model(str(tmp_path / "m"))
    a, b = (model.score(m, rows, FEATURES).select("id", "p").orderBy("id").collect() for m in (cut, again))
    assert a == b
    assert {r.feature for r in model.importance(rows, cut, FEATURES).collect()} == set(FEATURES)


def test_fewer_columns_a_split(rows):
    whole = model.fit_gbt(rows, FEATURES, "y", trees=2, columns=0.34)
    assert whole.stages[-1].getFeatureSubsetStrategy() == "0.34"
