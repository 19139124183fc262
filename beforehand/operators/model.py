"""Gradient-boosted training, scoring and calibration on pyspark.ml."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .evaluation import bucketed, ranking_metrics, score_curve
from .reports import class_weight, ranked_share

MISSING = -1.0


def _inputs(df: DataFrame, features: list[str]) -> DataFrame:
    filled = {f"_x_{c}": F.coalesce(F.col(c).cast("double"), F.lit(MISSING)) for c in features}
    return df.withColumns(filled)


def _rows(df: DataFrame, features: list[str], label: str, weight: float | None, more: tuple = ()) -> DataFrame:
    return _inputs(df, features).select(
        *[f"_x_{c}" for c in features],
        F.col(label).cast("double").alias("_label"),
        F.when(F.col(label) == 1, float(weight or 1.0)).otherwise(1.0).alias("_weight"),
        *more,
    )


def fit_gbt(
    df: DataFrame,
    features: list[str],
    label: str,
    valid: str | None = None,
    trees: int = 50,
    rate: float = 0.1,
    depth: int = 5,
    seed: int = 42,
    columns: float = 1.0,
) -> PipelineModel:
    """Boosted trees with positives weighted by sqrt(negatives / positives).

    ``valid`` names a boolean column marking rows used for early stopping. NULL inputs
    become -1. Weights come from the training rows alone. ``columns`` is the share of the inputs that
    each split may choose from.
    """
    train = df.where(~F.col(valid)) if valid else df
    weight = class_weight(train, label).first()["pos_weight"]
    rows = _rows(df, features, label, weight, (F.col(valid).alias("_valid"),) if valid else ())
    gbt = GBTClassifier(
        featuresCol="_features", labelCol="_label", weightCol="_weight", maxIter=trees, stepSize=rate,
        maxDepth=depth, subsamplingRate=0.8, minInstancesPerNode=50, seed=seed,
        featureSubsetStrategy="all" if columns >= 1 else str(columns),
    )
    if valid:
        gbt = gbt.setValidationIndicatorCol("_valid")
    assembler = VectorAssembler(inputCols=[f"_x_{c}" for c in features], outputCol="_features")
    return Pipeline(stages=[assembler, gbt]).fit(rows)


def round_scores(model: PipelineModel, df: DataFrame, features: list[str], name: str = "p") -> DataFrame:
    """Each row once for each round of the ensemble, with ``round`` from 1 and its probability after that round.

    Every tree is asked once; probabilities come from running sums of what the trees say, kept
    as one array a row.
    """
    assembler, whole = model.stages
    rows = assembler.transform(_inputs(df, features))
    for i, tree in enumerate(whole.trees):
        rows = tree.setFeaturesCol("_features").setPredictionCol(f"_t{i}").transform(rows)
    steps = F.array(*[F.col(f"_t{i}") * float(w) for i, w in enumerate(whole.treeWeights)])
    margins = F.aggregate(
        steps,
        F.array().cast("array<double>"),
        lambda sums, step: F.array_append(sums, F.coalesce(F.get(sums, F.size(sums) - 1), F.lit(0.0)) + step),
    )
    rounds = rows.select(*df.columns, F.posexplode(margins).alias("_before", "_margin"))
    return rounds.select(*df.columns, (F.col("_before") + 1).alias("round"), (1 / (1 + F.exp(-2 * F.col("_margin")))).alias(name))


def rounds_by_average_precision(model: PipelineModel, df: DataFrame, features: list[str], label: str) -> DataFrame:
    """``round, pr_auc`` of every round on the rows of ``df``, from one pass over them."""
    scored = round_scores(model, df.select(*features, F.col(label).alias("_y")), features).select("round", "p", "_y")
    return ranking_metrics(score_curve(scored, "p", "_y", ["round"]), ["round"]).select("round", "pr_auc")


def first_rounds(model: PipelineModel, rounds: int) -> PipelineModel:
    """The model after its first rounds."""
    assembler, whole = model.stages
    jvm = whole._java_obj
    gateway = SparkSession.active().sparkContext._gateway
    trees = gateway.new_array(gateway.jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel, rounds)
    weights = gateway.new_array(gateway.jvm.double, rounds)
    for i in range(rounds):
        trees[i], weights[i] = jvm.trees()[i], float(whole.treeWeights[i])
    cut = GBTClassificationModel(
        gateway.jvm.org.apache.spark.ml.classification.GBTClassificationModel(f"{whole.uid}_{rounds}", trees, weights)
    )
    return PipelineModel([assembler, cut.setFeaturesCol("_features")])


def fit_best_round(
    df: DataFrame,
    features: list[str],
    label: str,
    valid: str,
    trees: int = 50,
    columns: float = 0.8,
    **settings,
) -> tuple[PipelineModel, int]:
    """Boosted trees up to the round of best average precision on the ``valid`` rows, and that round.

    Rounds are fitted on the other rows alone; of equally good ones the first is taken.
    """
    whole = fit_gbt(df.where(~F.col(valid)), features, label, trees=trees, columns=columns, **settings)
    found = rounds_by_average_precision(whole, df.where(F.col(valid)), features, label)
    best = found.agg(F.max_by("round", F.struct(F.coalesce("pr_auc", F.lit(0.0)), -F.col("round")))).first()[0]
    rounds = best or len(whole.stages[-1].trees)
    return first_rounds(whole, rounds), rounds


def score(model: PipelineModel, df: DataFrame, features: list[str], name: str = "p") -> DataFrame:
    """Add the probability of the positive class."""
    out = model.transform(_inputs(df, features))
    return out.withColumn(name, vector_to_array("probability")[1]).select(*df.columns, name)


def importance(df: DataFrame, model: PipelineModel, features: list[str], k: int | None = None) -> DataFrame:
    """Features by falling gain with their percentage; ``df`` supplies the session."""
    gains = model.stages[-1].featureImportances.toArray().tolist()
    gains += [0.0] * (len(features) - len(gains))  # the last inputs, where no tree uses them
    table = df.sparkSession.createDataFrame(list(zip(features, gains)), "feature string, gain double")
    return ranked_share(table, "feature", "gain", k)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


CALIBRATION_POINTS = 2_000


def fit_calibration(df: DataFrame, score: str, label: str) -> IsotonicRegressionModel:
    """Monotone map from score to observed rate.

    Rows first collapse to weighted points: one for each of up to ``CALIBRATION_POINTS`` ranges of
    equal numbers of distinct scores, at the mean of its scores. Low scores, where most rows
    lie, thus stay apart however close they are, and fewer distinct scores are not merged.
    """
    scores = df.select(F.col(score).cast("double").alias("_s"), F.col(label).cast("double").alias("_y"))
    at = [i / CALIBRATION_POINTS for i in range(1, CALIBRATION_POINTS)]
    cuts = scores.select("_s").distinct().agg(F.percentile_approx("_s", at, 10 * CALIBRATION_POINTS)).first()[0]
    ranged = bucketed(scores, "_s", sorted(set(cuts)) if cuts else [0.0], "_range")
    points = ranged.groupBy("_range").agg(
        F.avg("_s").alias("_s"), F.avg("_y").alias("_y"), F.count(F.lit(1)).cast("double").alias("_w")
    )
    return IsotonicRegression(featuresCol="_s", labelCol="_y", weightCol="_w").fit(points)


def calibrate(model: IsotonicRegressionModel, df: DataFrame, score: str, name: str) -> DataFrame:
    out = model.setFeaturesCol(score).setPredictionCol(name).transform(df)
    return out
