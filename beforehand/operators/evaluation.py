"""Ranking metrics, the cost sweep and time splits, computed on Spark.

Everything starts from one row per distinct score, so ties are handled exactly.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import in_days, in_range
from ..session import shared_dir

MIN_RANGES, MAX_RANGES = 200, 5_000
FPR_TARGETS = (0.01, 0.001)
COST_GRID = (0.05, 0.95, 91)
FALSE_DECLINE_COST = 5.0
MONEY = "decimal(28,6)"


def temporal_split(df: DataFrame, time: str, ranges: dict[str, tuple], name: str = "split") -> DataFrame:
    """Label rows by half-open time range; rows in no range are NULL."""
    picked = F.coalesce(*[F.when(in_range(time, a, b), F.lit(s)) for s, (a, b) in ranges.items()])
    return df.withColumn(name, picked)


def split_parts(df: DataFrame, time: str, ranges: dict[str, tuple], name: str = "split", date: str = "txn_date") -> DataFrame:
    """The rows of ranges that do not overlap, each labelled; rows in no range are left out.

    Each range is a filter of its own, on the date column too where there is one, so a later
    filter on ``name`` reads that range's days alone.
    """
    dated = date in df.columns
    parts = []
    for s, (a, b) in ranges.items():
        part = df.where(in_days(date, a, b)) if dated else df
        parts.append(part.where(in_range(time, a, b)).withColumn(name, F.lit(s)))
    return reduce(DataFrame.unionByName, parts)


def random_group_split(df: DataFrame, group: list[str], train_tenths: int = 7, name: str = "in_train") -> DataFrame:
    """Random split by hash of a group key, so copies of a row never land on both sides."""
    return df.withColumn(name, F.pmod(F.xxhash64(*group), F.lit(10)) < train_tenths)


def bucketed(df: DataFrame, column: str, edges: list[float], name: str) -> DataFrame:
    """``name`` = number of ``edges`` at or below the value (binary search on the JVM)."""
    splits = [float("-inf"), *edges, float("inf")]
    out = Bucketizer(splits=splits, inputCol=column, outputCol=name).transform(df)
    return out.withColumn(name, F.col(name).cast("int"))


def _group(by: list[str] | None) -> Column:
    """One never-NULL column for a list of grouping columns, so that NULL groups join."""
    return F.struct(*by) if by else F.lit(0)


def score_counts(df: DataFrame, score: str, label: str, by: list[str] | None = None) -> DataFrame:
    """Positives and negatives per distinct score; NULL scores have no rank and fail."""
    checked = F.coalesce(
        F.col(score).cast("double"), F.raise_error(F.lit("NULL score")).cast("double")
    )
    pos = F.sum(F.when(F.col(label) == 1, 1).otherwise(0))
    return df.groupBy(*(by or []), checked.alias("score")).agg(
        pos.alias("pos"), (F.count(F.lit(1)) - pos).alias("neg")
    )


def _default_ranges(df: DataFrame) -> int:
    conf = df.sparkSession.conf
    shuffle = conf.get("spark.sql.shuffle.partitions")
    partitions = conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", shuffle)
    return max(MIN_RANGES, min(MAX_RANGES, int(partitions)))


def score_curve(
    df: DataFrame, score: str, label: str, by: list[str] | None = None, ranges: int | None = None
) -> DataFrame:
    """Cumulative ``tp`` and ``fp`` at each distinct score, from the highest down.

    Rows are counted per distinct score once, in a written table. Its scores are cut into ranges
    of about equal number, however many rows share a score; each range is summed in its own task
    and started at the totals of the higher ranges. There are as many ranges as shuffle
    partitions, within limits, and the driver sees one number for each.
    """
    by = by or []
    ranges = ranges or _default_ranges(df)
    at = [i / ranges for i in range(1, ranges)]
    path = shared_dir(df.sparkSession, "scores")
    counted = score_counts(df, score, label, by)
    counted.write.parquet(path)
    counts = df.sparkSession.read.schema(counted.schema).parquet(path)
    cuts = counts.agg(F.percentile_approx("score", at, 50 * ranges)).first()[0]
    edges = sorted(set(cuts)) if cuts else [0.0]
    counts = bucketed(counts, "score", edges, "range").withColumn("_g", _group(by))
    sums = counts.groupBy("_g", "range").agg(F.sum("pos").alias("_pos"), F.sum("neg").alias("_neg"))
    # at most ``ranges`` rows per group
    whole = Window.partitionBy("_g")
    higher = whole.orderBy(F.desc("range")).rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select(
        "_g",
        "range",
        F.coalesce(F.sum("_pos").over(higher), F.lit(0)).alias("_tp0"),
        F.coalesce(F.sum("_neg").over(higher), F.lit(0)).alias("_fp0"),
        F.sum("_pos").over(whole).alias("p_total"),
        F.sum("_neg").over(whole).alias("n_total"),
    )
    down = Window.partitionBy("_g", "range").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0)
    inside = counts.withColumns({"_tp": F.sum("pos").over(down), "_fp": F.sum("neg").over(down)})
    return inside.join(starts, ["_g", "range"]).select(
        *by,
        "range",
        "score",
        "pos",
        "neg",
        (F.col("_tp0") + F.col("_tp")).alias("tp"),
        (F.col("_fp0") + F.col("_fp")).alias("fp"),
        "p_total",
        "n_total",
    )


def ranking_metrics(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Average precision, ROC-AUC (ties count half) and class sizes; NULL without a class."""
    by = by or []
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    ap = F.sum(F.col("pos") * precision)
    area = F.sum(F.col("neg") * (F.col("tp") - F.col("pos") / 2))
    p, n = F.max("p_total"), F.max("n_total")
    return curve.groupBy(*by).agg(
        F.try_divide(ap, p).alias("pr_auc"),
        F.try_divide(area, p * n).alias("roc_auc"),
        (p + n).alias("n"),
        p.alias("n_pos"),
    )


def corner_points(curve: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Drop curve points that lie on a straight line between their neighbours.

    A point stays when the step into it differs from the step out of it, or when it is
    the first or last. The step after a range is read from the next lower range.
    """
    step = F.struct("pos", "neg")
    curve = curve.withColumn("_g", _group(by))
    tops = curve.groupBy("_g", "range").agg(F.max_by(step, "score").alias("_top"))
    lower = Window.partitionBy("_g").orderBy(F.desc("range"))
    next_top = tops.select("_g", "range", F.lead("_top").over(lower).alias("_below"))
    inside = Window.partitionBy("_g", "range").orderBy(F.desc("score"))
    stepped = curve.withColumn("_next", F.lead(step).over(inside)).join(next_top, ["_g", "range"])
    following = F.coalesce("_next", "_below")
    first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
    keep = first | following.isNull() | (following != step)
    return stepped.where(keep).drop("_g", "_next", "_below")


def recall_at_fpr(
    curve: DataFrame, targets=FPR_TARGETS, by: list[str] | None = None, corners_only: bool = False
) -> DataFrame:
    """Recall and threshold at the last curve point within each false-positive rate.

    With no such point recall is 0 and the threshold infinite. ``corners_only`` looks at
    corner points alone, as ROC helpers that thin their curve do.
    """
    by = by or []
    points = corner_points(curve, by) if corners_only else curve

    def at(t: float) -> list[Column]:
        ok = F.try_divide(F.col("fp"), F.col("n_total")) <= t
        tag = f"{t * 100:g}".replace(".", "_")
        recall = F.try_divide(F.max(F.when(ok, F.col("tp"))), F.max("p_total"))
        return [
            F.when(F.max("p_total") > 0, F.coalesce(recall, F.lit(0.0))).alias(f"recall_{tag}pct"),
            F.coalesce(F.min(F.when(ok, F.col("score"))), F.lit(float("inf"))).alias(f"threshold_{tag}pct"),
        ]

    return points.groupBy(*by).agg(*[c for t in targets for c in at(t)])


def cost_grid(start: float = COST_GRID[0], stop: float = COST_GRID[1], count: int = COST_GRID[2]) -> list[float]:
    """Evenly spaced thresholds, both ends included."""
    step = (stop - start) / (count - 1)
    return [start + i * step for i in range(count - 1)] + [stop]


def cost_curve(
    df: DataFrame,
    score: str,
    label: str,
    amount: str,
    thresholds: list[float] | None = None,
    false_decline: float = FALSE_DECLINE_COST,
) -> DataFrame:
    """Cost and hits of every threshold in one pass over the rows.

    A row is flagged when its score is at or above the threshold; a missed positive
    costs its amount, a false decline a flat fee. Each row falls in one bin between
    thresholds, and sums over bins give every threshold.
    """
    thresholds = thresholds or cost_grid()
    spark = df.sparkSession
    is_pos = F.col(label) == 1
    binned = (
        bucketed(df.withColumn("_p", F.col(score).cast("double")), "_p", thresholds, "bin")
        .groupBy("bin")
        .agg(
            F.sum(F.when(is_pos, F.col(amount).cast(MONEY))).alias("_lost"),
            F.sum(F.when(is_pos, 1).otherwise(0)).alias("_pos"),
            F.sum(F.when(is_pos, 0).otherwise(1)).alias("_neg"),
        )
    )
    # one row per threshold plus one
    grid = spark.createDataFrame(
        [(0, None)] + [(i + 1, t) for i, t in enumerate(thresholds)], "bin int, threshold double"
    )
    full = grid.join(F.broadcast(binned), "bin", "left").fillna(0, ["_pos", "_neg"])
    everything = Window.partitionBy(F.lit(0))
    below = everything.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    above = everything.orderBy("bin").rowsBetween(0, Window.unboundedFollowing)
    swept = full.withColumns(
        {
            "missed": F.coalesce(F.sum("_lost").over(below), F.lit(0)).cast("double"),
            "false_declines": F.sum("_neg").over(above),
            "tp": F.sum("_pos").over(above),
            "positives": F.sum("_pos").over(everything),
        }
    )
    return swept.where("bin > 0").select(
        "threshold",
        "missed",
        (F.col("false_declines") * F.lit(float(false_decline))).alias("false_decline_cost"),
        (F.col("missed") + F.col("false_declines") * F.lit(float(false_decline))).alias("cost"),
        "tp",
        F.col("false_declines").alias("fp"),
        "positives",
        F.try_divide(F.col("tp"), F.col("positives")).alias("recall"),
        (F.col("tp") / F.greatest(F.col("tp") + F.col("false_declines"), F.lit(1))).alias("precision"),
    )


def best_threshold(curve: DataFrame) -> DataFrame:
    """The cheapest threshold; the lowest one on a tie."""
    row = F.struct(*curve.columns)
    return curve.agg(F.min_by(row, F.struct("cost", "threshold")).alias("_b")).select("_b.*")


def confusion_at(
    df: DataFrame, score: str, label: str, threshold: Column | float, amount: str | None = None
) -> DataFrame:
    """Hits, precision and recall of one threshold on any rows.

    Tune on one set and report on another by passing the tuned value, which may be a
    scalar subquery.
    """
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    flagged, pos = F.col(score) >= t, F.col(label) == 1

    def count(c: Column) -> Column:
        return F.sum(F.when(c, 1).otherwise(0))

    out = df.agg(
        count(flagged & pos).alias("tp"),
        count(flagged & ~pos).alias("fp"),
        count(~flagged & pos).alias("fn"),
        count(~flagged & ~pos).alias("tn"),
        *([F.coalesce(F.sum(F.when(~flagged & pos, F.col(amount).cast(MONEY))), F.lit(0))
           .cast("double").alias("missed")] if amount else []),
    )
    return out.withColumns(
        {
            "recall": F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")),
            "precision": F.col("tp") / F.greatest(F.col("tp") + F.col("fp"), F.lit(1)),
        }
    )


def leakage_gap(random_pr_auc: Column, time_pr_auc: Column, alarm: float = 0.05) -> list[Column]:
    """Gap between a random and a time split, and whether it is large."""
    gap = random_pr_auc - time_pr_auc
    return [gap.alias("gap"), (gap >= alarm).alias("alarm")]
