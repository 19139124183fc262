"""Small profiles of a table: skew, classes, labels, partitions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import known_label


def key_skew(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and share of the total."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    return counts.select(key, "n", (F.col("n") / total).alias("share"))


def top_keys(df: DataFrame, key: str, k: int = 3) -> DataFrame:
    """The ``k`` most frequent keys, ties by key."""
    return key_skew(df, key).orderBy(F.desc("n"), F.asc(key)).limit(k)


def partition_sizes(df: DataFrame) -> DataFrame:
    """Rows per non-empty partition: count, upper median, max, max over median."""
    return _size_summary(df, F.spark_partition_id())


def shuffle_sizes(df: DataFrame, keys: list[Column | str], partitions: int) -> DataFrame:
    """What ``partition_sizes`` would say after hash partitioning on ``keys``.

    Counts by the hash a shuffle assigns, with a map-side combine, so no row moves.
    """
    return _size_summary(df, F.pmod(F.hash(*keys), F.lit(partitions)))


def _size_summary(df: DataFrame, part: Column) -> DataFrame:
    sizes = df.groupBy(part.alias("_pid")).agg(F.count(F.lit(1)).alias("_n"))
    # one number per partition
    ordered = sizes.agg(F.sort_array(F.collect_list("_n")).alias("_s"))
    middle = F.element_at("_s", (F.floor(F.size("_s") / 2) + 1).cast("int"))
    return ordered.where(F.size("_s") > 0).select(
        F.size("_s").alias("partitions"),
        middle.alias("median_rows"),
        F.element_at("_s", -1).alias("max_rows"),
        (F.element_at("_s", -1) / F.greatest(middle, F.lit(1))).alias("max_over_median"),
    )


def input_partitions(df: DataFrame) -> DataFrame:
    """How many non-empty partitions the rows come in."""
    return df.select(F.spark_partition_id().alias("_pid")).distinct().agg(
        F.count(F.lit(1)).alias("partitions")
    )


def class_profile(df: DataFrame, label: str, means: dict[str, tuple[str, int]]) -> DataFrame:
    """Rounded means per class: output name -> (column, digits)."""
    return (
        df.groupBy(label)
        .agg(*[F.round(F.avg(c), digits).alias(name) for name, (c, digits) in means.items()])
        .orderBy(label)
    )


def dataset_profile(df: DataFrame, time: str, label: str) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(label).alias("positives"),
        F.avg(label).alias("rate"),
        F.min(time).alias("first_time"),
        F.max(time).alias("last_time"),
    )


def label_maturity(df: DataFrame, label: str, confirmed: str, cutoff) -> DataFrame:
    """True positives, those known at the cutoff, and the known share."""
    known = known_label(label, confirmed, cutoff)
    return df.agg(
        F.sum(label).cast("long").alias("positives"), F.sum(known).cast("long").alias("known")
    ).withColumn("known_share", F.try_divide(F.col("known"), F.col("positives")))


def class_weight(df: DataFrame, label: str) -> DataFrame:
    """Class counts and the weight sqrt(negatives / positives)."""
    pos, neg = (F.sum(F.when(F.col(label) == v, 1).otherwise(0)).cast("long") for v in (1, 0))
    return df.agg(pos.alias("n_pos"), neg.alias("n_neg")).withColumn(
        "pos_weight", F.sqrt(F.try_divide(F.col("n_neg"), F.col("n_pos")))
    )


def ranked_share(df: DataFrame, name: str, value: str, k: int | None = None) -> DataFrame:
    """Rows by falling value with their percentage of the total."""
    total = df.agg(F.sum(value)).scalar()
    out = df.select(
        name, value, F.round(F.try_divide(F.col(value), total) * 100, 1).alias(f"{value}_pct")
    ).orderBy(F.desc(value), F.asc(name))
    return out.limit(k) if k else out


def column_drift(reference: DataFrame, actual: DataFrame, column: str, bins: int = 10,
                 accuracy: int = 100_000) -> DataFrame:
    """Population stability index of ``column`` over quantile bins of the reference."""
    cuts = [i / bins for i in range(1, bins)]
    edges = F.array_distinct(reference.agg(F.percentile_approx(column, cuts, accuracy)).scalar())

    def shares(df: DataFrame, name: str) -> DataFrame:
        # bin = number of edges below the value
        at: Column = F.size(F.filter(F.col("_edges"), lambda e: e < F.col(column)))
        return (
            df.where(F.col(column).isNotNull())
            .withColumn("_edges", edges)
            .groupBy(at.alias("bin"))
            .agg(F.count(F.lit(1)).alias(name))
        )

    both = shares(reference, "n_ref").join(shares(actual, "n_act"), "bin", "full").fillna(0)
    # at most ``bins`` rows in the one group
    whole = Window.partitionBy(F.lit(0))
    n_ref, n_act = F.sum("n_ref").over(whole), F.sum("n_act").over(whole)
    # half a row stands in for an empty bin, so the logarithm exists
    a = F.greatest(F.col("n_act"), F.lit(0.5)) / n_act
    e = F.greatest(F.col("n_ref"), F.lit(0.5)) / n_ref
    return both.select("bin", "n_ref", "n_act", ((a - e) * F.ln(a / e)).alias("psi"))
