"""Deduplication and data-quality gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class GateError(RuntimeError):
    """A quality rule was broken."""


def dedup(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keep one row per business key: the first in ``order``, then in the other columns.

    A row in which a key is NULL is nobody's copy: all such rows are kept. Copies combine on the
    map side, so a key with very many copies stays cheap.
    """
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*order, *[c for c in rest if c not in order])
    missing = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    apart = df.withColumn("_apart", F.when(missing, F.monotonically_increasing_id()))
    kept = apart.groupBy(*keys, "_apart").agg(F.min_by(F.struct(*rest), rank).alias("_kept"))
    return kept.select(*[F.col(c) if c in keys else F.col(f"_kept.{c}").alias(c) for c in df.columns])


def table_checks(df: DataFrame, key: str, not_null: list[str]) -> DataFrame:
    """Long table ``metric, value``: rows, distinct keys, duplicate rows, NULL rates."""
    one = F.count(F.lit(1))
    # counted per key first: copies collapse on the map side
    per_key = df.groupBy(key).agg(
        one.alias("_n"), *[F.sum(F.col(c).isNull().cast("long")).alias(f"_null_{c}") for c in not_null]
    )
    total = F.sum("_n")
    row = per_key.agg(
        F.coalesce(total, F.lit(0)).cast("double").alias("rows"),
        F.count(F.col(key)).cast("double").alias("distinct_keys"),
        F.coalesce(total - F.count(F.col(key)), F.lit(0)).cast("double").alias("duplicate_rows"),
        *[F.try_divide(F.sum(f"_null_{c}"), total).cast("double").alias(f"null_rate_{c}") for c in not_null],
    )
    return row.unpivot([], row.columns, "metric", "value")


def row_drift(df: DataFrame, history: DataFrame) -> DataFrame:
    """Long table ``metric, value``: rows, rows of the last finished version, change as a share of those.

    ``history`` has ``version, rows``; earlier counts come from it, so no old data is read. Without an
    earlier version, or after an empty one, the share is NULL and breaks any rule on it.
    """
    last = history.agg(F.max_by("rows", "version").cast("double").alias("rows_before"))
    now = df.agg(F.count(F.lit(1)).cast("double").alias("rows"))
    both = concat(now, last).agg(F.max("rows").alias("rows"), F.max("rows_before").alias("rows_before"))
    change = F.try_divide(F.abs(F.col("rows") - F.col("rows_before")), F.col("rows_before"))
    row = both.withColumn("row_drift", change)
    return row.unpivot([], row.columns, "metric", "value")


def gate(metrics: DataFrame, rules: list[tuple[str, str, float]]) -> DataFrame:
    """Broken rules as rows ``metric, op, bound, value``; a missing metric breaks its rule.

    ``rules`` are (metric, ``min`` or ``max``, bound).
    """
    table = metrics.sparkSession.createDataFrame(rules, "metric string, op string, bound double")
    joined = table.join(metrics.select("metric", "value"), "metric", "left")
    ok = F.when(F.col("op") == "min", F.col("value") >= F.col("bound")).otherwise(
        F.col("value") <= F.col("bound")
    )
    return joined.where(~F.coalesce(ok, F.lit(False))).select("metric", "op", "bound", "value")


def enforce(metrics: DataFrame, rules: list[tuple[str, str, float]]) -> None:
    """Raise when any rule is broken."""
    broken = gate(metrics, rules).collect()
    if broken:
        raise GateError("; ".join(f"{r.metric} {r.op} {r.bound}: got {r.value}" for r in broken))


def concat(*frames: DataFrame) -> DataFrame:
    """Stack frames by column name; a column missing from one is NULL there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
