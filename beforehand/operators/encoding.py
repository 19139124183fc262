"""Smoothed target encoding that respects when a label became known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import epoch_micros, known_label
from .joins import LINEAR_HEAVY_ROWS, lookup_join
from .skew import SLICE_ROWS, KeyProfile, null_safe_join, profile_keys, running_totals

SMOOTHING = 20


def known_history(
    df: DataFrame, time: str, label: str, confirmed: str, hist_end, label_cutoff
) -> DataFrame:
    """Rows before ``hist_end`` with ``known`` = what the cutoff day knew about them.

    Where rows carry their ``txn_date``, later days are not read.
    """
    if "txn_date" in df.columns:
        df = df.where(F.col("txn_date") <= F.to_date(F.to_timestamp(F.lit(str(hist_end)))))
    return df.where(F.col(time) < F.to_timestamp(F.lit(str(hist_end)))).withColumn(
        "known", known_label(label, confirmed, label_cutoff)
    )


def tally(history: DataFrame, keys: list[str]) -> DataFrame:
    """Rows ``n`` and known positives ``hits`` per combination of ``keys``.

    One tally over several keys feeds the encodings of each and the global rate, so
    history is read and shuffled once.
    """
    return history.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.sum("known").alias("hits"))


def prior_rate(tallied: DataFrame) -> Column:
    """Global rate as a scalar subquery: lazy, and an error on no history."""
    return F.coalesce(
        tallied.agg(F.try_divide(F.sum("hits"), F.sum("n"))).scalar(),
        F.raise_error(F.lit("no history before hist_end: give a prior")).cast("double"),
    )


def target_encoding(
    tallied: DataFrame, key: str, name: str | None = None, k: int = SMOOTHING, prior: Column | float | None = None
) -> DataFrame:
    """One row per key: (hits + k * prior) / (n + k)."""
    g = prior_rate(tallied) if prior is None else prior if isinstance(prior, Column) else F.lit(float(prior))
    per_key = tallied.groupBy(key).agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
    return per_key.select(key, ((F.col("hits") + k * g) / (F.col("n") + k)).alias(name or f"{key}_te"))


def apply_encoding(
    df: DataFrame,
    encoding: DataFrame,
    key: str,
    prior: Column | float,
    rows: int | None = None,
    profile: KeyProfile | None = None,
    row_key: list[str] | None = None,
) -> DataFrame:
    """Look the encoding up; keys never seen in history get the prior.

    ``rows`` is any upper bound on the encoding's rows (the number of distinct keys).
    """
    name = next(c for c in encoding.columns if c != key)
    g = prior if isinstance(prior, Column) else F.lit(float(prior))
    joined = lookup_join(df, encoding, key, rows=rows, profile=profile, row_key=row_key)
    return joined.withColumn(name, F.coalesce(F.col(name), g))


def daily_prior(df: DataFrame, time: str, label: str, confirmed: str, first: float = 0.0) -> DataFrame:
    """Global known rate at the start of each day, from strictly earlier days.

    One row per calendar day between the first and last event.
    """
    known_at = F.greatest(F.col(confirmed), F.col(time))
    rows = df.groupBy(F.to_date(time).alias("_day")).agg(
        F.count(F.lit(1)).alias("_n"), F.lit(0).cast("long").alias("_p")
    )
    hits = (
        df.where((F.col(label) == 1) & F.col(confirmed).isNotNull())
        .groupBy(F.to_date(known_at).alias("_day"))
        .agg(F.lit(0).cast("long").alias("_n"), F.count(F.lit(1)).alias("_p"))
    )
    daily = rows.unionByName(hits).groupBy("_day").agg(F.sum("_n").alias("_n"), F.sum("_p").alias("_p"))
    # a single ordered group, but of calendar days
    w = Window.partitionBy(F.lit(0)).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    rate = F.try_divide(F.sum("_p").over(w), F.sum("_n").over(w))
    return daily.select("_day", F.coalesce(rate, F.lit(first)).alias("_prior"))


def target_encoding_asof(
    df: DataFrame,
    key: str,
    time: str,
    label: str,
    confirmed: str,
    name: str | None = None,
    k: int = SMOOTHING,
    prior: float | None = None,
    profile: KeyProfile | None = None,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Encode every row with what was known strictly before that row.

    Two clocks feed the encoding: a row counts from its own time on, its positive label
    from its confirmation on. Without a given ``prior`` the smoothing target is the
    global rate known at the start of the row's day.
    """
    profile = profile or profile_keys(df, key, time, heavy_rows=LINEAR_HEAVY_ROWS)
    name = name or f"{key}_te"
    us = epoch_micros(time)
    confirm_us = epoch_micros(F.greatest(F.col(confirmed), F.col(time)))
    rows = df.withColumns({"_us": us, "_n": F.lit(1).cast("long"), "_p": F.lit(0).cast("long")})
    hits = df.where((F.col(label) == 1) & F.col(confirmed).isNotNull()).select(
        key,
        confirm_us.alias("_us"),
        F.lit(0).cast("long").alias("_n"),
        F.lit(1).cast("long").alias("_p"),
    )
    light, heavy = profile.split(rows)
    light_hits, heavy_hits = profile.split(hits)

    before = Window.partitionBy(key).orderBy("_us").rangeBetween(Window.unboundedPreceding, -1)
    stacked = light.withColumn("_row", F.lit(True)).unionByName(light_hits, allowMissingColumns=True)
    counted = (
        stacked.withColumns({"_seen": F.sum("_n").over(before), "_hits": F.sum("_p").over(before)})
        .where("_row")
        .drop("_row", "_n", "_p")
    )
    if heavy is not None:
        # rows of one instant collapse first
        events = (
            heavy.select(key, "_us", "_n", "_p")
            .unionByName(heavy_hits)
            .groupBy(key, "_us")
            .agg(F.sum("_n").alias("_seen"), F.sum("_p").alias("_hits"))
        )
        totals = running_totals(events, key, "_us", exclusive=["_seen", "_hits"], slice_rows=slice_rows)
        counted = counted.unionByName(null_safe_join(heavy.drop("_n", "_p"), totals, [key, "_us"]))
    if prior is None:
        # one row per calendar day
        days = F.broadcast(daily_prior(df, time, label, confirmed))
        counted = counted.withColumn("_day", F.to_date(time)).join(days, "_day", "left").drop("_day")
    else:
        counted = counted.withColumn("_prior", F.lit(float(prior)))
    hits_n, seen_n = F.coalesce("_hits", F.lit(0)), F.coalesce("_seen", F.lit(0))
    te = (hits_n + k * F.col("_prior")) / (seen_n + k)
    return counted.withColumn(name, te).drop("_us", "_seen", "_hits", "_prior")


def target_encoding_by_period(
    df: DataFrame, key: str, time: str, label: str, confirmed: str, period: str = "month", k: int = SMOOTHING
) -> DataFrame:
    """Versioned encodings: one row per key and period start, from strictly earlier periods.

    A version exists for each period after one in which the key gained rows or labels;
    look it up as of a row's time with ``asof_join(..., strict=False)``.
    """
    step = F.expr(f"interval 1 {period}")

    def next_period(t: Column) -> Column:
        return (F.date_trunc(period, t) + step).alias("period")

    def changes(*by) -> DataFrame:
        rows = df.groupBy(*by, next_period(F.col(time))).agg(
            F.count(F.lit(1)).alias("_n"), F.lit(0).cast("long").alias("_p")
        )
        hits = (
            df.where((F.col(label) == 1) & F.col(confirmed).isNotNull())
            .groupBy(*by, next_period(F.greatest(F.col(confirmed), F.col(time))))
            .agg(F.lit(0).cast("long").alias("_n"), F.count(F.lit(1)).alias("_p"))
        )
        return rows.unionByName(hits).groupBy(*by, "period").agg(
            F.sum("_n").alias("_n"), F.sum("_p").alias("_p")
        )

    # one row per period of the calendar in each ordered group
    keyed = Window.partitionBy(key).orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    overall = Window.partitionBy(F.lit(0)).orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    prior = changes().select("period", (F.sum("_p").over(overall) / F.sum("_n").over(overall)).alias("_g"))
    versions = changes(key).select(
        key, "period", F.sum("_n").over(keyed).alias("n"), F.sum("_p").over(keyed).alias("hits")
    )
    return versions.join(F.broadcast(prior), "period", "left").select(
        key, "period", "n", "hits", ((F.col("hits") + k * F.col("_g")) / (F.col("n") + k)).alias(f"{key}_te")
    )
