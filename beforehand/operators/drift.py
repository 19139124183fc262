"""Drift between any two periods from stored sketches: raw rows are read once, when their day is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import in_days

# Items a sketch keeps: its ranks are off by at most about 2.296 / ITEMS ** 0.9021, 0.13 %.
ITEMS = 4096
# Quantiles read from a merged sketch; shares are off by one of these steps more.
GRID = 1000
RANK_ERROR = 2.296 / ITEMS**0.9021 + 1 / GRID


def daily_sketches(df: DataFrame, columns: list[str], date: str = "txn_date") -> DataFrame:
    """A row for each day and column: ``date, column, n, nulls, sketch`` of its values (NaN counts as NULL).

    Sketches combine on the map side and merge over days: one row a day and column is all that is kept.
    """
    value = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
    per_day = df.groupBy(date).agg(
        *[
            F.struct(
                F.lit(c).alias("column"),
                F.count(value[c]).alias("n"),
                F.count_if(value[c].isNull()).alias("nulls"),
                F.kll_sketch_agg_double(value[c], F.lit(ITEMS)).alias("sketch"),
            ).alias(f"_s{i}")
            for i, c in enumerate(columns)
        ]
    )
    return per_day.select(date, F.inline(F.array(*[f"_s{i}" for i in range(len(columns))])))


def _constant(values: list[float]) -> Column:
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<double>")


def _period(sketches: DataFrame, start, end, date: str, name: str) -> DataFrame:
    """``column``, its rows and the quantiles of the days [start, end)."""
    days = sketches.where(in_days(date, start, end) & (F.col(date) < F.to_date(F.lit(str(end)))) & (F.col("n") > 0))
    merged = days.groupBy("column").agg(F.sum("n").alias(f"n_{name}"), F.kll_merge_agg_double("sketch").alias("_m"))
    at = _constant([i / GRID for i in range(1, GRID + 1)])
    return merged.select("column", f"n_{name}", F.kll_sketch_get_quantile_double("_m", at).alias(f"_{name}"))


def stored_drift(sketches: DataFrame, reference: tuple, actual: tuple, bins: int = 10, date: str = "txn_date") -> DataFrame:
    """``column, bin, n_ref, n_act, psi``: the stability index of every column between two ranges of days [from, to).

    Bins are quantiles of the reference, as in ``column_drift``, of whose shares these are off by at most
    about twice RANK_ERROR. A column without a value in one of the periods has no row.
    """
    both = _period(sketches, *reference, date, "ref").join(_period(sketches, *actual, date, "act"), "column")
    steps = [round(i * GRID / bins) for i in range(1, bins)]
    edges = F.array_distinct(F.transform(F.array(*map(F.lit, steps)), lambda i: F.get("_ref", i - 1)))
    both = both.withColumn("_edges", F.array_append(edges, F.lit(float("inf"))))

    def upto(name: str) -> Column:
        """Share of the period at or below each edge."""
        return F.transform("_edges", lambda e: F.size(F.filter(f"_{name}", lambda v: v <= e)) / GRID)

    both = both.withColumns({"_upto_ref": upto("ref"), "_upto_act": upto("act")})

    def rows(name: str, i: Column) -> Column:
        share = F.get(f"_upto_{name}", i) - F.coalesce(F.get(f"_upto_{name}", i - 1), F.lit(0.0))
        return (share * F.col(f"n_{name}")).alias(f"n_{name}")

    per_bin = both.select(
        "column", "n_ref", "n_act",
        F.inline(F.transform(F.sequence(F.lit(0), F.size("_edges") - 1), lambda i: F.struct(i.alias("bin"), rows("ref", i).alias("r"), rows("act", i).alias("c")))),
    )
    # half a row stands in for an empty bin, so the logarithm exists
    a = F.greatest(F.col("c"), F.lit(0.5)) / F.col("n_act")
    e = F.greatest(F.col("r"), F.lit(0.5)) / F.col("n_ref")
    return per_bin.select("column", "bin", F.col("r").alias("n_ref"), F.col("c").alias("n_act"), ((a - e) * F.ln(a / e)).alias("psi"))
