"""Rolling history at a coarser grain: aggregate to time buckets first, then roll over buckets.

A row sees whole earlier buckets only, so its own bucket is hidden and values are up to
one bucket old. In exchange a hot key shrinks to one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import epoch_seconds
from .joins import fits_broadcast, salted_join
from .rolling import DAY, HOUR, WEEK
from .skew import KeyProfile


def bucket_start(time: Column | str, seconds: int = HOUR) -> Column:
    """First epoch second of the bucket a timestamp falls in."""
    t = epoch_seconds(time)
    return t - F.pmod(t, F.lit(seconds))


def bucket_counts(
    df: DataFrame, key: str, time: str, member: str, seconds: int = HOUR, distinct: str = "exact"
) -> DataFrame:
    """Rows ``n`` and distinct members ``nc`` per key and bucket.

    ``distinct`` is ``exact``, ``approx`` or ``sketch``; the last keeps a mergeable HLL
    sketch instead of a number. Exact counts are deduplicated per (key, bucket, member)
    before the final count, so no task sees a raw hot bucket.
    """
    nc = {
        "exact": lambda: F.count_distinct(member),
        "approx": lambda: F.approx_count_distinct(member),
        "sketch": lambda: F.hll_sketch_agg(member),
    }[distinct]()
    return df.groupBy(key, bucket_start(time, seconds).alias("hr_ts")).agg(
        F.count(F.lit(1)).alias("n"), nc.alias("nc")
    )


def rolling_buckets(
    buckets: DataFrame,
    key: str,
    count: str = "cnt_7d",
    members: str = "nmembers_24h",
    count_seconds: int = WEEK,
    member_seconds: int = DAY,
    sketched: bool = False,
) -> DataFrame:
    """Roll bucket counts over time. A key has at most one row per bucket of the calendar.

    Without sketches ``members`` is the sum of per-bucket distincts, so a member seen in
    three buckets counts three times; with sketches it is a true rolling distinct.
    """
    base = Window.partitionBy(key).orderBy("hr_ts")
    zero = F.lit(0).cast("long")
    near = base.rangeBetween(-member_seconds, -1)
    if sketched:
        rolled = F.hll_sketch_estimate(F.hll_union_agg("nc").over(near))
    else:
        rolled = F.sum("nc").over(near)
    return buckets.select(
        key,
        "hr_ts",
        F.coalesce(F.sum("n").over(base.rangeBetween(-count_seconds, -1)), zero).alias(count),
        F.coalesce(rolled, zero).alias(members),
    )


def join_buckets(
    df: DataFrame,
    rolled: DataFrame,
    key: str,
    time: str,
    seconds: int = HOUR,
    profile: KeyProfile | None = None,
    row_key: list[str] | None = None,
) -> DataFrame:
    """Give each row the rolled values of its bucket.

    With the profile of ``key`` the buckets are broadcast if their bound is small, and
    beyond that the rows of hot keys are salted.
    """
    rows = df.withColumn("hr_ts", bucket_start(time, seconds))
    on = [key, "hr_ts"]
    if profile is None:
        joined = rows.join(rolled, on, "left")
    elif fits_broadcast(rolled, profile.max_buckets(seconds)):
        joined = rows.join(F.broadcast(rolled), on, "left")
    else:
        joined = salted_join(
            rows, rolled, on, profile, row_key, "left", group_micros=seconds * 1_000_000, strategy=None
        )
    return joined.drop("hr_ts")
