"""Lookups, skew-safe joins and the as-of join."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import epoch_micros
from ..session import written
from .skew import SLICE_ROWS, KeyProfile, profile_keys, with_key_values, with_slice

BROADCAST_BYTES = 64 * 1024 * 1024
# A key that only has to be sorted and walked once may be far larger than one whose
# frames are re-read.
LINEAR_HEAVY_ROWS = 1_000_000
DEFAULT_SALTS = 16


def estimated_bytes(schema: T.StructType, rows: int) -> int:
    """Upper-side guess of the in-memory size: 64 bytes per text or nested field."""
    flat = (T.NumericType, T.BooleanType, T.DatetimeType)
    width = sum(16 if isinstance(f.dataType, flat) else 64 for f in schema.fields)
    return rows * (width + 32)


def fits_broadcast(small: DataFrame, rows: int | None = None, limit: int = BROADCAST_BYTES) -> bool:
    """Whether ``small`` stays below ``limit``: its rows, unless given, and its texts are measured in one pass."""
    texts = [f.name for f in small.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    if rows is not None and (not texts or estimated_bytes(small.schema, rows) > limit):
        return estimated_bytes(small.schema, rows) <= limit
    lengths = [F.coalesce(F.sum(F.octet_length(c).cast("long")), F.lit(0)) for c in texts]
    n, *octets = small.agg(F.count(F.lit(1)), *lengths).first()
    return estimated_bytes(small.schema, n) + sum(octets) <= limit


def merge_join(big: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner") -> DataFrame:
    """Sort-merge join: both sides move by key."""
    return big.join(small.hint("merge"), on, how)


def salted_join(
    big: DataFrame,
    small: DataFrame,
    on: str | list[str],
    hot: KeyProfile | None,
    row_key: list[str] | None = None,
    how: str = "inner",
    salts: int = DEFAULT_SALTS,
    rows_per_salt: int = SLICE_ROWS,
    group_micros: int | None = None,
    strategy: str | None = "merge",
) -> DataFrame:
    """Shuffled join with each hot key of ``big`` spread over several tasks.

    The salt is a hash of the row, so a recomputed task gives the same one. A hot key
    gets one salt per ``rows_per_salt`` rows, and only its rows are repeated on the small
    side; all salts together number at most ``MAX_SLICES`` plus one per hot key. If the
    join also matches on time buckets, ``group_micros`` is their length. With
    ``hot=None`` every key gets ``salts`` salts. ``strategy`` is the join hint, if any.
    """
    if how not in ("inner", "left"):
        raise ValueError("salting repeats the small side: only inner and left are safe")
    on = [on] if isinstance(on, str) else on
    row_hash = F.xxhash64(*(row_key or big.columns))
    hinted = small.hint(strategy) if strategy else small
    if hot is None:
        left, right = big.withColumn("_salts", F.lit(salts)), small.withColumn("_salts", F.lit(salts))
    else:
        counts = _salts_per_key(hot, rows_per_salt, group_micros)
        if not counts:
            return big.join(hinted, on, how)
        left, right = (
            with_key_values(side, hot, counts, ["_salts"]).fillna(1, ["_salts"]) for side in (big, small)
        )
    left = left.withColumn("_salt", F.pmod(row_hash, F.col("_salts")).cast("int")).drop("_salts")
    right = right.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.col("_salts").cast("int") - 1))
    ).drop("_salts")
    right = right.hint(strategy) if strategy else right
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def _salts_per_key(hot: KeyProfile, rows_per_salt: int, group_micros: int | None) -> list[tuple]:
    per_salt = hot.share(rows_per_salt)
    counts = []
    for value, n, lo, hi in hot.above(per_salt) if hot.heavy else ():
        groups = (hi - lo) // group_micros + 1 if group_micros and lo is not None else 1
        salts = -(-n // (groups * per_salt))
        if salts > 1:
            counts.append((value, salts))
    return counts


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: str,
    how: str = "left",
    rows: int | None = None,
    profile: KeyProfile | None = None,
    row_key: list[str] | None = None,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Attach ``small`` to the rows of ``big``.

    A small side is broadcast, so ``big`` does not move; beyond ``limit`` bytes both are
    shuffled with the hot keys of ``big`` salted.
    """
    if fits_broadcast(small, rows, limit):
        return big.join(F.broadcast(small), on, how)
    profile = profile or profile_keys(big, on, heavy_rows=LINEAR_HEAVY_ROWS)
    return salted_join(big, small, on, profile, row_key, how=how)


def asof_join(
    left: DataFrame,
    right: DataFrame,
    by: str,
    left_time: str,
    right_time: str,
    cols: list[str],
    strict: bool = True,
    profile: KeyProfile | None = None,
    slice_rows: int | None = None,
) -> DataFrame:
    """Add ``cols`` of the latest ``right`` row before each left row (at or before unless strict).

    Both sides are stacked and walked once in time order, so no pairs are formed. Right
    rows at the same instant are ordered by ``cols``. Heavy keys are walked per time
    slice, with the last right row of earlier slices carried in.
    """
    l_side, r_side = (0, 1) if strict else (1, 0)
    l_rows = left.withColumns({"_t": epoch_micros(left_time), "_side": F.lit(l_side)})
    r_rows = right.where(F.col(by).isNotNull()).select(
        by, epoch_micros(right_time).alias("_t"), F.lit(r_side).alias("_side"),
        F.struct(*cols).alias("_r"),
    )
    both = l_rows.unionByName(r_rows, allowMissingColumns=True)
    if profile is None:
        profile = profile_keys(
            both.select(by, F.timestamp_micros("_t").alias("_time")), by, "_time",
            heavy_rows=LINEAR_HEAVY_ROWS,
        )
    order = ["_t", "_side", "_r"]
    latest = F.last("_r", ignorenulls=True)
    if not profile.heavy:
        w = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        found = both.withColumn("_r", latest.over(w))
    else:
        extra = {"slice_rows": slice_rows} if slice_rows else {}
        both = with_slice(both, profile, F.col("_t"), "_slice", **extra)
        w = Window.partitionBy(by, "_slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        lasts = (
            both.where("_slice >= 0")
            .groupBy(by, "_slice")
            .agg(F.max(F.when(F.col("_r").isNotNull(), F.struct("_t", "_r"))).alias("_m"))
        )
        earlier = Window.partitionBy(by).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        carried = lasts.select(
            by, "_slice", F.last(F.col("_m._r"), ignorenulls=True).over(earlier).alias("_carry")
        )
        # one row per slice of a heavy key, written: Spark broadcasts it if it is small
        found = (
            both.withColumn("_r", latest.over(w))
            .join(written(carried.where(F.col(by).isNotNull()), "carried"), [by, "_slice"], "left")
            .withColumn("_r", F.coalesce("_r", "_carry"))
        )
    return found.where(F.col("_side") == l_side).select(
        *left.columns, *[F.col(f"_r.{c}").alias(c) for c in cols]
    )
