"""Rolling aggregates over the seconds before each row, the current second excluded."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import epoch_micros, epoch_seconds
from .skew import SLICE_ROWS, KeyProfile, addend, next_instant, null_safe_join, previous_row, profile_keys, running_totals, spread

MINUTE, HOUR, DAY = 60, 3600, 86_400
WEEK = 7 * DAY

SHORT = 10 * SLICE_ROWS  # seconds

DEFAULT_RSD = 0.05
DIGITS = 9


@dataclass(frozen=True)
class Rolling:
    """One output column: ``agg`` of ``column`` over [t - seconds, t - 1]."""

    name: str
    agg: str  # count, sum, mean, distinct, approx_distinct
    seconds: int
    column: str | None = None
    rsd: float = DEFAULT_RSD


def rolling(
    df: DataFrame,
    key: str,
    time: str,
    specs: list[Rolling],
    route: str = "auto",
    profile: KeyProfile | None = None,
    grain: str = "second",
) -> DataFrame:
    """Add the rolling columns of ``specs``.

    Empty frames give 0 for counts and sums and NULL for means. Routes: ``window`` uses
    Spark's range frames, ``sweep`` a linear running-sum form, ``auto`` the window for
    keys of ordinary size and the sweep for keys too heavy for one task. Approximate distinct counts
    are Spark's estimates on the ``window`` route alone; ``auto`` sweeps all rows for them, so their error is
    zero whatever the keys' sizes.

    At ``second`` grain a frame is [t - seconds, t - 1] in whole seconds, so rows of the
    same second never see each other; at ``micro`` grain it ends one microsecond before
    the row. ``time`` may also be a whole number already counted in that grain.
    """
    tick = {"second": 1, "micro": 1_000_000}[grain]
    to_ticks = epoch_seconds if tick == 1 else epoch_micros
    if _integral(df, time):
        at, added = time, []
    else:
        df, at, added = df.withColumn("_at", to_ticks(time)), "_at", ["_at"]
    if route == "auto":
        if profile is None:
            micros = F.col(at) * (1_000_000 // tick)
            profile = profile_keys(df.withColumn("_time", F.timestamp_micros(micros)), key, "_time")
        estimated = any(s.agg == "approx_distinct" for s in specs)
        # the sweep counts exactly, so a key's value does not depend on what other keys there are
        if profile.truncated or estimated:
            route = "sweep"
        elif profile.heavy:
            light, heavy = profile.split(df)
            both = _by_window(spread(light, profile.rows, key), key, at, specs, tick).unionByName(
                _by_sweep(heavy, key, at, specs, tick, profile)
            )
            return both.drop(*added)
        else:
            route = "window"
    if route not in ("window", "sweep"):
        raise ValueError(f"unknown route {route!r}")
    if route == "window":
        return _by_window(df, key, at, specs, tick).drop(*added)
    return _by_sweep(df, key, at, specs, tick, profile).drop(*added)


def _integral(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.IntegralType)


def exact(df: DataFrame, column: str) -> Column:
    """What sums add up, on every route: whole numbers, or decimals with ``DIGITS`` after the point.

    Decimals add to the same total in any order, so a key's size cannot change a value. NaN,
    infinity and numbers of 20 digits before the point have no such form and fail.
    """
    if _integral(df, column):
        return F.col(column).cast("long")
    value = F.col(column)
    if isinstance(df.schema[column].dataType, T.FractionalType) and not isinstance(df.schema[column].dataType, T.DecimalType):
        refused = F.raise_error(F.lit(f"NaN or infinity in {column}")).cast("double")
        value = F.when(F.isnan(value - value), refused).otherwise(value)
    return value.cast(f"decimal(28,{DIGITS})")


def _by_window(df: DataFrame, key: str, at: str, specs: list[Rolling], tick: int) -> DataFrame:
    base = Window.partitionBy(key).orderBy(at)

    def value(s: Rolling) -> Column:
        frame = base.rangeBetween(-s.seconds * tick, -1)
        if s.agg == "count":
            return F.count(F.lit(1)).over(frame)
        if s.agg == "sum":
            total = F.coalesce(F.sum(exact(df, s.column)).over(frame), F.lit(0))
            return total.cast("long" if _integral(df, s.column) else "double")
        if s.agg == "mean":
            total = F.sum(exact(df, s.column)).over(frame).cast("double")
            return F.try_divide(total, F.count(s.column).over(frame))
        if s.agg == "distinct":
            return F.size(F.collect_set(s.column).over(frame)).cast("long")
        if s.agg == "approx_distinct":
            return F.approx_count_distinct(s.column, s.rsd).over(frame)
        raise ValueError(f"unknown aggregate {s.agg!r}")

    return df.withColumns({s.name: value(s) for s in specs})


def _by_sweep(
    df: DataFrame, key: str, at: str, specs: list[Rolling], tick: int, profile: KeyProfile | None
) -> DataFrame:
    """All rows of one key and instant share their rolling values, so work at that grain.

    Rows are first summed per (key, instant). A value enters after its instant and leaves
    ``seconds`` later; the rolling value is what entered minus what left, both running
    sums. For distinct counts each (key, member) interval is cut at the member's next
    appearance, so a member never counts twice. Differences of long sums stay exact on the
    numbers of ``exact``. A day of whole seconds bounds a slice of a key by itself; at
    microseconds slices are even cuts of its events.
    """
    width = DAY if tick == 1 else None
    # a member is seen at most once a second: on a short calendar it needs no slices
    short = tick == 1 and profile and profile.first is not None and profile.last - profile.first < SHORT * 1_000_000
    sums = sorted({s.column for s in specs if s.agg in ("sum", "mean")})
    means = sorted({s.column for s in specs if s.agg == "mean"})
    amount = {c: exact(df, c) for c in sums}
    rows = profile.rows if profile else df.count()
    per_instant = spread(df, rows, key, at).groupBy(key, F.col(at).alias("_at")).agg(
        F.count(F.lit(1)).alias("_m_rows"),
        *[F.coalesce(F.sum(amount[c]), F.lit(0)).alias(f"_m_sum_{c}") for c in sums],
        *[F.count(c).alias(f"_m_cnt_{c}") for c in means],
    )

    def measures(s: Rolling) -> list[str]:
        return {
            "count": ["rows"],
            "sum": [f"sum_{s.column}"],
            "mean": [f"sum_{s.column}", f"cnt_{s.column}"],
        }.get(s.agg, [])

    gone = sorted({(m, s.seconds) for s in specs for m in measures(s)})
    frames = sorted({n for _, n in gone})
    seen = sorted({m for m, _ in gone})
    members = sorted({(s.column, s.seconds) for s in specs if s.agg in ("distinct", "approx_distinct")})

    moments = [F.struct(F.col("_at").alias("at"), F.lit(0).alias("frame"))] + [
        F.struct((F.col("_at") + n * tick + 1).alias("at"), F.lit(n).alias("frame")) for n in frames
    ]
    base = per_instant.withColumn("_e", F.explode(F.array(*moments)))
    zero = F.lit(0)
    events = base.select(
        key,
        F.col("_e.at").alias("_at"),
        (F.col("_e.frame") == 0).alias("_ask"),
        *[F.when(F.col("_e.frame") == 0, F.col(f"_m_{m}")).otherwise(zero).alias(f"_in_{m}") for m in seen],
        *[
            F.when(F.col("_e.frame") == n, F.col(f"_m_{m}")).otherwise(zero).alias(f"_out_{m}_{n}")
            for m, n in gone
        ],
    )
    parts = [events] + [_member_events(df, key, at, c, n, tick, bool(short), rows) for c, n in members]
    events = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    inclusive = [f"_out_{m}_{n}" for m, n in gone] + [f"_dst_{c}_{n}" for c, n in members]
    swept = running_totals(events, key, "_at", inclusive, [f"_in_{m}" for m in seen], width, rows=rows).where("_ask")

    def left(m: str, n: int) -> Column:
        return addend(swept, f"_in_{m}") - addend(swept, f"_out_{m}_{n}")

    def value(s: Rolling) -> Column:
        if s.agg == "count":
            return left("rows", s.seconds)
        if s.agg == "sum":
            return left(f"sum_{s.column}", s.seconds).cast("long" if _integral(df, s.column) else "double")
        if s.agg == "mean":
            return F.try_divide(
                left(f"sum_{s.column}", s.seconds).cast("double"), left(f"cnt_{s.column}", s.seconds)
            )
        return F.col(f"_dst_{s.column}_{s.seconds}")

    result = swept.select(key, F.col("_at").alias(at), *[value(s).alias(s.name) for s in specs])
    zeros = {s.name: 0 for s in specs if s.agg != "mean"}
    return null_safe_join(df, result, [key, at], rows).fillna(zeros)


def _member_events(
    df: DataFrame, key: str, at: str, column: str, seconds: int, tick: int, short: bool, rows: int
) -> DataFrame:
    """+1 when a member becomes visible in the frame, -1 when it no longer is."""
    members = df.where(F.col(column).isNotNull())
    seen = members.select(key, F.col(column).alias("_m"), F.col(at).alias("_at"))
    seen = spread(seen, rows, key, "_m", *([] if short else ["_at"])).distinct()
    if short:
        again = F.lead("_at").over(Window.partitionBy(key, "_m").orderBy("_at"))
        seen = seen.withColumn("_again", again)
    else:
        seen = next_instant(seen, key, "_m", "_at", "_again")
    # least() skips a NULL
    spans = seen.select(key, "_at", F.least(F.col("_at") + seconds * tick, F.col("_again")).alias("_last"))
    steps = F.array(
        F.struct((F.col("_at") + 1).alias("at"), F.lit(1).cast("long").alias("d")),
        F.struct((F.col("_last") + 1).alias("at"), F.lit(-1).cast("long").alias("d")),
    )
    moves = spans.select(key, F.explode(steps).alias("_e")).select(key, F.col("_e.at").alias("_at"), F.col("_e.d").alias("_d"))
    return (
        spread(moves, rows, key, "_at")
        .groupBy(key, "_at")
        .agg(F.sum("_d").alias(f"_dst_{column}_{seconds}"))
        .withColumn("_ask", F.lit(False))
    )


def since_last(
    df: DataFrame,
    key: str,
    time: str,
    tie: str,
    seconds: str = "secs_since_last",
    changed: dict[str, str] | None = None,
    profile: KeyProfile | None = None,
    slice_rows: int | None = None,
) -> DataFrame:
    """Seconds since the key's previous row (-1 on the first), and change flags.

    ``changed`` maps a column to the name of a 0/1 flag saying it differs from the
    previous row; a NULL on either side gives 0. Rows are ordered by (second, ``tie``),
    so unlike the rolling frames this does see an earlier row of the same second.
    """
    changed = changed or {}
    extra = {"slice_rows": slice_rows} if slice_rows else {}
    if _integral(df, time):
        at, added = time, []
    else:
        df, at, added = df.withColumn("_sec", epoch_seconds(time)), "_sec", ["_sec"]
    # slices are cut on whole seconds, so rows tied on the second share one
    micros = F.col(at) * 1_000_000 if profile and profile.heavy else None
    out = previous_row(df, key, [at, tie], [at, *changed], profile, micros, **extra)
    flags = {
        flag: F.coalesce((F.col(f"_prev.{c}") != F.col(c)).cast("int"), F.lit(0))
        for c, flag in changed.items()
    }
    gap = F.coalesce(F.col(at) - F.col(f"_prev.{at}"), F.lit(-1).cast("long"))
    return out.withColumns({seconds: gap, **flags}).drop("_prev", *added)


def since_last_flagged(
    df: DataFrame, key: str, time: str, tie: str, flag: str, name: str, route: str = "auto",
    profile: KeyProfile | None = None,
) -> DataFrame:
    """Seconds since the key's previous row with ``flag`` = 1 (-1 when there is none)."""
    from .joins import asof_join

    hits = df.where(F.col(flag) == 1).select(key, time, epoch_seconds(time).alias("_hit")).distinct()
    out = asof_join(df, hits, key, time, time, ["_hit"], strict=True, profile=profile)
    return out.withColumn(
        name, F.coalesce(epoch_seconds(time) - F.col("_hit"), F.lit(-1).cast("long"))
    ).drop("_hit")
