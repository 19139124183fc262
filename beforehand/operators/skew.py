"""Finding keys that hold too many rows for one task, and cutting them into time slices.

A window needs a whole key in one task. That is fine for nearly every key, and wrong
for the few that hold a large share of the table. ``profile_keys`` finds those with one
pre-aggregated pass; their rows are then worked on per (key, time slice), with the
little that crosses a slice border carried over in a small table. Borders are quantiles of
the key's own times, so slices are even whether its rows come steadily or in a burst.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import epoch_micros
from ..session import written

# A sliding frame re-reads its frame for each row, so the cost of a key grows with the
# square of its rows: above this many, a key leaves the plain window.
HEAVY_ROWS = 20_000
MAX_HEAVY_KEYS = 10_000
SLICE_ROWS = 200_000
MAX_SLICES = 100_000
# Rows of a table whose events, sums and frames one task works on.
TASK_ROWS = 50_000
CASE_KEYS = 16
MERGED = (256, 16, 1)


@dataclass(frozen=True)
class KeyProfile:
    """What one counting pass says about a key column."""

    key: str
    key_type: T.DataType
    keys: int
    rows: int
    first: int | None  # micros of the earliest and latest row
    last: int | None
    heavy: tuple[tuple, ...]  # (value, rows, first micros, last micros), largest first
    truncated: bool  # more heavy keys exist than are listed
    heavy_rows: int = HEAVY_ROWS
    counted: DataFrame | None = field(default=None, compare=False, repr=False)  # every heavy key, as rows of ``heavy``

    def share(self, rows: int) -> int:
        """``rows``, or more where fewer would make over ``MAX_SLICES`` shares of the table."""
        return max(rows, -(-self.rows // MAX_SLICES))

    def above(self, rows: int) -> list[tuple]:
        """All heavy keys of more than ``rows`` rows, as in ``heavy``, however long its list may be.

        There are at most ``MAX_SLICES`` keys above a share of the table. Those beyond the list are
        counted again.
        """
        if not self.truncated or rows >= self.heavy[-1][1]:
            return [h for h in self.heavy if h[1] > rows]
        return [tuple(r) for r in self.counted.where(F.col("n") > self.share(rows)).collect()]

    def max_buckets(self, seconds: int) -> int:
        """Upper bound on the (key, time bucket) pairs that can exist."""
        if self.first is None:
            return self.rows
        return min(self.rows, self.keys * ((self.last - self.first) // (seconds * 1_000_000) + 2))

    def split(self, df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
        """(rows of light keys, rows of heavy keys or None)."""
        if not self.heavy:
            return df, None
        listed = [h[0] for h in self.above(self.share(self.heavy_rows))]
        if len(listed) > CASE_KEYS:
            marked = with_key_values(df, self, [(v, 1) for v in listed], ["_hot"])
            return marked.where("_hot IS NULL").drop("_hot"), marked.where("_hot = 1").drop("_hot")
        hit = F.coalesce(F.col(self.key).isin([v for v in listed if v is not None]), F.lit(False))
        if None in listed:
            hit = hit | F.col(self.key).isNull()
        return df.where(~hit), df.where(hit)


def profile_keys(
    df: DataFrame,
    key: str,
    time: str | None = None,
    heavy_rows: int = HEAVY_ROWS,
    max_heavy: int = MAX_HEAVY_KEYS,
) -> KeyProfile:
    """Count rows per key and list the heavy ones.

    Counts combine on the map side, so a hot key costs one row per task. The driver
    receives at most ``max_heavy`` + 1 rows. Rows without a key count as one key.
    """
    return profile_many(df, [key], time, heavy_rows, max_heavy)[key]


def profile_many(
    df: DataFrame,
    keys: list[str],
    time: str | None = None,
    heavy_rows: int = HEAVY_ROWS,
    max_heavy: int = MAX_HEAVY_KEYS,
) -> dict[str, KeyProfile]:
    """Profiles of several key columns from one job and one scan: totals and the largest counts."""
    t = epoch_micros(time) if time else F.lit(None).cast("long")
    names = [f"k{i}" for i in range(len(keys))]
    rows = df.select(*[F.col(key).alias(n) for key, n in zip(keys, names)], t.alias("_t"))
    tally = [F.count(F.lit(1)).alias("n"), F.min("_t").alias("lo"), F.max("_t").alias("hi")]
    per_key = rows.groupingSets([[n] for n in names], *names).agg(F.grouping_id().alias("set"), *tally)
    # one bit per column, set where the column is not grouped by
    sets = [2 ** len(keys) - 1 - 2 ** (len(keys) - 1 - i) for i in range(len(keys))]
    # the lists of the largest merge in steps, so none gathers more than some of bounded length
    one = F.struct((-F.col("n")).alias("m"), *names, "lo", "hi")
    merged = per_key.select(
        "set",
        F.pmod(F.xxhash64(*names), F.lit(MERGED[0])).alias("bin"),
        F.lit(1).cast("long").alias("keys"),
        (F.col("n") > heavy_rows).cast("long").alias("over"),
        "n", "lo", "hi",
        F.when(F.col("n") > heavy_rows, F.array(one)).alias("top"),
    )
    for bins in MERGED:
        merged = merged.groupBy("set", F.pmod("bin", F.lit(bins)).alias("bin")).agg(
            *[F.sum(c).alias(c) for c in ("keys", "over", "n")],
            F.min("lo").alias("lo"),
            F.max("hi").alias("hi"),
            F.slice(F.array_sort(F.flatten(F.collect_list("top"))), 1, max_heavy).alias("top"),
        )
    got = {r["set"]: r for r in merged.collect()}
    found = {}
    for i, (key, name, s) in enumerate(zip(keys, names, sets)):
        total = got.get(s)
        found[key] = KeyProfile(
            key=key,
            key_type=df.schema[key].dataType,
            keys=total["keys"] if total else 0,
            rows=total["n"] if total else 0,
            first=total["lo"] if total else None,
            last=total["hi"] if total else None,
            heavy=tuple((h[name], -h["m"], h["lo"], h["hi"]) for h in total["top"]) if total else (),
            truncated=bool(total) and total["over"] > max_heavy,
            heavy_rows=heavy_rows,
            counted=rows.groupBy(name).agg(*tally).where(F.col("n") > heavy_rows),
        )
    return found


def with_key_values(
    df: DataFrame, profile: KeyProfile, rows: list[tuple], names: list[str]
) -> DataFrame:
    """Add long columns looked up by key in ``rows`` of (key, value, …); NULL for other keys.

    A few keys become a CASE expression, more a broadcast table of at most
    ``MAX_SLICES`` rows.
    """
    key = F.col(profile.key)
    if len(rows) <= CASE_KEYS:
        columns = {}
        for i, name in enumerate(names, 1):
            found = F.lit(None).cast("long")
            for row in rows:
                hit = key.eqNullSafe(F.lit(row[0]).cast(profile.key_type))
                found = F.when(hit, F.lit(row[i]).cast("long")).otherwise(found)
            columns[name] = found
        return df.withColumns(columns)
    fields = [T.StructField("_heavy", profile.key_type), *[T.StructField(n, T.LongType()) for n in names]]
    table = df.sparkSession.createDataFrame(rows, T.StructType(fields))
    return df.join(F.broadcast(table), key.eqNullSafe(F.col("_heavy")), "left").drop("_heavy")


def _sketch_size(slices: int) -> int:
    """Items a quantile sketch keeps so that a border is off by at most a quarter of a slice.

    Its rank error is about 2.296 / k ** 0.9021 of the rows; past 65,535 items, the most there
    can be, it stays at a ten-thousandth of the key.
    """
    return min(65_535, max(200, math.ceil((2.296 * 4 * slices) ** (1 / 0.9021))))


def _slice_borders(df: DataFrame, key: str, at: Column, keys: DataFrame, halvings: list[int]) -> DataFrame:
    """``_heavy, _borders``: where slices of the keys listed in ``keys`` (``_heavy, _halvings``) begin.

    A key in 2 ** h slices has the quantiles 1 / 2 ** h, 2 / 2 ** h, … of its own ``at`` as
    borders, from a mergeable sketch: one row a key and task moves, whatever the key holds.
    """
    times = df.select(F.col(key).alias("_key"), at.cast("long").alias("_t")).where("_t IS NOT NULL")
    rows = times.join(F.broadcast(keys), F.col("_key").eqNullSafe(F.col("_heavy")))
    sketches = [
        F.kll_sketch_agg_bigint(F.when(F.col("_halvings") == h, F.col("_t")), F.lit(_sketch_size(2**h))).alias(f"_s{h}")
        for h in halvings
    ]
    borders = F.lit(None).cast("array<bigint>")
    for h in halvings:
        # one constant, however many there are
        ranks = F.split(F.lit(",".join(str(i / 2**h) for i in range(1, 2**h))), ",").cast("array<double>")
        quantiles = F.kll_sketch_get_quantile_bigint(f"_s{h}", ranks)
        borders = F.when(F.col("_halvings") == h, quantiles).otherwise(borders)
    per_key = rows.groupBy("_heavy", "_halvings").agg(*sketches)
    return per_key.select("_heavy", F.array_distinct(borders).alias("_borders"))


def _at_or_before(borders: Column, at: Column, most: int) -> Column:
    """How many of the ascending ``borders`` are at or before ``at``, by binary search."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(most.bit_length()))])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda found, step: F.when(F.get(borders, found + step - 1) <= at, found + step).otherwise(found),
    )


def _cut(df: DataFrame, key: str, at: Column, sizes: list[tuple], key_type: T.DataType, per_slice: int, name: str) -> DataFrame:
    if not sizes:
        return df.withColumn(name, F.lit(-1).cast("long"))
    halved = [(value, max(1, math.ceil(math.log2(n / per_slice)))) for value, n in sizes]
    fields = [T.StructField("_heavy", key_type), T.StructField("_halvings", T.IntegerType())]
    keys = df.sparkSession.createDataFrame(halved, T.StructType(fields))
    halvings = sorted({h for _, h in halved})
    # at most MAX_SLICES keys and twice as many borders, so small enough to broadcast
    borders = written(_slice_borders(df, key, at, keys, halvings), "slice-borders")
    joined = df.join(F.broadcast(borders), F.col(key).eqNullSafe(F.col("_heavy")), "left")
    found = F.coalesce(_at_or_before(F.col("_borders"), at, 2 ** halvings[-1]), F.lit(0))
    number = F.when(F.col("_borders").isNull(), F.lit(-1)).otherwise(found)
    return joined.withColumn(name, number.cast("long")).drop("_heavy", "_borders")


def with_slice(
    df: DataFrame,
    profile: KeyProfile,
    micros: Column,
    name: str = "_slice",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Number the time slice of each row: -1 for light keys, 0..m in the order of time for heavy ones.

    A heavy key is cut at quantiles of its times in ``df``, so a slice holds about
    ``slice_rows`` rows however they are spread; rows of one instant share a slice. All
    slices together number at most twice ``MAX_SLICES``.
    """
    per_slice = profile.share(slice_rows)
    sizes = [h[:2] for h in profile.above(per_slice)] if profile.heavy else []
    return _cut(df, profile.key, micros, sizes, profile.key_type, per_slice, name)


def even_slices(df: DataFrame, key: str, at: str, name: str = "_slice", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """As ``with_slice`` for a written table without a profile: its keys are counted first."""
    rows = df.count()
    per_slice = max(slice_rows, -(-rows // MAX_SLICES))
    if rows <= per_slice:
        return df.withColumn(name, F.lit(-1).cast("long"))
    sizes = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > per_slice).collect()
    return _cut(df, key, F.col(at), [tuple(r) for r in sizes], df.schema[key].dataType, per_slice, name)


def spread(df: DataFrame, rows: int | None, *columns: str) -> DataFrame:
    """``df`` shuffled by ``columns`` into as many tasks as ``rows``, those of the table it is made from, ask.

    A task then holds the same share however large the table is and whatever number of partitions
    the session starts shuffles with. Small tables, and those of unknown size, are left to the planner.
    """
    if not rows or rows <= TASK_ROWS * df.sparkSession.sparkContext.defaultParallelism:
        return df
    return df.repartition(-(-rows // TASK_ROWS), *columns)


def null_safe_join(left: DataFrame, right: DataFrame, on: list[str], rows: int | None = None) -> DataFrame:
    """Left join on ``on`` in which NULL keys match each other; ``rows`` as in ``spread``."""
    if spread(left, rows, *on) is not left:
        # a struct is never NULL
        one = F.struct(*on)
        left, right = (spread(d, rows, "_on") for d in (left.withColumn("_on", one), right.select(one.alias("_on"), *[c for c in right.columns if c not in on])))
        return left.join(right, "_on", "left").drop("_on")
    right = right.withColumnsRenamed({c: f"_on_{c}" for c in on})
    condition = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_on_{c}")) for c in on])
    return left.join(right, condition, "left").drop(*[f"_on_{c}" for c in on])


def previous_row(
    df: DataFrame,
    key: str,
    order: list[str],
    cols: list[str],
    profile: KeyProfile | None = None,
    micros: Column | None = None,
    name: str = "_prev",
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Add a struct of ``cols`` of the key's previous row in ``order`` (NULL on the first).

    A heavy key is cut into time slices; the first row of a slice takes the last row of
    the nearest earlier slice that has any.
    """
    if profile is None or not profile.heavy:
        w = Window.partitionBy(key).orderBy(*order)
        return df.withColumn(name, F.lag(F.struct(*cols)).over(w))
    df = with_slice(df, profile, micros, "_slice", slice_rows)
    w = Window.partitionBy(key, "_slice").orderBy(*order)
    inside = df.withColumn(name, F.lag(F.struct(*cols)).over(w))
    lasts = (
        df.where("_slice >= 0")
        .groupBy(key, "_slice")
        .agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_last"))
    )
    carried = lasts.select(
        key, "_slice", F.lag("_last").over(Window.partitionBy(key).orderBy("_slice")).alias("_carry")
    )
    # one row per slice, written: Spark broadcasts it if it is small
    return (
        null_safe_join(inside, written(carried, "carried"), [key, "_slice"])
        .withColumn(name, F.coalesce(name, "_carry"))
        .drop("_slice", "_carry")
    )


def next_instant(df: DataFrame, key: str, member: str, at: str, name: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Add the next ``at`` of the (key, member) pair (NULL on the last); rows must be distinct in all three.

    Worked on per (key, member, slice of the key); the last row of a slice takes the first
    instant of the next slice that has any.
    """
    df = even_slices(written(df, "instants"), key, at, "_slice", slice_rows)
    group = [key, member]
    firsts = df.where("_slice >= 0").groupBy(*group, "_slice").agg(F.min(at).alias("_first"))
    by_slice = Window.partitionBy(*group).orderBy("_slice")
    following = firsts.select(*group, "_slice", F.lead("_first").over(by_slice).alias("_after"))
    inside = Window.partitionBy(*group, "_slice").orderBy(at)
    return (
        null_safe_join(df.withColumn(name, F.lead(at).over(inside)), following, [*group, "_slice"])
        .withColumn(name, F.coalesce(name, "_after"))
        .drop("_slice", "_after")
    )


def addend(df: DataFrame, column: str) -> Column:
    """``column``, 0 for NULL; a decimal leaves room for one more digit, so that adding keeps its scale."""
    kind = df.schema[column].dataType
    value = F.coalesce(column, F.lit(0))
    return value.cast(f"decimal(37,{kind.scale})") if isinstance(kind, T.DecimalType) else value


def running_totals(
    events: DataFrame,
    key: str,
    at: str,
    inclusive: list[str] = (),
    exclusive: list[str] = (),
    width: int | None = None,
    slice_rows: int = SLICE_ROWS,
    rows: int | None = None,
) -> DataFrame:
    """Replace each listed column by its running sum over ``at`` within ``key``.

    ``inclusive`` sums count the current instant, ``exclusive`` ones stop before it.
    Work is split by (key, slice of ``width``), or, without a width, by even slices of the keys
    with over ``slice_rows`` events, which are written first; totals of earlier slices are added as an
    offset, so no task holds more than one slice of a key. Cost is linear. ``rows`` as in ``spread``.
    """
    cols = [*inclusive, *exclusive]
    if width:
        events = events.withColumn("_slice", F.col(at) - F.pmod(F.col(at), F.lit(width)))
    else:
        events = even_slices(written(events, "events"), key, at, "_slice", slice_rows)
    # a struct is never NULL, so rows without a key join to their offsets too
    events = events.withColumn("_key", F.struct(key))
    events = spread(events, rows, "_key", "_slice")
    totals = spread(events.groupBy("_key", "_slice").agg(*[F.sum(c).alias(c) for c in cols]), rows, "_key")
    earlier = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "_key", "_slice", *[F.sum(c).over(earlier).alias(f"_off_{c}") for c in cols]
    )
    inside = Window.partitionBy("_key", "_slice").orderBy(at)
    upto = inside.rangeBetween(Window.unboundedPreceding, 0)
    before = inside.rangeBetween(Window.unboundedPreceding, -1)
    sums = {c: F.sum(c).over(upto) for c in inclusive} | {c: F.sum(c).over(before) for c in exclusive}
    joined = events.withColumns(sums).join(offsets, ["_key", "_slice"], "left")
    return joined.withColumns(
        {c: addend(joined, c) + addend(joined, f"_off_{c}") for c in cols}
    ).drop("_key", "_slice", *[f"_off_{c}" for c in cols])
