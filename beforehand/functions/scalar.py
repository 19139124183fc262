"""Row-level expressions. All are built-in Spark columns, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_seconds(time: Column | str) -> Column:
    """Whole seconds since 1970; sub-seconds are floored away."""
    return F.unix_timestamp(_col(time))


def epoch_micros(time: Column | str) -> Column:
    return F.unix_micros(_col(time).cast("timestamp"))


def known_label(label: Column | str, confirmed: Column | str, cutoff) -> Column:
    """1 where the label is positive and was confirmed strictly before ``cutoff``."""
    cutoff = cutoff if isinstance(cutoff, Column) else F.to_timestamp(F.lit(str(cutoff)))
    return F.when((_col(label) == 1) & (_col(confirmed) < cutoff), 1).otherwise(0)


def in_days(date: str, start, end) -> Column:
    """The days that the time range [start, end) touches; on a partition column it skips folders."""
    day = F.col(date).cast("date")
    first, last = (F.to_date(F.to_timestamp(F.lit(str(t)))) for t in (start, end))
    return (day >= first) & (day <= last)


def in_range(time: Column | str, start, end) -> Column:
    """Half-open time range [start, end)."""
    t = _col(time)
    return (t >= F.to_timestamp(F.lit(str(start)))) & (t < F.to_timestamp(F.lit(str(end))))


def ratio_to_baseline(value: Column | str, mean: Column | str) -> Column:
    """Value against the entity's own mean; -1 marks an entity with no history."""
    return F.when(_col(mean).isNull(), F.lit(-1.0)).otherwise(_col(value) / (_col(mean) + F.lit(1e-6)))


def share_with_current(value: Column | str, total: Column | str) -> Column:
    """Share of the current value in history plus itself; NULL when both are zero."""
    return F.try_divide(_col(value), _col(total) + _col(value))


def flag_equals(value: Column | str, wanted) -> Column:
    """0/1 flag; NULL in gives NULL out."""
    return (_col(value) == F.lit(wanted)).cast("int")


def cross_border(a: Column | str, b: Column | str) -> Column:
    """1 where the two differ; NULL when either is NULL."""
    return (_col(a) != _col(b)).cast("int")


def ordinal(value: Column | str, codes: dict, default: int = 0) -> Column:
    """Code of each listed value; anything else, NULL included, gets ``default``."""
    out = None
    for name, code in codes.items():
        hit = _col(value) == F.lit(name)
        out = F.when(hit, code) if out is None else out.when(hit, code)
    return out.otherwise(default)


def weekend_flag(time: Column | str) -> Column:
    return F.dayofweek(_col(time)).isin(1, 7).cast("int")
