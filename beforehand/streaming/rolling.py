"""Rolling counts, sums and means of a stream, row by row, with the values of the batch form."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessorHandle

from ..functions import epoch_micros
from ..operators.rolling import DIGITS, Rolling, exact
from .counters import watermarked
from .groups import STORED, Once, coded, group, lasting, restored, stored, summed, told, told_type

SCALE = 10**DIGITS


def _units(values: pd.Series, whole: bool) -> list[int | None]:
    """Values of ``exact`` as whole numbers: themselves, or in units of their last digit."""
    return [None if v is None else int(v if whole else v.scaleb(DIGITS)) for v in values]


class RollingRows(Once):
    """State of a group of keys: rows that wait for the watermark, and sums by key and second of what is behind it.

    A row is stored once. When the watermark passes it, no earlier row can come any more: it
    is given out with its frames, read as differences of running sums, and joins the sums of
    its second. Seconds no frame reaches any longer are dropped; a group whose last is gone holds nothing.
    """

    def __init__(self, names: list[str], specs: list[Rolling], columns: list[str], whole: set[str]):
        self.names, self.specs, self.columns, self.whole = names, specs, columns, whole
        self.longest = max(s.seconds for s in specs)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", STORED)
        self.seconds = handle.getListState("seconds", STORED)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            us = part.iloc[:, 1].to_numpy(np.int64)
            own = [part.iloc[:, 2 + i].tolist() for i in range(len(self.names))]
            values = [_units(part.iloc[:, 2 + len(self.names) + i], c in self.whole) for i, c in enumerate(self.columns)]
            self.waiting.appendValue(stored((us, own, values)))
            first = us.min() if first is None else min(first, us.min())
        if first is not None:
            self.handle.registerTimer(int(first) // 1000 + 1)
        return iter(())

    def passed(self, mark: int) -> Iterator[pd.DataFrame]:
        waiting = restored(self.waiting)
        us = np.concatenate([np.empty(0, np.int64), *[w[0] for w in waiting]])
        own, values = ([_joined([w[part][i] for w in waiting]) for i in range(n)]
                       for part, n in ((1, len(self.names)), (2, len(self.columns))))
        out = us // 1000 < mark
        codes: dict = {}
        code, at, sums = self._kept(codes)
        ready = [c[out] for c in own]
        mine, second = coded(ready[0].tolist(), codes), us[out] // 1_000_000

        # all keys on one line: a key's seconds, and as far before them as a frame reaches
        code, at = np.concatenate([code, mine]), np.concatenate([at, second])
        base = (at.min() if len(at) else 0) - self.longest - 1
        width = (at.max() if len(at) else 0) - base + 2
        places, sums = summed(code * width + (at - base), *[np.concatenate(x) for x in zip(sums, self._measures(values, out))])
        code, at = places // width, places % width + base
        upto = [np.concatenate([np.zeros(1, s.dtype), np.add.accumulate(s)]) for s in sums]

        # what is left: rows to come, and the seconds that their frames still reach
        if out.any():
            if out.all():
                self.waiting.clear()
            else:
                self.waiting.put([stored((us[~out], [c[~out].tolist() for c in own], [v[~out].tolist() for v in values]))])
        if not out.all():
            self.handle.registerTimer(int(us[~out].min()) // 1000 + 1)
        reached = at >= mark // 1000 - self.longest
        if reached.any():
            keys, code = lasting(codes, code[reached])
            self.seconds.put([stored((keys, code, at[reached], [s[reached] for s in sums]))])
            self.handle.registerTimer((int(at[reached].max()) + self.longest + 1) * 1000)
        else:
            self.seconds.clear()
        if len(second):
            spot = mine * width + (second - base)
            yield pd.DataFrame(dict(enumerate([*ready, *self._frames(spot, places, upto)]))).set_axis(
                [*self.names, *(s.name for s in self.specs)], axis=1
            )

    def _kept(self, codes: dict) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Key, second and sums of what the group's state holds."""
        for keys, code, at, sums in restored(self.seconds):
            coded(keys, codes)
            return code, at, sums
        none = np.empty(0, np.int64)
        return none, none, [none, *[x for _ in self.columns for x in (none.astype(object), none)]]

    def _measures(self, values: list[np.ndarray], out: np.ndarray) -> list[np.ndarray]:
        """Rows, and per column the sum, any size of number, and the count of its values."""
        found = [np.ones(out.sum(), np.int64)]
        for v in values:
            there = np.array([x is not None for x in v[out]], bool)
            found += [np.where(there, v[out], 0).astype(object), there.astype(np.int64)]
        return found

    def _frames(self, spot: np.ndarray, places: np.ndarray, upto: list[np.ndarray]) -> Iterator[np.ndarray]:
        high = np.searchsorted(places, spot)
        for s in self.specs:
            low = np.searchsorted(places, spot - s.seconds)
            of = lambda i: upto[i][high] - upto[i][low]
            if s.agg == "count":
                yield of(0)
                continue
            i = 1 + 2 * self.columns.index(s.column)
            # the nearest double of the exact decimal, as a cast gives it
            total = of(i) if s.column in self.whole else np.array([x / SCALE for x in of(i)], float)
            if s.agg == "sum":
                yield total
            else:
                n = of(i + 1)
                yield np.array([x / m if m else np.nan for x, m in zip(total.tolist(), n.tolist())], float)


def _joined(lists: list[list]) -> np.ndarray:
    joined = np.empty(sum(map(len, lists)), object)
    joined[:] = [x for part in lists for x in part]
    return joined


def rolling_rows(
    stream: DataFrame, key: str, time: str, specs: list[Rolling], keep: list[str], late: str = "1 hour"
) -> DataFrame:
    """``key``, the columns ``keep`` and the rolling columns of ``specs`` of every row of a stream.

    Frames are those of the batch form at second grain. A row is given out once the watermark has passed it;
    rows later than ``late`` are left out and show in ``numRowsDroppedByWatermark``. State per key is its
    waiting rows and one entry a second of its longest frame: at most 86,400 for a day, however
    many rows it has. Keys are worked on in ``GROUPS`` groups by their hash; the key and the columns
    kept are of atomic types. Counts, sums and means only.
    """
    if any(s.agg not in ("count", "sum", "mean") for s in specs):
        raise ValueError("a stream keeps counts, sums and means")
    columns = sorted({s.column for s in specs if s.column})
    whole = {c for c in columns if isinstance(stream.schema[c].dataType, T.IntegralType)}
    rows = watermarked(stream, time, late)
    own = [key, *keep]

    def value(c: str) -> Column:
        v = exact(rows, c)
        # a decimal, so that pandas makes no double of whole numbers beside a NULL
        return (v.cast("decimal(19,0)") if c in whole else v).alias(f"_v{columns.index(c)}")

    names = [f"own{i}" for i, _ in enumerate(own)]
    # the event time itself comes last: late rows are told by it
    sent = rows.select(
        group(key), epoch_micros(time).alias("_us"), *[told(rows, c).alias(n) for c, n in zip(own, names)],
        *[value(c) for c in columns], F.col(time).alias("_time"),
    )

    def kind(s: Rolling) -> T.DataType:
        return T.LongType() if s.agg == "count" or s.agg == "sum" and s.column in whole else T.DoubleType()

    given = [f"rolled{i}" for i, _ in enumerate(specs)]
    shape = T.StructType(
        [T.StructField(n, told_type(rows.schema[c].dataType)) for c, n in zip(own, names)]
        + [T.StructField(n, kind(s)) for s, n in zip(specs, given)]
    )
    state = RollingRows(names, [Rolling(n, s.agg, s.seconds, s.column) for s, n in zip(specs, given)], columns, whole)
    out = sent.groupBy("_group").transformWithStateInPandas(state, shape, "append", "EventTime")
    return out.select(
        *[F.col(n).cast(rows.schema[c].dataType).alias(c) for c, n in zip(own, names)],
        *[F.col(n).alias(s.name) for s, n in zip(specs, given)],
    )
