"""Keys of a stream in groups, so that Python is called, and state is read and written, once a group and not once a key."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

# A stream's state keeps to it: a changed number is another stream.
GROUPS = 4096
STORED = T.StructType([T.StructField("_stored", T.BinaryType())])
# Types that pandas keeps as they are; the others go to Python and back as text.
PLAIN = (T.StringType, T.BinaryType)


def group(key: str, groups: int = GROUPS) -> Column:
    """Number of the group that a key belongs to."""
    return F.pmod(F.xxhash64(key), F.lit(groups)).cast("int").alias("_group")


def told(df: DataFrame, column: str) -> Column:
    """``column`` as Python takes it, NULL and every digit kept."""
    return F.col(column) if isinstance(df.schema[column].dataType, PLAIN) else F.col(column).cast("string")


def told_type(kind: T.DataType) -> T.DataType:
    return kind if isinstance(kind, PLAIN) else T.StringType()


def stored(value) -> tuple[bytes]:
    return (pickle.dumps(value, protocol=5),)


def restored(state) -> list:
    return [pickle.loads(bytes(row[0])) for row in state.get()]


def summed(place: np.ndarray, *measures: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct places in ascending order, and the total of each measure there."""
    order = np.argsort(place, kind="stable")
    places, starts = np.unique(place[order], return_index=True)
    return places, [np.add.reduceat(m[order], starts) if len(starts) else m[:0] for m in measures]


def coded(keys: list, codes: dict) -> np.ndarray:
    """A number for each of ``keys``; ``codes`` holds those given so far."""
    return np.fromiter((codes.setdefault(k, len(codes)) for k in keys), np.int64, len(keys))


def lasting(codes: dict, code: np.ndarray) -> tuple[list, np.ndarray]:
    """The keys whose numbers are in ``code``, and ``code`` as places in that list."""
    left, place = np.unique(code, return_inverse=True)
    names = list(codes)
    return [names[c] for c in left], place


class Once(StatefulProcessor):
    """A processor whose timers of one group are answered once a batch, however many have expired."""

    mark, answered = None, frozenset()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator:
        mark = timerValues.getCurrentWatermarkInMs()
        if mark != self.mark:
            self.mark, self.answered = mark, set()
        if key in self.answered:
            return iter(())
        self.answered.add(key)
        return self.passed(mark)

    def passed(self, mark: int) -> Iterator:
        """What the watermark at ``mark`` lets out of the group at hand."""
        raise NotImplementedError
