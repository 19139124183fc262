"""Streaming counterpart of the hourly buckets."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessorHandle, StreamingQuery

from ..functions import epoch_seconds
from ..operators.rolling import HOUR
from ..session import shared_dir
from .groups import STORED, Once, coded, group, lasting, restored, stored, summed, told, told_type

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


# The time of a closing mark, and a time between all events and it.
CLOSED, OPEN = "9998-01-01", "9000-01-01"


def watermarked(stream: DataFrame, time: str, late: str) -> DataFrame:
    """The stream's events, with a watermark that closing marks move but in which they don't count.

    The condition names the event time, so that it is applied behind the watermark.
    """
    return stream.withWatermark(time, late).where(F.col(time) < F.lit(OPEN).cast("timestamp"))


def closing(stream: DataFrame, time: str) -> tuple[DataFrame, Callable[[], None]]:
    """The stream, and a function that ends it: all that waits for the watermark is then given out.

    It puts a mark, a row far in the future, into a folder that is streamed too. Rows that come
    after it are late.
    """
    spark, folder = stream.sparkSession, shared_dir(stream.sparkSession, "marks")
    marks = [F.lit(CLOSED if f.name == time else None).cast(f.dataType).alias(f.name) for f in stream.schema.fields]
    mark = spark.range(1).select(*marks)
    mark.limit(0).write.parquet(folder)
    both = stream.unionByName(spark.readStream.schema(stream.schema).parquet(folder))
    return both, lambda: mark.write.mode("append").parquet(folder)


def bucket_stream(
    stream: DataFrame, key: str, time: str, late: str = "1 hour", seconds: int = HOUR, member: str | None = None
) -> DataFrame:
    """Rows, and distinct members if asked for, per key and bucket of an event stream.

    A bucket is emitted once the watermark passes its end; rows later than ``late`` are
    left out and show in the query's ``numRowsDroppedByWatermark``. Partial aggregation
    runs before the shuffle, so a hot key sends one row per task and bucket. Members are
    counted exactly: rows are first summed by (key, bucket, member), so a hot key's state is
    spread over its members, and the closed sums then per (key, bucket).
    """
    rows = watermarked(stream, time, late)
    w = F.window(time, f"{seconds} seconds").alias("_w")
    if member:
        each = rows.groupBy(key, w, F.col(member).alias("_m")).agg(F.count(F.lit(1)).alias("_n"))
        per = each.groupBy(key, "_w").agg(F.sum("_n").alias("n"), F.count("_m").alias("nc"))
        return per.select(key, F.unix_timestamp("_w.start").alias("hr_ts"), "n", "nc")
    return rows.groupBy(key, w).agg(F.count(F.lit(1)).alias("n")).select(
        key, F.unix_timestamp("_w.start").alias("hr_ts"), "n"
    )


# Windows made at a time; the buckets of one key are not parted.
WINDOWS = 2_000_000


class RollingBuckets(Once):
    """State of a group of keys: rows by key and bucket, and how far windows have been given out.

    A bucket is stored once, not once a window it is in. When the watermark passes the end of
    windows, they are added up from the buckets they reach; a bucket of no later window is dropped.
    """

    def __init__(self, length: int, step: int):
        self.length, self.step = length, step

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.buckets = handle.getListState("buckets", STORED)
        self.given = handle.getValueState("given", T.StructType([T.StructField("_mark", T.LongType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        codes: dict = {}
        parts = [(coded(part.iloc[:, 2].tolist(), codes), part.iloc[:, 1].to_numpy(np.int64)) for part in rows]
        code, at = (np.concatenate(x) for x in zip(*parts))
        self.buckets.appendValue(stored((list(codes), *self._by_bucket(code, at, np.ones(len(at), np.int64)))))
        self._wake(timerValues.getCurrentWatermarkInMs())
        return iter(())

    def passed(self, mark: int) -> Iterator[pd.DataFrame]:
        given = self.given.get()[0] if self.given.exists() else 0
        codes: dict = {}
        parts = []
        for keys, code, at, n in restored(self.buckets):
            parts.append((coded(keys, codes)[code], at, n))
        code, at, n = self._by_bucket(*(np.concatenate(x) for x in zip(*parts)))
        left = (at + self.length) * 1000 > mark
        if left.any():
            keys, place = lasting(codes, code[left])
            self.buckets.put([stored((keys, place, at[left], n[left]))])
            self._wake(mark)
        else:
            self.buckets.clear()
        self.given.update((mark,))

        names = np.array([*codes, None], object)[:-1]
        ends = np.arange(1, self.length // self.step + 1) * self.step
        # buckets are in the order of their keys; a cut lies where a key begins
        begins = np.flatnonzero(np.diff(code, prepend=-1))
        cuts = [begins[np.searchsorted(begins, i)] for i in range(0, begins[-1] + 1, max(1, WINDOWS // len(ends)))]
        for low, high in zip(cuts, [*cuts[1:], len(code)]):
            end = (at[low:high, None] + ends).ravel()
            due = (end * 1000 > given) & (end * 1000 <= mark)
            if due.any():
                key, count = (np.repeat(x[low:high], len(ends))[due] for x in (code, n))
                key, end, count = self._by_bucket(key, end[due], count)
                yield pd.DataFrame({"key": names[key], "hr_ts": end, "n": count})

    def _by_bucket(self, code: np.ndarray, at: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        base, width = at.min(), np.ptp(at) + 1
        places, (n,) = summed(code * width + (at - base), n)
        return places // width, places % width + base, n

    def _wake(self, mark: int) -> None:
        """A timer at the next end of a window."""
        self.handle.registerTimer((mark // (self.step * 1000) + 1) * self.step * 1000)


def rolling_stream(
    stream: DataFrame, key: str, time: str, length: int, step: int = HOUR, late: str = "1 hour"
) -> DataFrame:
    """Rows per key over the ``length`` seconds before each bucket start ``hr_ts``.

    The streaming form of rolling over buckets: the value a row of bucket ``hr_ts`` sees.
    A row is kept once, in its bucket, and counts in those of its ``length / step`` windows that have
    not been given out. Keys are worked on in ``GROUPS`` groups by their hash, and are of an atomic type.
    """
    rows = watermarked(stream, time, late)
    at = epoch_seconds(time)
    # without the event time itself, so that a late row still counts in windows that are open
    sent = rows.select(group(key), (at - F.pmod(at, F.lit(step))).alias("_at"), told(rows, key).alias("_key"))
    kind = rows.schema[key].dataType
    fields = [T.StructField("key", told_type(kind)), T.StructField("hr_ts", T.LongType()), T.StructField("n", T.LongType())]
    out = sent.groupBy("_group").transformWithStateInPandas(
        RollingBuckets(length, step), T.StructType(fields), "append", "EventTime"
    )
    return out.select(F.col("key").cast(kind).alias(key), "hr_ts", "n")


def dedup_stream(stream: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """Drop repeated deliveries of a key that arrive within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def file_stream(spark: SparkSession, like: DataFrame, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream the parquet files of a folder, read with the schema of ``like``."""
    reader = spark.readStream.schema(like.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def run_available(df: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process all waiting input into parquet files, exactly once, then stop.

    State is kept in RocksDB unless the session names another store, so it may outgrow
    executor memory.
    """
    conf = df.sparkSession.conf
    if conf.get(STATE_STORE).endswith(".HDFSBackedStateStoreProvider"):
        conf.set(STATE_STORE, ROCKSDB)
    query = (
        df.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query


def run_closed(df: DataFrame, close: Callable[[], None], path: str, checkpoint: str) -> StreamingQuery:
    """``run_available``, then once more after ``close`` of ``closing``: nothing stays open."""
    run_available(df, path, checkpoint)
    close()
    return run_available(df, path, checkpoint)
