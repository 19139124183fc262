"""Raw landing: one row per key over all days, whatever is delivered late or again."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.quality import dedup
from ..session import discard, written
from .tables import normalise, write_partitioned

BUCKETS = 64
# Readers of the table skip folders whose names begin so.
KEYS_FOLDER = "_keys"
DAY = "txn_date"


def land_raw(df: DataFrame, path: str, key: str = "txn_id", order: str = "txn_time") -> None:
    """Land a raw batch: one row per key, partitioned by day, safe to rerun.

    Rows that landed on the batch's days before are kept: the batch is merged with them, so a late
    row of an old day adds to that day. Rows without a time share a day of their own. A key that
    landed on another day is found in a table of keys and days, kept in buckets beside the data and added to by
    each landing: of its rows the first in ``order`` stays (one with a time before one without),
    and only if that is the new one is the older day written again. No other day is read. Rows
    without a key cannot be told from copies of each other; landing the same batch again
    does not double them, as rows equal in every column are kept once. One writer at a time.
    """
    spark = df.sparkSession
    batch = written(normalise(df), "batch")
    days = {r[0] for r in batch.select(DAY).distinct().collect()}
    known = batch.where(F.col(key).isNotNull())
    landed = landed_rows(spark, path)
    parts, elsewhere = [batch], None
    if landed is not None:
        parts.append(landed.where(on_days(days)))
        keys = written(known.select(key).distinct(), "batch-keys")
        claims = landed_keys(spark, path, key).join(keys, key, "left_semi")
        others = {r[0] for r in claims.select(DAY).distinct().collect()} - days
        if others:
            elsewhere = landed.where(on_days(others)).join(keys, key, "left_semi")
            elsewhere = written(elsewhere, "elsewhere")
            parts.append(elsewhere)
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    first = dedup(rows.where(F.col(key).isNotNull()).withColumn("_timeless", F.col(order).isNull()), [key], ["_timeless", order])
    first = written(first.drop("_timeless"), "first")
    lost = rows.where(F.col(key).isNull()).distinct()
    out, rewritten = first.where(on_days(days)).unionByName(lost), set(days)
    if elsewhere is not None:
        # older days whose row gives way
        stays = first.select(F.col(key).alias("_key"), F.col(DAY).alias("_day"))
        beaten = elsewhere.join(stays, F.col(key) == F.col("_key")).where(~F.col(DAY).eqNullSafe(F.col("_day")))
        beaten = written(beaten.select(F.col(key).alias("_key"), F.col(DAY).alias("_day")), "beaten")
        opened = {r[0] for r in beaten.select("_day").distinct().collect()}
        if opened:
            same = (F.col(key) == F.col("_key")) & F.col(DAY).eqNullSafe(F.col("_day"))
            out = out.unionByName(landed.where(on_days(opened)).join(beaten, same, "left_anti"), allowMissingColumns=True)
            rewritten |= opened
    # written aside first: the days it replaces are among those it reads
    merged = written(out, "merged")
    # keys before rows: a claim without its row is looked up in vain, a row without its claim would be missed
    add_keys(first.where(on_days(days)).join(known.select(key), key, "left_semi"), path, key)
    write_partitioned(merged, path)
    for day in rewritten - {r[0] for r in merged.select(DAY).distinct().collect()}:
        discard(spark, f"{path}/{DAY}={'__HIVE_DEFAULT_PARTITION__' if day is None else day}")


def on_days(days: set) -> Column:
    """Whether a row is of one of these days; None stands for rows without a time."""
    known = F.coalesce(F.col(DAY).isin([d for d in days if d is not None]), F.lit(False))
    return known | F.col(DAY).isNull() if None in days else known


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return store.exists(where) and any(not f.getPath().getName().startswith(("_", ".")) for f in store.listStatus(where))


def landed_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The rows below ``path``, or None where nothing has landed yet."""
    return normalise(spark.read.parquet(path)) if _exists(spark, path) else None


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int").alias("bucket")


def add_keys(rows: DataFrame, path: str, key: str) -> None:
    keys = rows.where(F.col(key).isNotNull()).select(key, DAY, _bucket(key))
    keys.hint("rebalance", F.col("bucket")).write.mode("append").partitionBy("bucket").parquet(f"{path}/{KEYS_FOLDER}")


def landed_keys(spark: SparkSession, path: str, key: str) -> DataFrame:
    """``key, txn_date`` of what has landed, and perhaps of rows that have since given way.

    Made from the table itself where it is missing.
    """
    folder = f"{path}/{KEYS_FOLDER}"
    if not _exists(spark, folder):
        add_keys(landed_rows(spark, path), path, key)
    return spark.read.parquet(folder).select(key, DAY)
