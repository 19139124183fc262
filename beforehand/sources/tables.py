"""Readers and writers of the logical tables."""

from __future__ import annotations

import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import in_days, in_range
from ..operators.joins import LINEAR_HEAVY_ROWS
from ..operators.skew import profile_keys
from .schemas import MERCHANTS, TRANSACTIONS, check_schema

KEYS = ("txn_id", "card_id", "merchant_id", "txn_country", "merchant_country")


def normalise(df: DataFrame) -> DataFrame:
    """Zoned timestamps, and a date column derived from the event time where there is none.

    A date column that is there, as of a table partitioned by it, stays as it is, so that
    filters on it still skip folders.
    """
    times = {
        f.name: F.col(f.name).cast("timestamp")
        for f in df.schema.fields
        if isinstance(f.dataType, T.TimestampNTZType)
    }
    out = df.withColumns(times) if times else df
    if "txn_date" in out.columns and isinstance(out.schema["txn_date"].dataType, T.DateType):
        return out
    return out.withColumn("txn_date", F.to_date("txn_time"))


def read_transactions(spark: SparkSession, path: str, start=None, end=None) -> DataFrame:
    """Scan a flat file or a date-partitioned folder; a range prunes its partitions."""
    df = spark.read.parquet(path)
    if start is not None and "txn_date" in df.columns:
        df = prune_dates(df, start, end)
    df = check_schema(normalise(df), TRANSACTIONS, KEYS)
    return df if start is None else df.where(in_range("txn_time", start, end))


def prune_dates(df: DataFrame, start, end, column: str = "txn_date") -> DataFrame:
    """The date range implied by the time range [start, end), so the scan skips folders."""
    return df.where(in_days(column, start, end))


def read_merchants(spark: SparkSession, path: str) -> DataFrame:
    return check_schema(spark.read.parquet(path), MERCHANTS, KEYS)


def read_features(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def write_partitioned(df: DataFrame, path: str, by: str = "txn_date") -> None:
    """Overwrite only the partitions present in ``df``, so a rerun of a day is idempotent.

    Rows are rebalanced by partition value first: big days split, small ones merge, and
    no task opens a file for every day.
    """
    (
        df.hint("rebalance", F.col(by))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def kept(spark: SparkSession, path: str, made: Callable[[], DataFrame]) -> DataFrame:
    """The rows below ``path``, made and written first where they are not there or not finished."""
    if not exists(spark, f"{path}/_SUCCESS"):
        made().write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    return spark.read.parquet(path)


def cluster_write(df: DataFrame, path: str, by: list[str], partitions: int | None = None) -> None:
    """Write files ordered by ``by`` so footers let a point lookup skip most of them.

    Ranges are cut on all of ``by``; with a time column last, a hot key spreads over files.
    """
    ranged = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    ranged.sortWithinPartitions(*by).write.mode("overwrite").option(
        "partitionOverwriteMode", "static"
    ).parquet(path)


def create_schema(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name}{where}")


def write_table(
    df: DataFrame,
    table: str,
    partition_by: str | None = None,
    fmt: str = "parquet",
    path: str | None = None,
    bucket_by: tuple[int, str] | None = None,
    sort_by: list[str] | None = None,
) -> str:
    """Replace a catalog table, its schema included. ``fmt`` may be any installed format.

    ``bucket_by`` = (buckets, key) stores each key's rows together, in ``sort_by`` order,
    so windows and joins by that key read the table without a shuffle. A bucket is read by
    one task, so a table in which some key outweighs two buckets is left unbucketed and
    ordered by ranges instead, with a warning. Returns the layout: bucketed, ranged or plain.
    """
    layout = "bucketed" if bucket_by else "plain"
    if bucket_by and not _buckets_even(df, *bucket_by):
        layout = "ranged"
        warnings.warn(f"{table}: a key outweighs its bucket, so the table is ordered, not bucketed", stacklevel=2)
        order = sort_by or [bucket_by[1]]
        rows, bucket_by = df.repartitionByRange(*order).sortWithinPartitions(*order), None
    elif bucket_by:
        # the hash of the shuffle is the hash of the buckets: one file per task
        rows = df.repartition(bucket_by[0], bucket_by[1])
    else:
        rows = df.hint("rebalance", F.col(partition_by)) if partition_by else df
    writer = rows.write.format(fmt).mode("overwrite").option("overwriteSchema", "true")
    writer = writer.option("partitionOverwriteMode", "static")
    if bucket_by:
        writer = writer.bucketBy(*bucket_by).sortBy(*(sort_by or [bucket_by[1]]))
    if partition_by:
        writer = writer.partitionBy(partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return layout


def _buckets_even(df: DataFrame, buckets: int, key: str, small: int = LINEAR_HEAVY_ROWS) -> bool:
    profile = profile_keys(df, key, heavy_rows=small)
    return not profile.heavy or profile.heavy[0][1] <= 2 * profile.rows / buckets


def write_metrics(metrics: DataFrame, path: str) -> None:
    """Write ``split, metric, value`` rows as one JSON object of objects."""
    # a handful of rows per run
    per_split = metrics.groupBy("split").agg(
        F.map_from_entries(F.collect_list(F.struct("metric", "value"))).alias("m")
    )
    whole = per_split.agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("split", "m")))).alias("value"))
    whole.coalesce(1).write.mode("overwrite").text(path)


def read_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Read a JSON object of objects (or of numbers) as ``split, metric, value`` rows."""
    df = spark.read.json(path, multiLine=True)
    entries = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.StructType):
            entries += [(f.name, g.name, F.col(f"`{f.name}`.`{g.name}`")) for g in f.dataType.fields]
        else:
            entries.append((f.name, f.name, F.col(f"`{f.name}`")))
    rows = F.array(
        *[
            F.struct(F.lit(s).alias("split"), F.lit(m).alias("metric"), c.cast("double").alias("value"))
            for s, m, c in entries
        ]
    )
    return df.select(F.inline(rows))


def write_importance(df: DataFrame, path: str) -> None:
    df.coalesce(1).write.mode("overwrite").csv(path, header=True)


def read_importance(
    spark: SparkSession, path: str, schema: str = "feature string, gain double, gain_pct double"
) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)
