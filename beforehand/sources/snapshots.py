"""Versioned tables: one folder per version plus a manifest of finished writes.

A version is readable once its manifest row exists, so a write that dies half-way stays
invisible and may be repeated. One writer at a time is assumed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

MANIFEST = "version long, committed_at timestamp, operation string, rows long"


def history(spark: SparkSession, root: str) -> DataFrame:
    """Finished versions: ``version, committed_at, operation, rows``."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{root}/manifest")
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST)


def write_snapshot(df: DataFrame, root: str, operation: str = "WRITE") -> int:
    """Write the next version and return its number. Rows are counted while writing."""
    spark = df.sparkSession
    latest = history(spark, root).agg(F.max("version")).first()[0]
    version = 0 if latest is None else latest + 1
    seen = Observation(f"snapshot-{version}")
    (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .parquet(f"{root}/data/snapshot_id={version}")
    )
    row = spark.range(1).select(
        F.lit(version).cast("long").alias("version"),
        F.current_timestamp().alias("committed_at"),
        F.lit(operation).alias("operation"),
        F.lit(seen.get["rows"]).cast("long").alias("rows"),
    )
    row.write.mode("append").parquet(f"{root}/manifest")
    return version


def read_snapshot(
    spark: SparkSession, root: str, version: int | None = None, as_of=None
) -> DataFrame:
    """Read a version: the given one, the last committed by ``as_of``, or the latest."""
    done = history(spark, root)
    if version is not None:
        done = done.where(F.col("version") == version)
    if as_of is not None:
        done = done.where(F.col("committed_at") <= F.to_timestamp(F.lit(str(as_of))))
    found = done.agg(F.max("version")).first()[0]
    if found is None:
        raise LookupError("no such snapshot")
    return spark.read.parquet(f"{root}/data/snapshot_id={found}")
