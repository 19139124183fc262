"""What several of these operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import shared_dir

# Bytes and rows of a batch that are Python objects at once.
SLICE_BYTES = 2 << 20
SLICE_ROWS = 1000


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the shared folder, and read from there.

    Several jobs may then read it without computing it again, a lost executor costs no more
    than its tasks, and joins see the measured size.
    """
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut into slices of some rows and bytes, in their order.

    Python workers stay for the next stage and keep the most memory they once had, so what is
    made of a slice must not follow the size of Spark's batches.
    """
    for batch in batches:
        step = max(1, min(SLICE_ROWS, len(batch) * SLICE_BYTES // max(batch.nbytes, 1)))
        for at in range(0, len(batch), step):
            yield batch.slice(at, step)


def octets(text: str) -> Column:
    """UTF-8 bytes of a text, none for NULL."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def ranked(df: DataFrame, order: list[str], label: str) -> tuple[DataFrame, int]:
    """``df``, narrow, with ``rank`` from 0 in the order of ``order``, and the number of its rows.

    Rows are sorted in ranges, so no task holds more than a range. A range's first rank is
    the sum of the counts before it: one row for each partition, not for each key.
    """
    parts = saved(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), label)
    sizes = parts.groupBy("_part").agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    rows = parts.withColumn("_inside", inside).join(F.broadcast(first), "_part")
    rows = rows.withColumn("rank", F.col("_first") + F.col("_inside")).drop("_part", "_inside", "_first")
    return rows, parts.count()
