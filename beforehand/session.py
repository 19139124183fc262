"""Session factory and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every operator relies on.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # hash instead of sort where every partition of the small side measures below this
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # small sides may be the end of a long aggregation
    "spark.sql.broadcastTimeout": "7200",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.ui.enabled": "false",
}

# Shuffles and scans of a cluster. Many partitions to start with, which the
# adaptive planner merges to the advisory size.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "8192",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
}

_local_root: str | None = None
_scopes: list[list[str]] = []


def build_session(app: str = "beforehand", master: str | None = None, **extra) -> SparkSession:
    """A session with the engine's settings; ``extra`` uses ``__`` for dots.

    Away from a local master the cluster settings apply too.
    """
    given = {name.replace("__", "."): str(value) for name, value in extra.items()}
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **given}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        for name, value in {**CLUSTER_SETTINGS, **given}.items():
            if name in CLUSTER_SETTINGS:
                spark.conf.set(name, value)
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``.

    A machine-local folder is used only when the master itself is local and the
    setting is absent, as in tests.
    """
    global _local_root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        if _local_root is None:
            _local_root = tempfile.mkdtemp(prefix="beforehand-")
        root = _local_root
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    if _scopes:
        _scopes[-1].append(path)
    return path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark keeps it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders that ``shared_dir`` hands out inside are deleted at the end: write what is to stay elsewhere."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            discard(spark, path)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` written once below the shared folder, and read from there by whatever needs it again."""
    path = shared_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
