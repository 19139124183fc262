"""Sources mixed to target weights by Poisson replication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import octets, saved

SMOOTHING = 0.7
SPREAD = 12.0


def rates(docs: DataFrame, weights: DataFrame | None = None, size_ratio: float = 1.0, smoothing: float = SMOOTHING) -> DataFrame:
    """``source, bytes, rate``: how often each document of a source should come on average.

    The output should hold ``size_ratio`` times the input's bytes, and sources in the proportions of
    ``weights`` (``source, weight``; those not listed get nothing). Without weights a source's is its
    bytes to the power ``smoothing``, which lifts small sources. A text counts its UTF-8 bytes
    and one for its end. NULL is a source like any other.
    """
    sums = docs.groupBy("source").agg(F.sum(octets("text") + 1).alias("bytes"))
    if weights is None:
        sums = sums.withColumn("weight", F.pow("bytes", F.lit(float(smoothing))))
    else:
        given = weights.groupBy(F.col("source").alias("_source")).agg(F.sum(F.greatest("weight", F.lit(0.0))).alias("weight"))
        sums = sums.join(given, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    sums = saved(sums.select("source", "bytes", F.coalesce("weight", F.lit(0.0)).cast("double").alias("weight")), "sources")
    all_ = sums.agg(F.sum("weight").alias("w"), F.sum("bytes").alias("b")).first()
    if not all_["w"]:
        return sums.select("source", "bytes", F.lit(0.0).alias("rate"))
    rate = F.col("weight") / all_["w"] * (all_["b"] * size_ratio) / F.col("bytes")
    return sums.select("source", "bytes", rate.alias("rate"))


def _log_factorial(k: Column) -> Column:
    """Exact below 21, Stirling's series from there."""
    n = k.cast("double")
    series = n * F.log(n) - n + F.log(n * F.lit(6.283185307179586)) / 2 + 1 / (12 * n) - 1 / (360 * n * n * n)
    return F.when(k <= 20, F.log(F.factorial(F.least(k, F.lit(20)).cast("int")).cast("double"))).otherwise(series)


def inverses(rated: DataFrame) -> DataFrame:
    """``rated`` and ``least, steps``: the Poisson distribution function of each rate as an array.

    A uniform number lies above as many steps as its count exceeds ``least``. Counts further than
    12 standard deviations from the rate weigh less than a double shows, and are left out: the
    array grows with the square root of a rate.
    """
    some = rated.where("rate > 0")
    reach = SPREAD * F.sqrt("rate") + 20
    low, high = F.greatest(F.lit(0), F.floor(F.col("rate") - reach)), F.ceil(F.col("rate") + reach)
    k = some.select("source", "rate", F.explode(F.sequence(low.cast("long"), high.cast("long"))).alias("k"))
    weight = F.exp(-F.col("rate") + F.col("k") * F.log("rate") - _log_factorial(F.col("k")))
    upto = Window.partitionBy("source").orderBy("k")
    k = k.select("source", "k", F.sum(weight).over(upto).alias("p"))
    steps = k.groupBy(F.col("source").alias("_source")).agg(
        F.min("k").alias("least"), F.array_sort(F.collect_list("p")).alias("steps")
    )
    joined = rated.join(steps, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")
    return saved(joined, "poisson")


def _number(seed: str, *parts: Column) -> Column:
    """52 bits of a hash of the seed and ``parts``, the same on every engine that has MD5."""
    digest = F.md5(F.concat_ws("|", F.lit(seed), *[p.cast("string") for p in parts]).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("long")


def replicate(
    docs: DataFrame,
    weights: DataFrame | None = None,
    size_ratio: float = 1.0,
    smoothing: float = SMOOTHING,
    seed: str = "mix",
    keep: tuple[str, ...] | None = None,
    draws: bool = True,
) -> DataFrame:
    """The columns ``keep`` (all by default) of each document as often as its draw says, and, with
    ``draws``, ``rate, copies, copy`` (from 1)``, shuffle_key``; rows in the order of shuffle_key.

    A document's uniform number is a hash of the seed and its doc_id (without one, of its text),
    so a run can be repeated and a lost task draws the same. Documents drawn zero times go.
    Rates join as a small written table; a source that holds a third of all rows is split by
    the adaptive join where that table is too large to broadcast. Copies are made before the
    one shuffle, which sorts all rows by a hash of seed, document and copy.
    """
    drawn = inverses(rates(docs.select("source", "text"), weights, size_ratio, smoothing))
    drawn = drawn.where("rate > 0").select(F.col("source").alias("_source"), "rate", "least", "steps")
    name = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    # the documents' columns as one, so that no name of theirs can clash
    whole = F.struct(*(keep or docs.columns)).alias("_doc")
    rows = docs.select(whole, F.col("source").alias("_of"), F.col("doc_id").alias("_id"), name.alias("_name"))
    rows = rows.withColumn("_u", (_number(seed, F.col("_name")) + 0.5) / float(1 << 52))
    rows = rows.join(drawn, rows["_of"].eqNullSafe(drawn["_source"]))
    copies = F.col("least") + F.size(F.filter("steps", lambda p: p <= F.col("_u")))
    rows = rows.withColumn("copies", copies.cast("long")).where("copies > 0")
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    rows = rows.withColumn("shuffle_key", _number(seed + "-order", F.col("_name"), F.col("copy")))
    rows = rows.orderBy("shuffle_key", "_id", "copy")
    return rows.select("_doc.*", *(("rate", "copies", "copy", "shuffle_key") if draws else ()))
