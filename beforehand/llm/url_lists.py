"""Dated URL lists: each entry holds until its key's next, each capture is judged as of its fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
DAY = 86_400_000_000


def host_of(url: str) -> Column:
    """Lower-case host of a URL; NULL where there is none."""
    host = F.lower(F.regexp_extract(url, HOST, 1))
    return F.when(host != "", host)


def keys_of(url: str) -> Column:
    """All list keys a URL can match: ``h:`` its host, ``d:`` the host and each parent domain of two
    labels or more, ``p:`` the host with each prefix of whole path segments."""
    host = host_of(url)
    labels = F.split(host, r"\.")
    n = F.size(labels)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))),
        lambda i: F.concat(F.lit("d:"), F.array_join(F.slice(labels, i, n), ".")),
    )
    segments = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda s: s != "")
    depth = F.size(segments)
    prefixes = F.transform(
        F.sequence(F.lit(1), F.greatest(depth, F.lit(1))),
        lambda i: F.concat(F.lit("p:"), host, F.lit("/"), F.array_join(F.slice(segments, F.lit(1), i), "/")),
    )
    none = F.array().cast("array<string>")
    return F.when(
        host.isNotNull(),
        F.concat(F.array(F.concat(F.lit("h:"), host)), suffixes, F.when(depth > 0, prefixes).otherwise(none)),
    ).otherwise(none)


def states(changes: DataFrame, probes: DataFrame) -> DataFrame:
    """``url, fetched_at, key, since`` of the probes (``url, fetched_at, key``) whose key is listed at their time.

    ``changes``: ``key, at`` (microseconds)``, active``. A change holds until the next of its key; of
    several at once, a listing wins. Changes and probes are sorted together in ranges of (key, time),
    so a key fills as many slices as its rows need; the last change of a slice's key is carried on, one
    row a slice and key. Each probe takes the last change before it, and no pairs are made.
    """
    at_once = changes.where(F.col("key").isNotNull() & F.col("at").isNotNull())
    at_once = at_once.groupBy("key", "at").agg(F.max("active").alias("active"))
    # a change comes before the probes of its time
    rows = at_once.select("key", "at", F.lit(0).alias("turn"), F.lit("").alias("url"), "active").unionByName(
        probes.select("key", F.col("fetched_at").alias("at"), F.lit(1).alias("turn"), "url", F.lit(None).cast("boolean").alias("active"))
    )
    rows = rows.repartitionByRange("key", "at", "turn", "url").withColumn("_slice", F.spark_partition_id())
    rows = saved(rows, "slices")
    change = F.when(F.col("turn") == 0, F.struct("at", "active"))
    ends = rows.groupBy("key", "_slice").agg(F.max(change).alias("last"))
    earlier = Window.partitionBy("key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("open", F.last("last", ignorenulls=True).over(earlier))
    inside = Window.partitionBy("key", "_slice").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("last", F.last(change, ignorenulls=True).over(inside)).where("turn = 1")
    rows = rows.join(ends.where("open is not null").select("key", "_slice", "open"), ["key", "_slice"], "left")
    state = F.coalesce("last", "open")
    return rows.where(state["active"]).select("url", F.col("at").alias("fetched_at"), "key", state["at"].alias("since"))


def judge(captures: DataFrame, changes: DataFrame) -> DataFrame:
    """``captures`` (``page_id, url, fetched_at`` in microseconds) and ``host, n_active, blocked, rule, valid_from``.

    ``rule`` is the longest active key (ties: the last in order) and ``valid_from`` its listing.
    A capture without URL, host or time matches nothing; repeated rows are returned as often.
    Work is done once for each distinct URL and time, and only for keys that were ever listed.
    """
    captures = captures.select("page_id", "url", "fetched_at")
    probes = captures.where("url is not null and fetched_at is not null").select("url", "fetched_at").distinct()
    probes = probes.select("url", "fetched_at", F.explode(keys_of("url")).alias("key"))
    listed = saved(changes.select("key").where("key is not null").distinct(), "listed")
    hits = states(changes, probes.join(listed, "key"))
    best = F.max(F.struct(F.length("key").alias("n"), "key", "since"))
    found = hits.groupBy(F.col("url").alias("_url"), F.col("fetched_at").alias("_at")).agg(
        F.count("*").alias("n_active"), best.alias("best")
    )
    same = (F.col("url") == F.col("_url")) & (F.col("fetched_at") == F.col("_at"))
    return captures.join(saved(found, "hits"), same, "left").select(
        "page_id",
        "url",
        "fetched_at",
        host_of("url").alias("host"),
        F.coalesce("n_active", F.lit(0)).alias("n_active"),
        F.col("n_active").isNotNull().alias("blocked"),
        F.col("best.key").alias("rule"),
        F.col("best.since").alias("valid_from"),
    )
