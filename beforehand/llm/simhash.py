"""SimHash near-duplicates, with candidates pruned by pigeonring chains.

A fingerprint is cut into a ring of ``segments``. If two differ in at most ``k`` bits, then
some segment starts a chain in which, for every length l, the first l segments differ in at
most l * k / segments bits (Qin and Xiao, "Pigeonring", 2018). The lengths for which that
budget is below one bit must agree outright: they are the join key. The longer ones are
checked in turn on each candidate, before the full distance.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import shared_dir
from .common import saved, slices
from .components import components

SEED = 42
BITS = 64
BLOCK = 1 << 16
BUCKET_LIMIT = 512
# Row numbers hold the part above so many bits.
PART_BITS = 33
FOLDER = 64
BROADCAST_ROWS = 4_000_000


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """SimHash of the word shingles of a UTF-8 text, unsigned; A-Z count as a-z.

    Words are split at ASCII white space. Fewer words than ``shingle`` make one shingle, no
    word makes fingerprint 0. Shingles are hashed in blocks, so memory does not follow the text.
    """
    words = text.lower().split()
    if not words:
        return 0
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    if len(words) >= shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    ones, digest = np.zeros(BITS, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(starts), BLOCK):
        spans = zip(starts[at : at + BLOCK].tolist(), ends[at : at + BLOCK].tolist())
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > len(starts)).tolist()))


def _signed(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    for part in slices(batches):
        prints = [fingerprint(t or b"", shingle) for t in part.column(0).to_pylist()]
        values = pa.array(np.array(prints, np.uint64).view(np.int64))
        yield pa.RecordBatch.from_arrays([*part.columns[1:], values], [*part.schema.names[1:], "fp"])


def fingerprints(docs: DataFrame, shingle: int = 3, ids: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The long columns ``ids`` and ``fp`` (64 bits as a long) of every whole text; NULL has no words."""
    texts = docs.select(F.col("text").cast("binary").alias("text"), *[F.col(c).cast("long").alias(c) for c in ids])
    shape = ", ".join(f"{c} long" for c in (*ids, "fp"))
    return texts.mapInArrow(lambda b: _signed(b, shingle), shape)


def _masks(segments: int) -> list[int]:
    cuts = [round(i * BITS / segments) for i in range(segments + 1)]
    return [(1 << hi) - (1 << lo) for lo, hi in zip(cuts, cuts[1:])]


def _lit(bits: int) -> Column:
    return F.lit(bits - (1 << BITS) if bits >> (BITS - 1) else bits).cast("long")


def chains(segments: int, k: int) -> tuple[list[int], list[list[tuple[int, int]]]]:
    """For each start: the bits that must agree, and (bits, budget) of every longer chain."""
    masks = _masks(segments)
    keys, longer = [], []
    for start in range(segments):
        key, own, seen = 0, [], 0
        for n in range(1, segments + 1):
            seen |= masks[(start + n - 1) % segments]
            if n * k < segments:
                key = seen
            else:
                own.append((seen, n * k // segments))
        keys.append(key)
        longer.append(own)
    return keys, longer


def links(prints: DataFrame, k: int, segments: int | None = None, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """``a, b``: pairs of distinct ``fp`` that connect all within ``k`` bits of each other.

    A bucket holds the fingerprints that agree on a chain's key. In buckets of up to
    ``bucket_limit`` every pair is checked, chain by chain. Fuller buckets, which a few very
    common forms of text could make, are handled without pairs: each of their fingerprints is
    put at every value at most k / 2 bits away; those that meet at a value are within k bits,
    and are linked to the least of them. Two within k bits always meet halfway, so nothing is
    lost, and no value gathers more fingerprints than lie around it. Needs an even ``k``.
    """
    if k not in (0, 2, 4):
        raise ValueError("the bit distance must be 0, 2 or 4")
    if k == 0:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    keys, longer = chains(segments or 2 * k + 1, k)
    spots = F.array(
        *[F.struct(F.lit(i).alias("start"), F.col("fp").bitwiseAND(_lit(m)).alias("key")) for i, m in enumerate(keys)]
    )
    spread = prints.select("fp", F.explode(spots).alias("s")).select("fp", "s.start", "s.key")
    sizes = saved(spread.groupBy("start", "key").agg(F.count("*").alias("n")).where("n > 1"), "buckets")
    met = saved(spread.join(sizes, ["start", "key"]), "bucket-rows")

    light = met.where(F.col("n") <= bucket_limit)
    a = light.select("start", "key", F.col("fp").alias("a"))
    b = light.select("start", "key", F.col("fp").alias("b"))
    apart = F.col("a").bitwiseXOR(F.col("b"))
    viable = F.lit(False)
    for start, own in enumerate(longer):
        here = F.col("start") == start
        for bits, budget in own:
            here = here & (F.bit_count(apart.bitwiseAND(_lit(bits))) <= budget)
        viable = viable | here
    pairs = a.join(b, ["start", "key"]).where((F.col("a") < F.col("b")) & viable).select("a", "b")

    heavy = met.where(F.col("n") > bucket_limit).select("fp").distinct()
    one = F.array(*[_lit(0), *[_lit(1 << i) for i in range(BITS)]])
    around = heavy.select("fp", F.explode(F.transform(one, lambda m: F.col("fp").bitwiseXOR(m))).alias("at"))
    if k == 4:
        around = around.select("fp", F.explode(F.transform(one, lambda m: F.col("at").bitwiseXOR(m))).alias("at"))
    stars = around.groupBy("at").agg(F.collect_set("fp").alias("all")).where(F.size("all") > 1)
    stars = stars.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a < b")
    return pairs.unionByName(stars).distinct()


def groups(rows: DataFrame, k: int = 2, segments: int | None = None, bucket_limit: int = BUCKET_LIMIT) -> DataFrame:
    """``rows`` (with ``doc_id, fp``) and ``component_id``: the least doc_id reachable, itself included.

    Equal fingerprints are one node, however many texts have it. A row without doc_id gets its
    group's least known id, or NULL where the group has none. ``rows`` should be a written table.
    """
    nodes = saved(
        rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")), "prints"
    )
    joined = components(links(nodes.select("fp"), k, segments, bucket_limit))
    linked = nodes.join(joined, nodes["fp"] == joined["node"], "left").select(
        "fp", "least", "copies", F.coalesce("component", "fp").alias("component"), F.col("node").isNotNull().alias("tied")
    )
    linked = saved(linked.where("tied or copies > 1"), "linked")
    least = linked.groupBy("component").agg(F.min("least").alias("component_id"))
    names = saved(linked.join(least, "component").select(F.col("fp").alias("_fp"), "component_id"), "names")
    known = F.coalesce(F.col("component_id"), F.when(F.col("_fp").isNull(), F.col("doc_id")))
    out = rows.join(names, rows["fp"] == names["_fp"], "left").withColumn("component_id", known)
    return out.drop("_fp")


def near_duplicates(docs: DataFrame, shingle: int = 3, k: int = 2) -> DataFrame:
    """``doc_id, fingerprint`` (16 hex digits)``, component_id`` of every row of ``docs``.

    NULL, empty and blank texts have fingerprint zero and are linked like any other. Repeated
    rows are returned as often. Other columns are not read.
    """
    rows = groups(saved(fingerprints(docs, shingle), "simhash"), k)
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, shingle: int = 3, k: int = 2, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``docs`` with one row of each group: that of the least doc_id, of equal ones any one.

    Rows are numbered in a written table, so that just one stays whatever ids repeat or lack. Texts do
    not move to drop a few: the table lies in folders of consecutive parts, and each folder is read
    against the numbers of its own dropped rows. Folders are read together as long as those
    number at most ``broadcast_rows``, 16 bytes each; a folder alone holds FOLDER parts' rows.
    """
    whole = F.struct(*docs.columns).alias("_doc")  # as one column, so that no name can clash
    number = F.monotonically_increasing_id()
    rows = docs.select(whole, number.alias("_row"), F.floor(number / (FOLDER << PART_BITS)).cast("int").alias("_folder"))
    path = shared_dir(docs.sparkSession, "numbered")
    rows.write.partitionBy("_folder").parquet(path)
    rows = docs.sparkSession.read.schema(rows.schema).parquet(path)
    prints = fingerprints(rows.select("_row", "_doc.text"), shingle, ("_row",)).withColumnRenamed("_row", "doc_id")
    grouped = groups(saved(prints, "simhash"), k).select(F.col("doc_id").alias("_row"), "component_id")
    ids = rows.select("_row", "_doc.doc_id", "_folder")
    # the smallest of a group stays; groups of one need no comparison, so only rows of the others move
    grouped = saved(grouped.join(ids, "_row"), "grouped")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row"))
    stay = grouped.groupBy("component_id").agg(first.alias("first"), F.count("*").alias("n")).where("n > 1")
    stay = saved(stay.select(F.col("component_id").alias("_group"), F.col("first._row").alias("_first")), "first")
    gone = grouped.join(stay, F.col("component_id").eqNullSafe(F.col("_group"))).where("_row <> _first")
    gone = saved(gone.select(F.col("_row").alias("_gone"), "_folder"), "dropped")
    sizes = {r[0]: r[1] for r in gone.groupBy("_folder").count().collect()}
    folders = sorted(r[0] for r in rows.select("_folder").distinct().collect())
    runs, held = [], 0
    for folder in folders:
        n = sizes.get(folder, 0)
        if not runs or held + n > broadcast_rows:
            runs, held = [*runs, (folder, folder)], 0
        runs[-1], held = (runs[-1][0], folder), held + n
    kept = []
    for low, high in runs:
        here = F.col("_folder").between(low, high)
        own = gone.where(here).select("_gone")
        kept.append(rows.where(here).join(F.broadcast(own), F.col("_row") == F.col("_gone"), "left_anti").select("_doc.*"))
    return reduce(DataFrame.unionByName, kept) if kept else rows.select("_doc.*")
