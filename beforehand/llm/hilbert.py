"""Shards cut from a Hilbert curve over several metadata columns."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import octets, ranked

BITS = 4


def with_curve(df: DataFrame, cells: list[str], bits: int, name: str = "curve") -> DataFrame:
    """``df`` and the place on the Hilbert curve of the cell whose coordinates are columns ``cells``.

    Coordinates are below 2 ** bits. J. Skilling, "Programming the Hilbert curve" (2004): inverse
    undo as one fold over (bit, axis), Gray code, then the bits of all axes in turn.
    """
    n, highest = len(cells), range(bits - 1, 0, -1)
    axes = F.array(*[F.col(c).cast("long") for c in cells])
    if bits > 1:
        steps = [(1 << b, i) for b in highest for i in range(n)]
        todo = F.array(*[F.struct(F.lit(q).cast("long").alias("q"), F.lit(i).alias("i")) for q, i in steps])
        axes = F.aggregate(todo, axes, _undo)
    df = df.withColumn("_axes", axes)
    # Gray code: each axis takes the exclusive or of those before it
    gray = F.aggregate(
        F.slice("_axes", 2, n),
        F.slice("_axes", 1, 1),
        lambda done, x: F.concat(done, F.array(x.bitwiseXOR(F.element_at(done, -1)))),
    )
    df = df.withColumn("_gray", gray)
    flips, last = F.lit(0).cast("long"), F.element_at("_gray", -1)
    for b in highest:
        flips = flips.bitwiseXOR(F.when(last.bitwiseAND(F.lit(1 << b)) != 0, (1 << b) - 1).otherwise(0))
    df = df.withColumn("_flips", flips)
    out = F.lit(0).cast("long")
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            axis = F.element_at("_gray", i + 1).bitwiseXOR(F.col("_flips"))
            out = out * 2 + F.shiftright(axis, b).bitwiseAND(F.lit(1))
    return df.withColumn(name, out).drop("_axes", "_gray", "_flips")


def _undo(axes: Column, step: Column) -> Column:
    """One step: invert the low bits of the first axis, or swap them with those of axis i."""
    low = step["q"] - 1
    first, own = F.element_at(axes, 1), F.element_at(axes, step["i"] + 1)
    swap = first.bitwiseXOR(own).bitwiseAND(low)
    is_set = own.bitwiseAND(step["q"]) != 0
    return F.transform(
        axes,
        lambda x, j: F.when((j == 0) & is_set, x.bitwiseXOR(low))
        .when(~is_set & ((j == 0) | (j == step["i"])), x.bitwiseXOR(swap))
        .otherwise(x),
    )


def _codes(df: DataFrame, dims: list[str]) -> dict[str, Column]:
    """A number for each dimension that keeps its order.

    A text becomes the seven bytes after what all texts of the column share.
    """
    texts = [c for c, kind in df.dtypes if c in dims and kind == "string"]
    row = df.agg(*[f(c).alias(f"{e}{i}") for i, c in enumerate(texts) for e, f in (("low", F.min), ("high", F.max))]).first() if texts else ()
    out = {}
    for c in dims:
        if c not in texts:
            out[c] = F.col(c).cast("double")
            continue
        low, high = ((v or "").encode() for v in row[2 * texts.index(c) : 2 * texts.index(c) + 2])
        shared = len(os.path.commonprefix([low, high]))
        head = F.rpad(F.hex(F.substring(F.col(c).cast("binary"), shared + 1, 7)), 14, "0")
        out[c] = F.conv(head, 16, 10).cast("double")
    return out


def quantised(df: DataFrame, dims: list[str], bits: int = BITS) -> list[Column]:
    """For each dimension the number of its cuts at or below a row; cuts are quantiles, NULL is 0.

    Two passes over the dimensions alone; the driver gets 2 ** bits - 1 numbers a dimension.
    """
    codes = _codes(df, dims)
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = df.agg(
        *[F.percentile_approx(codes[c], F.array(*map(F.lit, shares)), F.lit(10_000)).alias(f"c{i}") for i, c in enumerate(dims)]
    ).first()
    cells = []
    for i, c in enumerate(dims):
        cell = F.lit(0)
        for cut in cuts[f"c{i}"] or []:
            cell = cell + F.when(codes[c] >= cut, 1).otherwise(0)
        cells.append(cell)
    return cells


def shards(
    docs: DataFrame, n_shards: int = 8, dims: tuple[str, ...] = ("source", "n_chars", "lang"), bits: int = BITS
) -> DataFrame:
    """``doc_id, size, text_crc32, curve, shard, slot``: runs of the curve, counts at most one apart.

    Rows are ordered by curve index, then by the text's CRC, so equal texts of a cell are
    neighbours, then by doc_id, and cut into ``n_shards`` runs; ``slot`` counts from 0 in each.
    A cell that holds a third of all rows is cut like any other. Only narrow rows are moved.
    NULL metadata falls into the lowest cell, a NULL text is empty.
    """
    cells = quantised(docs, list(dims), bits)
    names = [f"_cell{i}" for i in range(len(cells))]
    rows = docs.select(
        "doc_id",
        (octets("text") + 1).alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        *[c.alias(n) for c, n in zip(cells, names)],
    )
    rows = with_curve(rows, names, bits).drop(*names)
    rows, total = ranked(rows, ["curve", "text_crc32", "size", "doc_id"], "curve")
    # whole numbers: shard s holds the ranks from ceil(s * total / n) on
    shard = F.expr(f"cast((rank * {n_shards}) div {max(total, 1)} as int)")
    first = F.expr(f"(shard * {total}L + {n_shards - 1}) div {n_shards}")
    return rows.withColumn("shard", shard).withColumn("slot", F.col("rank") - first).drop("rank")


def write_shards(docs: DataFrame, path: str, n_shards: int = 8, **how) -> None:
    """``docs`` as Parquet, a folder ``shard=`` for each run, rows in the order of the curve.

    The minimum and maximum of each dimension in a file's footer then let readers skip files
    on any of them.
    """
    placed = shards(docs, n_shards, **how).select("doc_id", "text_crc32", "shard", "slot")
    keyed = docs.withColumn("_crc", F.crc32(F.coalesce("text", F.lit("")).cast("binary")))
    placed = placed.groupBy(F.col("doc_id").alias("_id"), F.col("text_crc32").alias("_crc")).agg(
        F.min(F.struct("shard", "slot")).alias("at")
    )
    same = keyed["doc_id"].eqNullSafe(placed["_id"]) & (keyed["_crc"] == placed["_crc"])
    rows = keyed.join(placed, same).select(docs["*"], "at.shard", F.col("at.slot").alias("_slot"))
    rows = rows.repartitionByRange("shard", "_slot").sortWithinPartitions("shard", "_slot").drop("_slot")
    rows.write.partitionBy("shard").parquet(path)
