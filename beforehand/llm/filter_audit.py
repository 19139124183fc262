"""How filters act on each other, by contractions of a contingency tensor.

Every document passes or fails each of five filters, so a part of the corpus is a table of
2 x 2 x 2 x 2 x 2 counts. What a step of a pipeline keeps, removes or finds removed already is a
sum over that table with each axis held to pass, to fail, or left free: one contraction. All
orders of the filters are read from the same 32 counts, whatever the size of the corpus.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved

FILTERS = "ABCDE"
LEAST_WORDS = 200
WHITE = b" \t\n\r\x0b\x0c"
CAPITALS = bytes(range(ord("A"), ord("Z") + 1))
SIGNS = b"#$%&*|"
PIECE = 1 << 20
PARTS = 64
# What a contraction does with an axis: (weight of passing, weight of failing).
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)


def _pieces(text: bytes) -> Iterator[bytes]:
    """The text in pieces of about PIECE bytes, cut at white space, so memory follows distinct words."""
    at = 0
    while at < len(text):
        stop = at + PIECE
        while stop < len(text) and text[stop] not in WHITE:
            stop += 1
        yield text[at:stop]
        at = stop


def failures(text: bytes, n_chars: int) -> int:
    """Bits 0 to 3: the text fails A (few words), B (few distinct ones), C (capitals), D (signs).

    Words are maximal runs without ASCII white space, compared as they are.
    """
    n, distinct = 0, set()
    for piece in _pieces(text):
        words = piece.split()
        n += len(words)
        distinct.update(words)
    capitals = len(text) - len(text.translate(None, CAPITALS))
    signs = len(text) - len(text.translate(None, SIGNS))
    return (n < LEAST_WORDS) | (100 * len(distinct) < 50 * n) << 1 | (100 * capitals > 2 * n_chars) << 2 | (signs > 0) << 3


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        doc_id, part, text = batch.columns
        chars = pc.utf8_length(text).to_pylist()
        own = text.cast(pa.binary()).to_pylist()
        masks = pa.array([failures(t, n) for t, n in zip(own, chars)], pa.int32())
        digests = pa.array([hashlib.sha256(t).digest() for t in own], pa.binary())
        yield pa.RecordBatch.from_arrays([doc_id, part, masks, digests], ["doc_id", "part", "mask", "digest"])


def outcomes(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, good, toxic`` of every document; bit i of the mask: it fails filter i of FILTERS.

    Texts are read once, by tasks that pass on a digest. E compares it with the least doc_id of
    its equals: a document without doc_id neither fails E nor makes another fail, rows that
    repeat one doc_id don't make each other fail. A NULL text is empty. A doc_id labelled twice is
    good, or toxic, if one of its labels says so.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    rows = saved(texts.mapInArrow(_measured, "doc_id long, part string, mask int, digest binary"), "outcomes")
    # written: a plain shuffle on both sides of the join lets a digest that many rows share be split
    first = rows.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    first = saved(first.select(F.col("digest").alias("_digest"), "first"), "first-texts")
    flag = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c)
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("_doc")).agg(flag("quality"), flag("toxic"))
    marks = saved(marks, "marks")
    rows = rows.join(first, rows["digest"] == first["_digest"], "left")
    copies = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    rows = rows.select("doc_id", "part", (F.col("mask") + F.when(copies, 16).otherwise(0)).alias("mask"))
    # rows without doc_id have no label: they need not meet in the join
    joined = rows.where("doc_id IS NOT NULL").join(marks, rows["doc_id"] == marks["_doc"], "left").select(
        "part", "mask", F.coalesce("quality", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")
    )
    unknown = rows.where("doc_id IS NULL").select("part", "mask", F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    return joined.unionByName(unknown)


def selectors() -> tuple[list[tuple[str, int]], dict[str, np.ndarray]]:
    """(order, step) of all 600 steps, and for each contraction an array of (step, axis, pass or fail) weights."""
    steps, kept, removed, failing, alone = [], [], [], [], []
    for order in map("".join, permutations(FILTERS)):
        for step, own in enumerate(order, 1):
            earlier = order[: step - 1]
            steps.append((order, step))
            kept.append([PASS if f in earlier or f == own else ALL for f in FILTERS])
            removed.append([FAIL if f == own else PASS if f in earlier else ALL for f in FILTERS])
            failing.append([FAIL if f == own else ALL for f in FILTERS])
            alone.append([FAIL if f == own else PASS for f in FILTERS])
    named = {"kept": kept, "removed": removed, "failing": failing, "unique_fails": alone}
    return steps, {name: np.array(x, np.int64) for name, x in named.items()}


def contract(tensor: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Counts of each part (rows) at each step (columns): every axis of the tensor weighed by its selector."""
    axes = [weights[:, i] for i in range(len(FILTERS))]
    return np.einsum("pabcde,sa,sb,sc,sd,se->ps", tensor, *axes, optimize=True)


AUDIT = (
    "part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
    "good_lost long, toxic_lost long, shapley long"
)


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    steps, weights = selectors()
    own = np.array([FILTERS.index(order[step - 1]) for order, step in steps])
    same = (own[:, None] == np.arange(len(FILTERS))).astype(np.int64)
    for whole in batches:
        for at in range(0, whole.num_rows, PARTS):
            batch = whole.slice(at, PARTS)
            parts, cells = batch.column(0), batch.column(1).to_pylist()
            counts = np.zeros((3, len(cells), 1 << len(FILTERS)), np.int64)
            for i, row in enumerate(cells):
                for c in row:
                    counts[:, i, c["mask"]] = c["n"], c["good"], c["toxic"]
            # bit 0 is A: the last axis of the reshaped array, so axes are turned round
            shape = (3, len(cells), *[2] * len(FILTERS))
            every, good, toxic = counts.reshape(shape).transpose(0, 1, *range(len(shape) - 1, 1, -1))
            out = {name: contract(every, w) for name, w in weights.items()}
            removed = out["removed"]
            columns = [
                out["kept"], removed, out["failing"] - removed, out["unique_fails"], contract(good, weights["removed"]),
                contract(toxic, weights["removed"]), (removed @ same)[:, own],
            ]
            n = len(steps)
            arrays = [
                pa.DictionaryArray.from_arrays(np.repeat(np.arange(len(cells)), n), parts).cast(pa.string()),
                pa.array([order for order, _ in steps] * len(cells)),
                pa.array(np.tile(np.array([step for _, step in steps], np.int32), len(cells))),
                *[pa.array(np.ascontiguousarray(c).ravel()) for c in columns],
            ]
            yield pa.RecordBatch.from_arrays(arrays, [c.split()[0] for c in AUDIT.split(", ")])


def audit(outcomes: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step: the columns of ``AUDIT``.

    Counts are taken per (part, mask) before they move, so a part that holds a third of all rows
    sends 32 rows a task. A part is then 32 cells; tasks contract some parts at a time. An empty
    table has no part and no row.
    """
    total = lambda c: F.sum(F.col(c).cast("long")).alias(c)
    cells = outcomes.groupBy("part", "mask").agg(F.count("*").alias("n"), total("good"), total("toxic"))
    tensors = cells.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    return tensors.mapInArrow(_audited, AUDIT)
