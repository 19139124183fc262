"""Spelling variants: words one edit apart, found in dense tiles of padded code points.

Two words differ by one inserted, deleted or replaced code point exactly if their common prefix
and common suffix together reach the length of the longer one less one. A tile compares all
its words with each other at once, a code point of the matrix at a time, from the left for prefixes and
from the right for suffixes. Tiles hold words that can match: those that agree outside an interval of positions.
Intervals start as halves of a word and are halved again wherever more words agree than a tile holds.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

# Fixed values of the contract: what a word is, and which are left out.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LOSES = 199
LEAST_LENGTH = 6
LEAST_USES = 5
RATIO = 5

TILE = 512  # words compared with each other at once, and the most that may agree outside an interval
CELLS = 1 << 22  # code points in a tile; long words make tiles of fewer
HELD = 200_000
PIECE = 1 << 22


def _runs(text: str) -> Iterator[list[str]]:
    """The runs of a text, those of PIECE characters at a time; a run is never cut."""
    at = 0
    while at < len(text):
        stop = at + PIECE
        last = RUN.match(text, stop) if stop < len(text) else None
        stop = last.end() if last else stop
        yield RUN.findall(text[at:stop])
        at = stop


def words_of(doc_id: int | None, text: str) -> Counter:
    """A text's lower-cased runs and their counts, where the document's own hash says so less one code point.

    A missing doc_id is written as nothing before the colon.
    """
    found: Counter = Counter()
    for runs in _runs(text):
        found.update(runs)
    lowered: Counter = Counter()
    for run, n in found.items():
        lowered[run.lower() if run.isascii() else run.translate(LOWER)] += n
    start, out = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode()), Counter()
    for run, n in lowered.items():
        h = zlib.crc32(run.encode(), start)
        if h % LOSES == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= LEAST_LENGTH:
            out[run] += n
    return out


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def batch_of(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            held.update(words_of(doc_id, text or ""))
            if len(held) >= HELD:
                yield batch_of(held)
                held = Counter()
    yield batch_of(held)


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word, n``: words of LEAST_LENGTH code points and LEAST_USES occurrences or more in whole texts.

    Tasks send on sums over their documents, so a word in every text is one row a task. A NULL
    text has no words; repeated rows count each time. Memory follows the distinct words of a text.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = texts.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.where(F.col("n") >= LEAST_USES)


def _most(longer: Column) -> Column:
    """How many words of this length a tile holds."""
    return F.greatest(F.lit(2), F.least(F.lit(TILE), F.floor(F.lit(CELLS) / longer))).cast("long")


def _placed(rows: DataFrame, low: Column, high: Column) -> DataFrame:
    """``rows`` at the interval ``low`` to ``high`` of edit places, with the key of what agrees outside it."""
    rows = rows.withColumn("low", low).withColumn("high", high)
    outside = [F.substring("word", F.lit(1), F.col("low")), F.right("word", F.col("longer") - 1 - F.col("high"))]
    return rows.withColumn("key", F.xxhash64("longer", "inserts", "low", "high", *outside))


def tiles(words: DataFrame) -> DataFrame:
    """``key, longer, inserts, low, high, word, n``: rows of one key may be one edit apart, others need not be compared.

    A pair is looked for by the length of its longer word and whether that has one code point more than the other.
    The edit's place is the length of the common prefix, 0 to longer - 1. Outside an interval of places both
    words are alike, so the interval that holds the place brings them together, and no other of its level
    does. Keys with more words than a tile holds are cut into two intervals until few enough agree, or
    the interval is one place: then there are as many as the alphabet has letters.
    """
    length = F.length("word")
    roles = F.array(
        F.struct(length.alias("longer"), F.lit(False).alias("inserts")),
        F.struct(length.alias("longer"), F.lit(True).alias("inserts")),
        F.struct((length + 1).alias("longer"), F.lit(True).alias("inserts")),
    )
    rows = words.select("word", "n", F.explode(roles).alias("r")).select("word", "n", "r.longer", "r.inserts")
    half = F.floor((F.col("longer") - 1) / 2).cast("int")
    rows = rows.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    rows = _placed(
        rows, F.when(F.col("side") == 0, 0).otherwise(half + 1), F.when(F.col("side") == 0, half).otherwise(F.col("longer") - 1)
    )
    rows, done = saved(rows, "intervals"), None
    while True:
        sizes = rows.where("low < high").groupBy("key", "longer").agg(F.count("*").alias("size"))
        full = saved(sizes.where(F.col("size") > _most(F.col("longer"))).select("key").distinct(), "full-keys")
        if full.isEmpty():
            return rows if done is None else done.unionByName(rows)
        fits = rows.join(full, "key", "left_anti")
        done = fits if done is None else done.unionByName(fits)
        middle = F.floor((F.col("low") + F.col("high")) / 2).cast("int")
        over = rows.join(full, "key", "left_semi").drop("key", "side")
        over = over.withColumn("_low", F.col("low")).withColumn("_high", F.col("high")).withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
        cut = _placed(
            over.withColumn("_middle", middle),
            F.when(F.col("side") == 0, F.col("_low")).otherwise(F.col("_middle") + 1),
            F.when(F.col("side") == 0, F.col("_middle")).otherwise(F.col("_high")),
        )
        rows = saved(cut.select(rows.columns), "intervals")


def shared_ends(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each row of ``a`` with each of ``b``, how many leading columns are alike."""
    alive = np.ones((len(a), len(b)), bool)
    out = np.zeros((len(a), len(b)), np.int32)
    for i in range(a.shape[1]):
        alive &= a[:, None, i] == b[None, :, i]
        if not alive.any():
            break
        out += alive
    return out


def _matrices(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points padded on the right, the same from the last one on, and the lengths; padding of no two words is alike."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
    ends = np.cumsum(lengths)
    row = np.repeat(np.arange(len(words)), lengths)
    at = np.arange(len(points)) - np.repeat(ends - lengths, lengths)
    left = np.tile((0x110000 + np.arange(len(words), dtype=np.uint32))[:, None], (1, lengths.max()))
    right = left.copy()
    left[row, at] = points
    right[row, lengths[row] - 1 - at] = points
    return left, right, lengths


def near_in_tile(words: list[str], n: np.ndarray, groups: np.ndarray, longer: np.ndarray, inserts: np.ndarray, low: np.ndarray, high: np.ndarray):
    """(row, near words, largest n of them, the first such row) of the rows of one tile that have a near word.

    Blocks of at most TILE rows are compared, each with itself and with every later one that shares a group with it.
    """
    left, right, lengths = _matrices(words)
    order = np.argsort(np.array(words, object), kind="stable")
    rank = np.empty(len(words), np.int64)
    rank[order] = np.arange(len(words))
    near, best, who = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), np.full(len(words), -1)
    blocks = [np.arange(at, min(at + TILE, len(words))) for at in range(0, len(words), TILE)]
    for i, p in enumerate(blocks):
        for q in blocks[i:]:
            if groups[q[0]] > groups[p[-1]]:
                break
            prefix, suffix = shared_ends(left[p], left[q]), shared_ends(right[p], right[q])
            size = longer[p][:, None]
            both = np.maximum(lengths[p][:, None], lengths[q][None, :])
            apart = np.where(inserts[p], 1, 0)[:, None] == np.abs(lengths[p][:, None] - lengths[q][None, :])
            hit = (groups[p][:, None] == groups[q][None, :]) & (both == size) & apart & (prefix + suffix >= size - 1)
            hit &= (prefix >= low[p][:, None]) & (prefix <= high[p][:, None]) & (prefix < size)
            if q is p:
                hit &= ~np.eye(len(p), dtype=bool)
            for own, other, found in ((p, q, hit), *(((q, p, hit.T),) if q is not p else ())):
                near[own] += found.sum(1)
                for at in np.flatnonzero(found.any(1)):
                    others = other[found[at]]
                    top = others[np.lexsort((rank[others], -n[others]))[0]]
                    row = own[at]
                    if who[row] < 0 or (-n[top], rank[top]) < (-best[row], rank[who[row]]):
                        best[row], who[row] = n[top], top
    rows = np.flatnonzero(near)
    return rows, near[rows], best[rows], who[rows]


NEAR = "word string, n_near long, best_n long, best string"


def _tiled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; a tile takes whole keys as long as it has room."""

    def compared(rows: list[dict]) -> pa.RecordBatch:
        column = lambda c: np.array([r[c] for r in rows])
        keys = [(r["key"], r["longer"], r["inserts"], r["low"], r["high"]) for r in rows]
        groups = np.cumsum([0, *(a != b for a, b in zip(keys, keys[1:]))])
        words = [r["word"] for r in rows]
        at, near, best, who = near_in_tile(words, column("n"), groups, *map(column, ("longer", "inserts", "low", "high")))
        found = [[words[i] for i in at], near, best, [words[i] for i in who]]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(found, (pa.string(), pa.int64(), pa.int64(), pa.string()))], [c.split()[0] for c in NEAR.split(", ")])

    held: list[dict] = []
    group: list[dict] = []
    same = ("key", "longer", "inserts", "low", "high")
    for batch in batches:
        for row in batch.to_pylist():
            if group and any(group[0][c] != row[c] for c in same):
                if len(group) > 1:  # a word alone has nothing near it here
                    most = max(TILE, len(group))
                    if held and (len(held) + len(group) > most or (len(held) + len(group)) * (max(held[-1]["longer"], group[0]["longer"]) + 1) > CELLS):
                        yield compared(held)
                        held = []
                    held += group
                group = []
            group.append(row)
    if len(group) > 1:
        held += group
    if held:
        yield compared(held)


def near_words(words: DataFrame) -> DataFrame:
    """``word, n_near, form_near, near_n``: of words with a near one, how many there are, and the most frequent, ties by code points.

    A tile gives a row for each of its words that has a near one, not for each pair.
    """
    by = ["longer", "inserts", "low", "high", "key", "word"]
    rows = tiles(words).select("key", "longer", "inserts", "low", "high", "word", "n")
    found = rows.repartition("key").sortWithinPartitions(*by).mapInArrow(_tiled, NEAR)
    first = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("word"))).alias("first")
    best = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), first)
    return best.select("word", "n_near", F.col("first.word").alias("form_near"), (-F.col("first.less")).alias("near_n"))


def variants(docs: DataFrame) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of the corpus.

    Words are those of ``vocabulary``; an empty table has none. A form is the most frequent near word
    if it has RATIO times the word's uses. Uses grow RATIO times at each step, so chains of forms end
    after the logarithm of the corpus; each round halves what is left of them and is written.
    """
    words = saved(vocabulary(docs), "words")
    near = saved(near_words(words), "near-words")
    clear = F.col("near_n") >= RATIO * F.col("n")
    rows = words.join(near, "word", "left").select(
        "word",
        F.when(clear, F.col("form_near")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(clear, F.col("near_n")).alias("form_n"),
    )
    rows = saved(rows, "forms")
    jumps = saved(rows.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:
        on = jumps.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
        longer = jumps.join(on, jumps["root"] == on["_word"], "left").select(
            "word", F.coalesce("_root", "root").alias("root"), F.col("_root").isNotNull().alias("moved")
        )
        longer = saved(longer, "roots")
        jumps = longer.select("word", "root")
        if longer.where("moved").isEmpty():
            break
    roots = jumps.select(F.col("word").alias("_word"), F.col("root").alias("_root"))
    out = rows.join(roots, rows["word"] == roots["_word"], "left")
    return out.select("word", "form", F.coalesce("_root", "word").alias("root"), "n", "n_near", "form_n")
