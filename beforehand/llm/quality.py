"""Quality rules: fixed counts, and a calibrated logistic regression on hashed n-grams."""

from __future__ import annotations

import re
import tempfile
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import slices

BITS = 14
DIMS = 1 << BITS
BLOCK = 1 << 20
SAMPLE_ROWS = 6000
HELD_OUT = 5
EPOCHS = 8
RATE = 0.5
DECAY = 1e-6
THRESHOLD = 0.5
MIN_WORDS = 50
# White space between words, and the characters that count as symbols.
SPACE = " \t\n\v\f\r"
SYMBOLS = "#*$%&|<>"
_SPACES = re.compile(r"[\x20\x09-\x0D]")
_SYMBOLS = re.compile(r"[#*$%&|<>]")

# Bytes of features in a batch.
HELD = 4 << 20


class Model(NamedTuple):
    """Weights of hashed features, and the line that turns a margin into a calibrated log-odds."""

    weights: np.ndarray
    slope: float
    offset: float


def _hashed(codes: np.ndarray, seed: int) -> np.ndarray:
    """Multiply-shift hash of whole numbers to BITS bits."""
    mixed = (codes.astype(np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    return ((mixed * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)).astype(np.int64)


def features(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashed word 1- and 2-grams and character 3- and 4-grams of a UTF-8 text: (numbers, values of length 1).

    A value is the logarithm of one plus the count; A-Z count as a-z. A text is hashed in blocks, so
    memory for its grams does not follow its length.
    """
    low = raw.lower()
    counts = np.zeros(DIMS, np.int64)
    words = np.fromiter(map(zlib.crc32, low.split()), np.uint64)
    for at in range(0, len(words), BLOCK):
        part = words[at : at + BLOCK + 1]
        counts += np.bincount(_hashed(part[:BLOCK], 1), minlength=DIMS)
        counts += np.bincount(_hashed(part[:-1] * np.uint64(31) + part[1:], 2), minlength=DIMS)
    points = np.frombuffer(low.decode("utf-8", "replace").encode("utf-32-le"), "<u4")
    for at in range(0, len(points), BLOCK):
        part = points[at : at + BLOCK + 3].astype(np.uint64)
        # a code point has at most 21 bits
        three = part[:-2] | part[1:-1] << np.uint64(21) | part[2:] << np.uint64(42)
        four = three[:-1] * np.uint64(1_000_003) + part[3:]
        counts += np.bincount(_hashed(three[:BLOCK], 3), minlength=DIMS)
        counts += np.bincount(_hashed(four[:BLOCK], 4), minlength=DIMS)
    held = np.flatnonzero(counts)
    values = np.log1p(counts[held])
    size = np.sqrt((values**2).sum())
    return held, (values / size if size else values).astype(np.float32)


def base_counts(text: str) -> dict[str, int]:
    """The fixed counts of one whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    return {
        "n_words": len(words),
        "word_chars": len(text) - len(_SPACES.findall(text)),
        "n_symbols": len(_SYMBOLS.findall(text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": _repeated(words),
    }


def _repeated(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first included."""
    n = len(words)
    if n < 4:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    _, pair = np.unique(ids[:-1] * len(number) + ids[1:], return_inverse=True)
    _, window, times = np.unique(pair[:-1] * len(number) + ids[2:], return_inverse=True, return_counts=True)
    again = times[window] > 1
    marked = np.zeros(n, bool)
    for k in range(3):
        marked[k : n - 2 + k] |= again
    return int(marked.sum())


def base_failed(counts: dict[str, int]) -> bool:
    return counts["n_words"] < MIN_WORDS or 100 * counts["n_repeat_words"] > 50 * counts["n_words"]


def train(rows: list[tuple[int, np.ndarray, np.ndarray]]) -> Model | None:
    """A model from (label, numbers, values), or None unless both labels occur.

    Every HELD_OUT-th row of a label is kept from the descent, and the margins on those rows
    fix slope and offset (Platt scaling); so do all rows where a label has too few.
    """
    seen = {0: 0, 1: 0}
    fit, held = [], []
    for row in rows:
        seen[row[0]] += 1
        (held if seen[row[0]] % HELD_OUT == 0 else fit).append(row)
    if not (seen[0] and seen[1]):
        return None
    if len({y for y, _, _ in held}) < 2 or len({y for y, _, _ in fit}) < 2:
        fit = held = rows
    weights, squares, bias, bias_square = np.zeros(DIMS), np.full(DIMS, 1e-8), 0.0, 1e-8
    order = np.random.default_rng(0)
    for _ in range(EPOCHS):
        for i in order.permutation(len(fit)):
            y, at, x = fit[i]
            slip = 1 / (1 + np.exp(-np.clip(weights[at] @ x + bias, -30, 30))) - y
            slope = slip * x + DECAY * weights[at]
            squares[at] += slope**2
            weights[at] -= RATE * slope / np.sqrt(squares[at])
            bias_square += slip**2
            bias -= RATE * slip / np.sqrt(bias_square)
    margins = np.array([weights[at] @ x + bias for _, at, x in held])
    labels = np.array([y for y, _, _ in held], float)
    a, b = _platt(margins, labels)
    return Model(weights.astype(np.float32), a, b + a * bias)


def _platt(margins: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the log-odds, by Newton steps on smoothed labels (Platt, 1999)."""
    up, down = labels.sum(), len(labels) - labels.sum()
    aim = np.where(labels > 0, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([margins, np.ones_like(margins)], 1)

    def loss(line: np.ndarray) -> float:
        z = x @ line
        return float((np.logaddexp(0, z) - aim * z).sum())

    line = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ line, -30, 30)))
        slope = x.T @ (p - aim)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), slope)
        while loss(line - step) > loss(line) and np.abs(step).max() > 1e-9:
            step = step / 2
        line = line - step
        if np.abs(step).max() < 1e-9:
            break
    return float(line[0]), float(line[1])


def probability(m: Model, raw: bytes) -> float:
    """Calibrated probability that a text is good."""
    at, x = features(raw)
    z = m.slope * float(m.weights[at] @ x) + m.offset
    return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of ``doc_id, text, quality``, as bytes, in batches of some HELD bytes."""
    shape = pa.schema([("doc_id", pa.int64()), ("quality", pa.int32()), ("at", pa.binary()), ("x", pa.binary())])
    rows, held = [], 0
    for part in slices(batches):
        for doc_id, text, label in zip(*(c.to_pylist() for c in part.columns)):
            at, x = features(text or b"")
            rows.append((doc_id, label, at.astype("<u2").tobytes(), x.astype("<f4").tobytes()))
            held += 6 * len(at)
            if held > HELD:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), shape)], schema=shape)
                rows, held = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), shape)], schema=shape)


def _rows(batches: Iterator[pa.RecordBatch]) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """``(label, numbers, values)`` of what ``_hashes`` gives, in its order.

    The arrays lie in mapped files without a name, which go with the rows: memory does not follow
    the length of the sample's texts.
    """
    labels, sizes = [], []
    with tempfile.TemporaryFile() as numbers, tempfile.TemporaryFile() as values:
        for part in slices(batches):
            for label, at, x in zip(*(c.to_pylist() for c in part.columns[1:])):
                numbers.write(at)
                values.write(x)
                labels.append(label)
                sizes.append(len(at) // 2)
        numbers.flush()
        values.flush()
        # an empty file cannot be mapped
        files = ((numbers, "<u2"), (values, "<f4"))
        at, x = (np.asarray(np.memmap(f, kind, "r")) if sum(sizes) else np.zeros(0, kind) for f, kind in files)
    ends = np.cumsum(sizes).tolist()
    return [(y, at[end - n : end], x[end - n : end]) for y, n, end in zip(labels, sizes, ends)]


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model | None:
    """A model from about ``sample_rows`` labelled rows at most, chosen by a hash of doc_id.

    Rows without a quality of 0 or 1 or without doc_id are left out; a document labelled twice
    counts by its lower label, texts of a repeated doc_id all count. The sample's ids are
    broadcast: their number is bounded. One task fits on the sample, whatever the corpus, from files
    beside it.
    """
    known = labels.where("doc_id is not null and quality in (0, 1)")
    known = known.groupBy("doc_id").agg(F.min("quality").alias("quality"))
    share = 1 << 31
    n = known.count()
    if n > sample_rows:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(share)) < share * sample_rows // n)
    texts = docs.select("doc_id", F.col("text").cast("binary").alias("text")).join(F.broadcast(known), "doc_id")

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = train(_rows(batches))
        if m is not None:
            yield pa.RecordBatch.from_pydict(
                {"weights": [m.weights.astype("<f4").tobytes()], "slope": [m.slope], "offset": [m.offset]}
            )

    texts = texts.select(F.col("doc_id").cast("long"), "text", F.col("quality").cast("int"))
    sample = texts.mapInArrow(_hashes, "doc_id long, quality int, at binary, x binary")
    one = sample.repartition(1).sortWithinPartitions("doc_id", "at", "x")
    row = one.mapInArrow(fitted, "weights binary, slope double, offset double").collect()
    return Model(np.frombuffer(row[0][0], "<f4"), row[0][1], row[0][2]) if row else None


VERDICT = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, quality double"
)


def verdict(text: str | None, m: Model | None, threshold: float = THRESHOLD) -> dict:
    counts = base_counts(text or "")
    failed = base_failed(counts)
    p = None if m is None else probability(m, (text or "").encode("utf-8", "surrogatepass"))
    return {**counts, "base_failed": failed, "kept": not failed and (p is None or p >= threshold), "quality": p}


def verdicts(docs: DataFrame, m: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The columns of ``VERDICT`` for every whole text, scored batch by batch; NULL is an empty text.

    Without a model (no labels of both kinds) the fixed rules decide alone and quality is NULL.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            found = pa.RecordBatch.from_pylist(
                [verdict(t, m, threshold) for t in part.column(1).to_pylist()], _shape()
            )
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *found.columns], ["doc_id", *found.schema.names]
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(judge, VERDICT)


def _shape() -> pa.Schema:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "double": pa.float64()}
    return pa.schema([(n, kinds[t]) for n, t in (c.split() for c in VERDICT.split(", ")[1:])])


def kept(docs: DataFrame, m: Model | None, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that the rules and the model keep, with all their columns."""
    place = docs.columns.index("text")

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            good = [verdict(t, m, threshold)["kept"] for t in part.column(place).to_pylist()]
            yield part.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(choose, docs.schema)
