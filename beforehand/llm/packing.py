"""Packing by deficit round-robin: every window holds the sources in their target proportions.

Each source is a queue of tokens, documents in the order of doc_id, of given columns, or as they are stored. A
window has ``length`` tokens, served in grains of ``grain``, one token by default. Window after window, a queue
earns its share of the grains; what is not a whole grain is a deficit that it carries on. What a queue has had
after w windows has a closed form: queues are the leaves of a binary tree, and of the first k grains of a branch
floor(k * share) are its left side's. So any document's place follows from its place in its
queue alone, and deficits cross windows, partitions and machines without any of them waiting
for another.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from fractions import Fraction
from functools import lru_cache
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema
from pyspark.sql.window import Window

from .common import saved, slices

LENGTH = 2048
GRAIN = 1
END_ID = 1
# Fixed value: how the vocabulary's own pre-tokenizer cuts a text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Every blank before a letter, digit or ASCII sign is one of its cuts.
CUT = re.compile(r"(?= [\w!-~])")
# Runs of white space on which that pattern would be out of stack, at a million characters; the
# class is that of the pattern's \s, which lacks some of Python's.
RUN = 100_000
BLANKS = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]{%d,}" % RUN)

# Characters encoded at once.
JOINED = 1 << 20
BLOCK = 20_000

_encoders: dict[str, tuple] = {}


def _letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: itself if it shows, or the next free one."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def _encoder(path: str) -> tuple:
    """The vocabulary of a byte-level BPE file in tiktoken, its special strings and a pattern of them.

    The file's merges come in the order of their ids, which is all that tiktoken asks of a
    vocabulary; it gives the ids of ``tokenizers`` at several times the speed.
    """
    if path not in _encoders:
        import tiktoken

        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        own, added = whole["model"], whole.get("added_tokens") or []
        vocab, letters = own["vocab"], _letters()
        merged = [vocab["".join(m.split(" ") if isinstance(m, str) else m)] for m in own["merges"]]
        if merged != sorted(merged):
            raise ValueError("the merges of this vocabulary are not in the order of its ids")
        if any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in added):
            raise ValueError("this vocabulary has special tokens that take in their surroundings")
        special = {t["content"]: t["id"] for t in added}
        ranks = {bytes(letters[c] for c in token): i for token, i in vocab.items() if token not in special}
        encoding = tiktoken.Encoding("own", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
        longest = sorted(special, key=len, reverse=True)
        found = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if special else None
        _encoders[path] = encoding, special, found
    return _encoders[path]


@lru_cache(1)
def _tokenizer(path: str):
    """The vocabulary in tokenizers, which few texts need."""
    import tokenizers

    return tokenizers.Tokenizer.from_file(path)


def _parts(text: str) -> Iterator[str]:
    """Parts of a text that the pre-tokenizer cuts too: some JOINED characters, and chunks with a long run of blanks alone."""
    at = 0
    while at < len(text):
        later = CUT.search(text, at + JOINED)
        stop = later.start() if later else len(text)
        part = text[at:stop]
        if len(part) >= RUN and BLANKS.search(part):
            yield from ("".join(same) for _, same in groupby(CUT.split(part), lambda c: BLANKS.search(c) is not None))
        else:
            yield part
        at = stop


def _ordinary(text: str, path: str) -> bytes:
    encoding = _encoder(path)[0]

    def ids(part: str) -> list[int]:
        if len(part) >= RUN and BLANKS.search(part):
            return _tokenizer(path).encode(part, add_special_tokens=False).ids
        return encoding.encode_ordinary(part)

    return b"".join([np.array(ids(part), "<u4").tobytes() for part in _parts(text)])


def encode(text: str, path: str) -> np.ndarray:
    """A text's ids, as ``tokenizers`` gives them without added tokens, and END_ID.

    A special string of the vocabulary that stands in the text is its id. Long texts are encoded
    in parts, so memory follows their ids.
    """
    special, found = _encoder(path)[1:]
    if found and found.search(text):
        parts = (special.get(p, p) for p in found.split(text))
        ids = b"".join(p.to_bytes(4, "little") if isinstance(p, int) else _ordinary(p, path) for p in parts if p != "")
    else:
        ids = _ordinary(text, path)
    return np.append(np.frombuffer(ids, "<u4"), np.uint32(END_ID))


def served(path: list, k):
    """Of the first ``k`` grains (a number or an array) of a phase: the queue's own, and those of queues before it."""
    earlier = k * 0
    for turn in path:
        left = k * turn["left"] // turn["total"]
        if turn["right"]:
            earlier, k = earlier + left, k - left
        else:
            k = left
    return k, earlier


def stretches(first: int, last: int, queue: dict, length: int = LENGTH, grain: int = GRAIN) -> tuple[np.ndarray, np.ndarray]:
    """Where the tokens ``first`` to ``last`` of a queue go: starts of stretches, in the queue and in the packed row.

    In a window the grains of a queue lie together, queues in their order. Tokens beyond the last
    whole grain of a queue go to the end, one queue after another. No stretch crosses a sequence.
    """
    per, whole, starts, places = length // grain, queue["grains"], [], []
    for ph in queue["phases"]:
        own, total, path = ph["own"], ph["total"], ph["path"]
        low = max(first // grain, ph["first"]) - ph["first"]
        high = min(-(-last // grain), ph["first"] + own, whole) - ph["first"]
        if low >= high:
            continue

        def window(j: int) -> int:
            w = j * total // (own * per)
            while served(path, min(per * (w + 1), total))[0] <= j:
                w += 1
            while w and served(path, per * w)[0] > j:
                w -= 1
            return w

        windows = range(window(low), window(high - 1) + 1)
        if len(windows) > high - low:  # a queue that most windows get nothing of
            windows = sorted({window(j) for j in range(low, high)})
        exact = object if total.bit_length() * 2 > 62 else np.int64
        k = np.array([per * w for w in windows], exact)
        (mine, before), (later, after) = served(path, k), served(path, np.minimum(k + per, total))
        begin, stop = np.maximum(mine, low), np.minimum(later, high)
        place = (ph["slot"] + k + after - before + begin - mine) * grain
        full = (stop > begin).astype(bool)
        starts.append(((begin + ph["first"]) * grain)[full])
        places.append(place[full])
    if last > whole * grain:
        starts.append(np.array([max(first, whole * grain)]))
        places.append(starts[-1] - whole * grain + queue["tail"])
    at, to = (np.concatenate(x).astype(np.int64) for x in (starts, places))
    # the first may begin within a grain
    at, to = np.concatenate(([first], at[1:])), np.concatenate(([to[0] + first - at[0]], to[1:]))
    sizes = np.diff(at, append=last)
    over = (to % length + sizes - 1) // length  # sequence borders inside a stretch
    row = np.repeat(np.arange(len(at)), over + 1)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(over + 1) - over - 1, over + 1)
    border = np.where(nth > 0, (to[row] // length + nth) * length, to[row])
    return at[row] + border - to[row], border


def cut(first: int, sizes: np.ndarray, queue: dict, length: int = LENGTH, grain: int = GRAIN) -> tuple[np.ndarray, ...]:
    """``document, start, size, place`` of the pieces of documents that follow each other in a queue from ``first`` on."""
    begins = first + np.cumsum(sizes) - sizes
    last = int(begins[-1] + sizes[-1])
    at, to = stretches(first, last, queue, length, grain)
    starts = np.union1d(at, begins)
    i, document = np.searchsorted(at, starts, "right") - 1, np.searchsorted(begins, starts, "right") - 1
    return document, starts - begins[document], np.diff(starts, append=last), to[i] + starts - at[i]


def places(first: int, n: int, queue: dict, length: int = LENGTH, grain: int = GRAIN) -> Iterator[tuple[int, int, int, int]]:
    """``(start, size, sequence, offset)`` of the pieces of the ``n`` tokens that begin at ``first`` in their queue."""
    for _, start, size, place in zip(*(x.tolist() for x in cut(first, np.array([n]), queue, length, grain))):
        yield start, size, place // length, place % length


def _paths(counts: list[int]) -> list[list[dict]]:
    """For each count, its turns from the root of a balanced tree over all of them."""
    if len(counts) == 1:
        return [[]]
    half = len(counts) // 2
    turn = {"left": sum(counts[:half]), "total": sum(counts)}
    return [
        [{"right": right, **turn}, *path]
        for right, side in ((False, counts[:half]), (True, counts[half:]))
        for path in _paths(side)
    ]


def plan(totals: list[tuple], weights: dict | None = None, grain: int = GRAIN) -> list[dict]:
    """How queues with these token totals are served.

    Without weights, in one phase with the shares of the totals: a path of log2 turns a queue. With weights, in one
    phase until the first queue is empty, one with the others until the next is, and so on; those of weight 0
    come last. That is a phase for each weight, so the plan grows with their square: weights are for some
    hundred sources, not for one a domain.
    """
    left = {q: n // grain for q, n in totals}
    out = {q: {"queue": q, "grains": left[q], "phases": []} for q in left}
    first, slot = dict.fromkeys(left, 0), 0
    while any(left.values()):
        live = [q for q in left if left[q] and (weights or {}).get(q, 0) > 0]
        if live:
            share = {q: Fraction(weights[q]) for q in live}
            scarce = min(live, key=lambda q: left[q] / share[q])
            now = {q: int(left[scarce] * share[q] / share[scarce]) for q in live}
            now = {q: n for q, n in now.items() if n}
        else:
            now = {q: n for q, n in left.items() if n}
        total = sum(now.values())
        for (q, own), path in zip(now.items(), _paths(list(now.values()))):
            phase = {"first": first[q], "own": own, "total": total, "slot": slot, "path": path}
            out[q]["phases"].append(phase)
            first[q], left[q] = first[q] + own, left[q] - own
        slot += total
    tail = slot * grain
    for q, n in totals:
        out[q]["tail"] = tail
        tail += n % grain
    return list(out.values())


TURN = pa.struct([("right", pa.bool_()), ("left", pa.int64()), ("total", pa.int64())])
PHASE = pa.struct([*[(n, pa.int64()) for n in ("first", "own", "total", "slot")], ("path", pa.list_(TURN))])
PLAN = pa.schema([("queue", pa.string()), ("grains", pa.int64()), ("phases", pa.list_(PHASE)), ("tail", pa.int64())])


def _planner(weights: dict | None, grain: int):
    def planned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [t for b in batches for t in zip(*(c.to_pylist() for c in b.columns))]
        totals.sort(key=lambda t: (t[0] is not None, t[0]))
        if totals:
            yield pa.RecordBatch.from_pylist(plan(totals, weights, grain), PLAN)

    return planned


STORED = "doc_id long, queue string, part long, start long, n long, ids binary"
PIECES = (
    "doc_id long, source string, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary"
)
_ARROW = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def _shape(spec: str) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in (c.split() for c in spec.split(", "))])


def _more(spec: str, carry: tuple[str, ...]) -> str:
    return ", ".join([spec, *(f"{c} long" for c in carry)])


def _tokenised(path: str, shape: pa.Schema):
    def tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows, held = TaskContext.get().partitionId(), [], 0
        starts: dict[str | None, int] = {}
        for few in slices(batches):
            for doc_id, queue, text, *carried in zip(*(c.to_pylist() for c in few.columns)):
                ids = encode(text or "", path)
                kept = ids.astype("<u2").tobytes() if ids.max() < 1 << 16 else b"\0" + ids.tobytes()
                start = starts.get(queue, 0)
                rows.append((doc_id, queue, part, start, len(ids), kept, *carried))
                starts[queue], held = start + len(ids), held + len(kept)
                if held > 4 << 20:
                    yield _rows(rows, shape)
                    rows, held = [], 0
        if rows:
            yield _rows(rows, shape)

    return tokens


def _rows(rows: list[tuple], shape: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), shape)], schema=shape)


def _placed(length: int, grain: int, with_ids: bool, shape: pa.Schema):
    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            queue, start, n = (batch.column(i).to_pylist() for i in (1, 2, 3))
            kept, plans, carried = batch.column(4), batch.column(5), batch.columns[6:]
            # documents that follow each other in a queue are cut together, by one plan
            ends = [i for i in range(1, len(n)) if queue[i] != queue[i - 1] or start[i] != start[i - 1] + n[i - 1]]
            for low, high in zip([0, *ends], [*ends, len(n)]):
                if low == high:
                    continue
                sizes = np.array(n[low:high], np.int64)
                document, begin, size, place = cut(start[low], sizes, plans[low].as_py(), length, grain)
                for at in range(0, len(size), BLOCK):
                    own, b, s, to = (x[at : at + BLOCK] for x in (document, begin, size, place))
                    parts, last, ids = [], -1, None
                    for d, x, y in zip(own.tolist(), b.tolist(), s.tolist()):
                        if d != last:
                            raw, last = kept[low + d].as_py(), d
                            ids = np.frombuffer(raw, "<u2").astype("<u4") if len(raw) == 2 * n[low + d] else np.frombuffer(raw[1:], "<u4")
                        parts.append(ids[x : x + y].tobytes())
                    rows = pa.array(low + own)
                    columns = [
                        batch.column(0).take(rows), batch.column(1).take(rows), b, s, [zlib.crc32(p) for p in parts],
                        sizes[own], to // length, to % length, parts if with_ids else [None] * len(parts),
                        *(c.take(rows) for c in carried),
                    ]
                    arrays = [c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, shape)]
                    yield pa.RecordBatch.from_arrays(arrays, schema=shape)

    return pieces


def pack(
    docs: DataFrame,
    path: str,
    weights: dict[str, float] | None = None,
    length: int = LENGTH,
    grain: int = GRAIN,
    with_ids: bool = False,
    order: tuple[str, ...] | None = (),
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """The columns of ``PIECES``, and those named in ``carry`` (whole numbers): each document's tokens, cut and
    placed in sequences of ``length``.

    ``path``: a byte-level BPE vocabulary in JSON, on every machine. Every window holds the sources in
    proportion to ``weights``, or, without, to their tokens in the whole corpus, to within some grains; only the
    last sequence is not full. Sources without a weight wait until the others are used up. A NULL
    text is one END_ID, a NULL source a queue of its own; repeated rows are packed as often.
    Queues are in the order of the columns ``order``, then of doc_id; with None as they are stored, which is
    a shuffle's order where ``docs`` were shuffled.

    Texts move once, sorted in ranges of (source, order, doc_id), so a source that holds a third of all
    rows fills as many tasks as it needs; as stored they do not move. Their ids are written with the running
    count of their source in their task; counts of tasks and queues, a few numbers each, complete it. A task holds
    the ids of a batch of texts, so memory follows the longest text.
    """
    if length % grain:
        raise ValueError("the length must be a multiple of the grain")
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("source").cast("string").alias("queue"),
        F.col("text").cast("string").alias("text"),
        *[F.col(c).cast("long").alias(f"_carry{i}") for i, c in enumerate(carry)],
        *[F.col(c).alias(f"_order{i}") for i, c in enumerate(order or ())],
    )
    carried = [f"_carry{i}" for i in range(len(carry))]
    if order is not None:
        texts = texts.withColumn("_hash", F.xxhash64("text")).withColumn("_row", F.monotonically_increasing_id())
        by = ["queue", *[f"_order{i}" for i in range(len(order))], "doc_id", "_hash", "_row"]
        texts = texts.repartitionByRange(*by).sortWithinPartitions(*by)
    kept = _more(STORED, tuple(carried))
    stored = saved(texts.select("doc_id", "queue", "text", *carried).mapInArrow(_tokenised(path, _shape(kept)), kept), "tokens")
    ranges = saved(stored.groupBy("queue", "part").agg(F.sum("n").alias("tokens")), "ranges")
    totals = ranges.groupBy("queue").agg(F.sum("tokens").alias("tokens"))
    # one narrow row a source
    plans = totals.repartition(1).mapInArrow(_planner(weights, grain), from_arrow_schema(PLAN))
    before = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.withColumn("before", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long")))
    plans = plans.select(F.col("queue").alias("_queue"), F.struct("grains", "phases", "tail").alias("plan"))
    ranges = ranges.join(plans, ranges["queue"].eqNullSafe(plans["_queue"]))
    ranges = saved(ranges.select(F.col("queue").alias("_queue"), F.col("part").alias("_part"), "before", "plan"), "plan")
    same = stored["queue"].eqNullSafe(ranges["_queue"]) & (stored["part"] == ranges["_part"])
    rows = stored.join(ranges, same).select(
        "doc_id", "queue", (F.col("before") + F.col("start")).alias("start"), "n", "ids", "plan", *carried
    )
    shape = _more(PIECES, tuple(carried))
    out = rows.mapInArrow(_placed(length, grain, with_ids, _shape(shape)), shape)
    return out.withColumnsRenamed(dict(zip(carried, carry)))


def sequences(pieces: DataFrame, length: int = LENGTH, pad_id: int = 0, carry: tuple[str, ...] = ()) -> DataFrame:
    """``sequence_id, n_tokens, pieces, ids`` from pieces that carry their ids.

    ``ids``: ``length`` little-endian 32-bit ids, the last sequence padded. ``pieces``: in their order, from which
    document each comes (with the columns ``carry``), where it starts in it and in the sequence, and its
    length. A group is one sequence: at most ``length`` pieces.
    """
    fields = ["offset", "doc_id", "source", *carry, "start", "length"]
    parts = F.array_sort(F.collect_list(F.struct(*fields, "ids")))
    rows = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), parts.alias("parts"))
    own = F.transform("parts", lambda p: F.struct(*[p[c].alias(c) for c in fields]))
    pad = F.repeat(F.lit(pad_id.to_bytes(4, "little").hex()), (F.lit(length) - F.col("n_tokens")).cast("int"))
    ids = F.aggregate("parts", F.lit(b""), lambda joined, p: F.concat(joined, p["ids"]))
    return rows.select("sequence_id", "n_tokens", own.alias("pieces"), F.concat(ids, F.unhex(pad)).alias("ids"))
