"""Merkle trees of texts: sections, their paragraphs, their sentences.

Sections end at blank lines, paragraphs at line feeds, sentences at ``. ! ?`` and white space.
All separators belong to the leaf before them, so equal roots mean equal texts, and the
branches that differ say where an edit is.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved

# what ends a branch of each kind
SECTION = re.compile(r"\n[^\S\n]*\n\s*")
PARAGRAPH = re.compile(r"\n")
# not tried again from within a run, so that a run of any length is passed once
SENTENCE = re.compile(r"(?<![.!?])[.!?]+\s+")
WORD = re.compile(r"\s*\S+\s*|\s+")


class Node(NamedTuple):
    """A branch: its hash, its place in code points, and what lies below (or, of a leaf, its words)."""

    hash: bytes
    start: int
    end: int
    below: tuple


def _hash(kind: bytes, data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16, person=kind).digest()


def _branch(kind: bytes, below: list[Node], at: int) -> Node:
    end = below[-1].end if below else at
    return Node(_hash(kind, b"".join(n.hash for n in below)), at, end, tuple(below))


def _pieces(text: str, end: re.Pattern) -> list[str]:
    cuts = [0, *(m.end() for m in end.finditer(text)), len(text)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:]) if a < b]


def _leaf(text: str, at: int) -> Node:
    return Node(_hash(b"leaf", text.encode("utf-8", "surrogatepass")), at, at + len(text), (text,))


def _paragraph(text: str, at: int) -> Node:
    below, here = [], at
    for piece in _pieces(text, SENTENCE):
        below.append(_leaf(piece, here))
        here += len(piece)
    return _branch(b"paragraph", below, at)


def _section(text: str, at: int) -> Node:
    below, here = [], at
    for piece in _pieces(text, PARAGRAPH):
        below.append(_paragraph(piece, here))
        here += len(piece)
    return _branch(b"section", below, at)


def tree(text: str | None) -> Node:
    """The tree of a whole text; NULL and empty texts have the same, with no section."""
    below, here = [], 0
    for piece in _pieces(text or "", SECTION):
        below.append(_section(piece, here))
        here += len(piece)
    return _branch(b"text", below, 0)


def _unmatched(a: list[Node], b: list[Node]) -> tuple[int, list[Node], list[Node]]:
    """Code points in branches of equal hash, and the branches of either side left over."""
    both = Counter(n.hash for n in a) & Counter(n.hash for n in b)
    size, rest = 0, []
    for side in (a, b):
        open_, left = both.copy(), []
        for n in side:
            if open_[n.hash] > 0:
                open_[n.hash] -= 1
                size += (n.end - n.start) if side is a else 0
            else:
                left.append(n)
        rest.append(left)
    return size, *rest


def compare(a: Node, b: Node) -> tuple[float, list[tuple[int, int]]]:
    """Likeness from 0 to 1, and the places in ``a`` of leaves that ``b`` lacks.

    Branches of equal hash are matched and not opened; what is below the others is matched in
    turn, down to sentences. Of the first and the last sentence that differ, the words equal
    from the outer end count too. The likeness is twice the matched size over both sizes.
    """
    if a.hash == b.hash:
        return 1.0, []
    if a.end == 0 or b.end == 0:
        return 0.0, [(0, a.end)] if a.end else []
    same, left, right = 0, [a], [b]
    for _ in range(3):
        size, left, right = _unmatched(
            [n for x in left for n in x.below], [n for x in right for n in x.below]
        )
        same += size
    if left and right:
        same += _shared_ends(left, right)
    spans: list[tuple[int, int]] = []
    for n in left:
        if spans and spans[-1][1] == n.start:
            spans[-1] = (spans[-1][0], n.end)
        else:
            spans.append((n.start, n.end))
    return min(1.0, 2 * same / (a.end + b.end)), spans


def _shared_ends(left: list[Node], right: list[Node]) -> int:
    def run(a: list[str], b: list[str]) -> int:
        n = 0
        for x, y in zip(a, b):
            if x != y:
                break
            n += len(x)
        return n

    front = run(*(WORD.findall(side[0].below[0]) for side in (left, right)))
    back = run(*(WORD.findall(side[-1].below[0])[::-1] for side in (left, right)))
    return min(front + back, *(sum(n.end - n.start for n in side) for side in (left, right)))


def edited(text: str, following: str) -> str:
    """``text`` whose last half is replaced by as much from the front of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


ROW = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, edit_start long"
)
_ARROW = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}


def _schema(spec: str) -> pa.Schema:
    return pa.schema([(n, _ARROW[t]) for n, t in (c.split() for c in spec.split(", "))])


def _row(doc_id, text: str, own: Node, next_text: str, next_: Node) -> dict:
    other = edited(text, next_text)
    changed = tree(other)
    near, spans = compare(own, changed)
    return {
        "doc_id": doc_id,
        "n_chars": len(text),
        "edited_sha256": hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(),
        "fingerprint": own.hash.hex(),
        "edited_fingerprint": changed.hash.hex(),
        "near_edited": near,
        "near_next": compare(own, next_)[0],
        "edit_start": spans[0][0] if spans else None,
    }


_WALK = f"{ROW}, kind string, part long, text string"


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of a sorted range, each with the next; the range's first and last row come out as they are."""
    shape, part, last, out = _schema(_WALK), TaskContext.get().partitionId(), None, []
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            now = (doc_id, text or "", tree(text))
            if last is None:
                out.append({"doc_id": doc_id, "kind": "first", "part": part, "text": now[1]})
            else:
                out.append({**_row(*last, now[1], now[2]), "kind": "row"})
            last = now
            if len(out) >= 2048:
                yield pa.RecordBatch.from_pylist(out, shape)
                out = []
    if last is not None:
        out.append({"doc_id": last[0], "kind": "last", "part": part, "text": last[1]})
        yield pa.RecordBatch.from_pylist(out, shape)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(c.to_pylist() for c in batch.columns))
        yield pa.RecordBatch.from_pylist([_row(i, t, tree(t), n, tree(n)) for i, t, n in rows], _schema(ROW))


def next_edits(docs: DataFrame) -> DataFrame:
    """Every text's tree against its edited text's and the next document's (see ``ROW``).

    The order is doc_id, NULL first, then a hash of the text; after the last row comes the first. NULL is an
    empty text. One range shuffle brings neighbours together, and rows without or with the same
    doc_id fill as many ranges as they need; a range's last row meets the
    first of the next range in a join of two rows a range. A tree has a node a sentence: memory of
    a task follows its longest text and that text's sentences, a few times its size.
    """
    by = ["doc_id", "_hash", "_number"]
    ordered = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    ordered = ordered.withColumns({"_hash": F.xxhash64("text"), "_number": F.monotonically_increasing_id()})
    ordered = ordered.repartitionByRange(*by).sortWithinPartitions(*by).select("doc_id", "text")
    walked = saved(ordered.mapInArrow(_walk, _WALK), "walk")
    names = [c.split()[0] for c in ROW.split(", ")]
    first = walked.where("kind = 'first'").select(F.col("part").alias("next"), F.col("text").alias("next_text"))
    last = walked.where("kind = 'last'").select("part", "doc_id", "text")
    # one narrow row for each range
    whole = Window.orderBy("next")
    around = whole.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = F.coalesce(F.lag("next").over(whole), F.max("next").over(around))
    follow = first.select("next").withColumn("part", before)
    seams = last.join(follow, "part").join(first, "next").select("doc_id", "text", "next_text")
    return walked.where("kind = 'row'").select(*names).unionByName(seams.mapInArrow(_pairs, ROW))
