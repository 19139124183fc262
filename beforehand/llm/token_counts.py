"""Token counts of whole texts without token ids: pieces are counted once per distinct pre-token.

A merge of a piece vocabulary never crosses a place whose two characters stand side by side in no
piece. Texts are cut at all such places; a text's count is the sum of its pre-tokens' counts. A
corpus has few distinct pre-tokens, so the tokenizer runs on those alone, and documents join
their own frequencies to the counts.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import octets, saved

LIMIT = 4096
SPACE = "▁"  # how such vocabularies write a space
# In front of a pre-token, so that it is read as the inside of a text; stands alone in any text.
BEFORE = "\n"
ROWS = 1 << 16
HELD = 1 << 18
LONG = 1 << 22  # characters cut at once
# At most so many pre-tokens, those in most documents, are sent to all tasks.
COMMON = 1 << 18
# Longer pre-tokens are joined by their digest, so that what is sent has a bound.
LONGEST = 64
STEPS = 8  # classes of frequency for each power of two

_loaded: dict[str, tuple] = {}


def _model(path: str) -> tuple:
    """The processor, a number for each character inside a longer piece (0 for others), and which numbers may stand side by side in one."""
    if path not in _loaded:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        probe = "ﬁ  ① x "
        if model.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("this vocabulary rewrites texts before it cuts them: its counts are not sums over pre-tokens")
        ids = (i for i in range(model.get_piece_size()) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
        pieces = [model.id_to_piece(i) for i in ids]
        if any(BEFORE in p for p in pieces):
            raise ValueError("this vocabulary has pieces that hold a line end")
        pairs = {p[i : i + 2] for p in pieces for i in range(len(p) - 1)}
        letters = sorted({c for p in pairs for c in p})
        number = np.zeros(0x110000, np.int32)
        number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        beside = np.zeros((len(letters) + 1,) * 2, bool)
        for a, b in pairs:
            beside[number[ord(a)], number[ord(b)]] = True
        _loaded[path] = model, number, beside
    return _loaded[path]


def pre_tokens(text: str, path: str) -> Counter:
    """How often a text has each of its pre-tokens; an empty text has none.

    Cut some million characters at a time, what may go on held over, so memory follows the
    distinct pre-tokens and the longest one.
    """
    found: Counter = Counter()
    if not text:
        return found
    _, number, beside = _model(path)
    rest = SPACE
    for at in range(0, len(text), LONG):
        part = rest + text[at : at + LONG].replace(" ", SPACE)
        ids = number[np.frombuffer(part.encode("utf-32-le"), "<u4")]
        cuts = (np.flatnonzero(~beside[ids[:-1], ids[1:]]) + 1).tolist()
        found.update([part[i:j] for i, j in zip([0, *cuts], cuts)])
        rest = part[cuts[-1] :] if cuts else part
    found[rest] += 1
    return found


def piece_counts(tokens: list[str], path: str) -> list[int]:
    """The number of pieces of each pre-token inside a text."""
    model = _model(path)[0]
    own = len(model.encode(BEFORE))
    return [len(ids) - own for ids in model.encode([BEFORE + t for t in tokens], num_threads=1)]


def _key(token: str) -> str:
    """Itself, or a digest; a pre-token of several characters never starts with a line end."""
    return token if len(token) <= LONGEST else BEFORE + hashlib.sha256(token.encode()).hexdigest()


def _key_of(token: Column) -> Column:
    return F.when(F.length(token) > LONGEST, F.concat(F.lit(BEFORE), F.sha2(token, 256))).otherwise(token)


def _batch(columns: list, shape: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, shape)], schema=shape)


def _distinct(path: str):
    """Pre-tokens of a task's documents, and in how many of them each is."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = pa.schema([("token", pa.string()), ("rows", pa.int64())])
        held: Counter = Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                held.update(pre_tokens(text or "", path).keys())
                if len(held) >= HELD:
                    yield _batch([list(held), list(held.values())], shape)
                    held = Counter()
        yield _batch([list(held), list(held.values())], shape)

    return rows


def _counted(path: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = piece_counts(batch.column(0).to_pylist(), path)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(counts, pa.int64())], ["token", "rows", "pieces"])

    return rows


FREQUENCIES = "_row long, doc_id long, n_bytes long, key string, uses long, tokens long"


def _frequencies(path: str, common):
    """A row for each document, with the tokens of its common pre-tokens, and one for each other pre-token of it."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in FREQUENCIES.split(", ")]
        shape = pa.schema([(n, pa.string() if n == "key" else pa.int64()) for n in names])
        known = common.value
        held: list[tuple] = []
        for batch in batches:
            for row, doc_id, n_bytes, text in zip(*(c.to_pylist() for c in batch.columns)):
                tokens = 0
                for token, uses in pre_tokens(text or "", path).items():
                    key = _key(token)
                    pieces = known.get(key)
                    if pieces is None:
                        held.append((row, None, None, key, uses, None))
                    else:
                        tokens += pieces * uses
                held.append((row, doc_id, n_bytes, None, None, tokens))
                if len(held) >= ROWS:
                    yield _batch(list(zip(*held)), shape)
                    held = []
        if held:
            yield _batch(list(zip(*held)), shape)

    return rows


def _least_class(counted: DataFrame, most: int) -> int:
    """The least class of frequency from which on there are at most ``most`` pre-tokens."""
    sizes = counted.groupBy("class").agg(F.count(F.lit(1)).alias("n")).collect()
    least, n = STEPS * 64, 0
    for r in sorted(sizes, key=lambda r: -r["class"]):
        n += r["n"]
        if n > most:
            break
        least = r["class"]
    return least


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every row: its tokens by the piece vocabulary at ``path``.

    ``path``: a model file, on every machine, that leaves texts as they are and puts a space in
    front. A NULL or empty text has no token; strings of control pieces count as ordinary text;
    repeated rows and ids, and a NULL id, are counted row by row. Memory of a task follows the
    distinct pre-tokens of its longest text and its longest pre-token, not the corpus.

    Texts never move. They are read once for the distinct pre-tokens, which are counted one by
    one, and once for the frequencies. At most COMMON pre-tokens of at most LONGEST characters, those in
    most documents, go to all tasks as a table, so no frequent one is a hot key; the others
    meet their counts in a shuffle, and documents their sums in another.
    """
    texts = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col("doc_id").cast("long").alias("doc_id"),
        octets("text").alias("n_bytes"),
        F.col("text").cast("string").alias("text"),
    )
    distinct = texts.select("text").mapInArrow(_distinct(path), "token string, rows long")
    distinct = distinct.groupBy("token").agg(F.sum("rows").alias("rows"))
    counted = distinct.mapInArrow(_counted(path), "token string, rows long, pieces long")
    counted = counted.select(
        _key_of(F.col("token")).alias("key"), "pieces", F.floor(F.log2("rows") * STEPS).cast("int").alias("class")
    )
    counted = saved(counted, "piece-counts")
    often = F.col("class") >= _least_class(counted, COMMON)
    common = {r["key"]: r["pieces"] for r in counted.where(often).select("key", "pieces").collect()}
    common = docs.sparkSession.sparkContext.broadcast(common)

    found = saved(texts.mapInArrow(_frequencies(path, common), FREQUENCIES), "pre-tokens")
    whole = found.where("key IS NULL").select("_row", "doc_id", "n_bytes", "tokens")
    rare = found.where("key IS NOT NULL").join(counted.where(~often), "key")
    rare = rare.select("_row", "doc_id", "n_bytes", (F.col("uses") * F.col("pieces")).alias("tokens"))
    sums = whole.unionByName(rare).groupBy("_row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum("tokens").alias("n_tokens")
    )
    return sums.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
