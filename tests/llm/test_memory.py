"""What Python functions hold of a batch follows some rows of it, and the fit's sample is not held at all."""

import tracemalloc

import numpy as np
import pyarrow as pa

from beforehand.llm import common, packing, queries, quality, simhash

ROWS, MB = 600, 1_000_000


def batch():
    """12 MB of texts."""
    texts = [f"row {i} " + "a few words that come again and again " * 525 for i in range(ROWS)]
    return pa.RecordBatch.from_pydict({"doc_id": list(range(ROWS)), "text": texts, "source": ["one"] * ROWS})


class Caught:
    """Stands for a DataFrame and keeps the function that is mapped over it."""

    columns, schema = ["doc_id", "text", "source"], None

    def select(self, *columns):
        return self

    def mapInArrow(self, function, schema):
        self.function = function


def held(rows):
    """MB that Python holds at most while rows are made, and how many are made."""
    tracemalloc.start()
    n = sum(len(b) for b in rows)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return peak / MB, n


def test_slices_are_the_batch():
    whole = batch()
    parts = list(common.slices(iter([whole, whole.slice(0, 0), whole.slice(5, 2)])))
    assert pa.Table.from_batches(parts).to_pydict() == pa.Table.from_batches([whole, whole.slice(5, 2)]).to_pydict()
    assert len(parts) > 5 and max(p.nbytes for p in parts) < 3 * MB
    wide = pa.RecordBatch.from_pydict({"text": ["x" * 5 * MB] * 2})
    assert [len(p) for p in common.slices(iter([wide]))] == [1, 1]
    narrow = pa.RecordBatch.from_pydict({"text": [None] * 2500})
    assert sum(len(p) for p in common.slices(iter([narrow]))) == 2500


def test_texts_of_a_batch_are_not_held_together(spark, monkeypatch):
    whole, df = batch(), Caught()
    quality.kept(df, None)
    assert (peak := held(df.function(iter([whole])))[0]) < 8, peak
    texts = pa.RecordBatch.from_arrays([whole["text"].cast(pa.binary()), whole["doc_id"]], ["text", "doc_id"])
    peak, n = held(simhash._signed(iter([texts]), 3))
    assert peak < 8 and n == ROWS, peak
    packing.encode("once", queries.vocabulary())
    monkeypatch.setattr(packing, "TaskContext", type("C", (), {"get": classmethod(lambda c: c), "partitionId": lambda: 0}))
    docs = pa.RecordBatch.from_arrays([whole["doc_id"], whole["source"], whole["text"]], ["doc_id", "queue", "text"])
    peak, n = held(packing._tokenised(queries.vocabulary(), packing._shape(packing.STORED))(iter([docs])))
    assert peak < 10 and n == ROWS, peak


def test_the_sample_is_read_in_order_and_not_held():
    draw = np.random.default_rng(3)
    texts = ["", None, *(" ".join(map(str, draw.integers(0, 10**9, 150))) for _ in range(1500))]
    raw = [None if t is None else t.encode() for t in texts]
    rows = pa.RecordBatch.from_arrays(
        [pa.array(range(len(raw)), pa.int64()), pa.array(raw, pa.binary()), pa.array([i % 2 for i in range(len(raw))], pa.int32())],
        ["doc_id", "text", "quality"],
    )
    hashed = list(quality._hashes(iter([rows])))
    size = sum(b.nbytes for b in hashed) / MB
    assert len(hashed) > 1 and size > 10
    tracemalloc.start()
    got = quality._rows(iter([pa.Table.from_batches(hashed).combine_chunks().to_batches()[0]]))
    peak = tracemalloc.get_traced_memory()[1] / MB
    tracemalloc.stop()
    assert peak < size / 2, (peak, size)
    assert len(got) == len(raw)
    for i, (label, at, x) in enumerate(got):
        numbers, values = quality.features(raw[i] or b"")
        assert label == i % 2 and np.array_equal(at, numbers) and np.array_equal(x, values)
    assert [(y, len(at), len(x)) for y, at, x in quality._rows(iter([hashed[0].slice(0, 2)]))] == [(0, 0, 0), (1, 0, 0)]
    assert quality._rows(iter([])) == []
