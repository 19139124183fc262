import itertools
import zlib

import pytest
from pyspark.sql import functions as F

from beforehand.llm import hilbert, queries

from .helpers import clashing, corpus, docs


@pytest.mark.parametrize("n,bits", [(2, 4), (3, 3), (3, 1), (1, 4), (4, 2)])
def test_the_curve_visits_neighbours(spark, n, bits):
    cells = list(itertools.product(range(1 << bits), repeat=n))
    names = [f"c{i}" for i in range(n)]
    df = hilbert.with_curve(spark.createDataFrame(cells, names), names, bits)
    path = [r[:n] for r in sorted(df.collect(), key=lambda r: r["curve"])]
    assert sorted(r["curve"] for r in df.collect()) == list(range(len(cells)))
    assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for x, y in zip(path, path[1:]))


@pytest.mark.parametrize("n", [8, 3, 200])
def test_shards(spark, monkeypatch, n):
    rows = corpus(150)
    rows += rows[:20]
    got = hilbert.shards(clashing(docs(spark, rows)), n).collect()
    sizes = sorted((r[0] or 0, len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert sorted((r.doc_id or 0, r["size"], r.text_crc32) for r in got) == sizes
    counts = [sum(r.shard == s for r in got) for s in range(n)]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(rows)
    for s in range(n):
        own = sorted((r for r in got if r.shard == s), key=lambda r: r.slot)
        assert [r.slot for r in own] == list(range(len(own)))
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in got)


def test_query_columns(spark, monkeypatch):
    monkeypatch.setattr(queries, "table", lambda *_: docs(spark))
    got = queries.op5_hilbert_shards(spark, "")
    assert got.columns[:7] == ["doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"]
    assert {(r.law, r.grown_shard) for r in got.collect()} == {("rows", None)}


def test_equal_texts_of_a_cell_are_neighbours(spark):
    rows = [(i, ["same", f"other {i}"][i % 2], "en", "s", 10) for i in range(40)]
    got = sorted(hilbert.shards(docs(spark, rows), 1).collect(), key=lambda r: r.slot)
    at = [r.slot for r in got if r.doc_id % 2 == 0]
    assert at == list(range(at[0], at[0] + 20))


def test_empty_table_and_all_null(spark):
    assert hilbert.shards(docs(spark, [])).collect() == []
    got = hilbert.shards(docs(spark, [(None, None, None, None, None)] * 5), 2).collect()
    assert sorted(r.shard for r in got) == [0, 0, 0, 1, 1] and {r["size"] for r in got} == {1}


def test_written_runs_prune_on_every_dimension(spark, tmp_path):
    rows = [(i, f"t{i}", ["de", "en", "es", "fr"][i % 4], f"src{i // 4 % 16:02d}", (i * 37) % 1000) for i in range(2000)]
    hilbert.write_shards(docs(spark, rows), str(tmp_path / "s"), 16)
    back = spark.read.parquet(str(tmp_path / "s"))
    assert sorted(r[0] for r in back.select("doc_id").collect()) == list(range(2000))
    for dim in ("source", "n_chars", "lang"):
        spans = back.groupBy("shard").agg(F.min(dim).alias("low"), F.max(dim).alias("high")).collect()
        value = {"source": "src05", "n_chars": 500, "lang": "de"}[dim]
        assert sum(r.low <= value <= r.high for r in spans) <= 12
