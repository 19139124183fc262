import gzip
import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from beforehand.llm import queries, warc
from beforehand.session import shared_dir

from .helpers import clashing

PAGES = "page_id long, url string, html string"


def pages(spark, rows):
    return spark.createDataFrame(rows, PAGES)


def run(spark, df, monkeypatch):
    monkeypatch.setattr(queries, "table", lambda *_: df)
    return sorted(map(tuple, queries.op1_warc_members(spark, "").collect()), key=lambda r: (r[0] is not None, r))


def brute(rows):
    best = {}
    for i, _, html in rows:
        if html and len(html.encode()) >= 1000:
            best[html] = max(best.get(html, i), i)
    out = []
    for i, _, html in rows:
        raw = (html or "").encode()
        keep = best.get(html, i)
        kind = "response" if keep == i else "revisit"
        out.append((i, len(raw), hashlib.sha1(raw).hexdigest(), kind, keep if keep != i else None))
    return sorted(out, key=lambda r: (r[0] is not None, r))


def sample():
    rng = random.Random(3)
    body = "<p>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nünï\n</p>\r"
    rows = [(i, f"http://a/{i}", body * rng.choice([0, 1, 20, 21])) for i in range(60)]
    rows += [(100, None, None), (101, "http://x/\r\nWARC-Type: x", ""), (102, "u", "é" * 500), (103, "u", "é" * 500)]
    rows += [(104, "u", "x" * 3_000_000 + "\n" * 3), (105, "u", "x" * 999), (106, "u", "x" * 999), (7, "again", "tie")]
    return rows


def test_pages_come_back(spark, monkeypatch):
    rows = sample()
    assert run(spark, clashing(pages(spark, rows).repartition(5)), monkeypatch) == brute(rows)


def test_no_pages(spark, monkeypatch):
    assert run(spark, pages(spark, []), monkeypatch) == []


def test_equal_rows_and_missing_ids(spark, monkeypatch):
    big = "y" * 1500
    rows = [(None, "u", big), (9, "u", big), (9, "u", big), (4, "u", big), (None, "u", "z" * 1500), (None, "u", "z" * 1500)]
    got = run(spark, pages(spark, rows), monkeypatch)
    sha = hashlib.sha1(big.encode()).hexdigest()
    assert [(r[0], r[3], r[4]) for r in got if r[2] == sha] == [
        (None, "revisit", 9), (4, "revisit", 9), (9, "response", None), (9, "response", None)
    ]
    assert all(r[3] == "response" for r in got if r[2] != sha)


def test_members_and_sidecar(spark, tmp_path):
    rows = sample()
    mono, out = str(tmp_path / "mono"), str(tmp_path / "out")
    warc.write_monolithic(warc.revisits(pages(spark, rows).coalesce(2)), mono)
    files = warc.normalise(spark, mono, out).collect()
    assert sum(f.records for f in files) == len(rows)
    for f in files:
        raw = (tmp_path / "out" / f.archive).read_bytes()
        entries = [json.loads(x) for x in (tmp_path / "out" / f"{f.archive}.idx").read_text().splitlines()]
        assert len(raw) == f.bytes and len(entries) == f.records
        at = 0
        for e in entries:
            assert e["offset"] == at
            member = gzip.decompress(raw[at : at + e["length"]])
            assert member.startswith(b"WARC/1.1\r\n") and member.endswith(b"\r\n\r\n")
            at += e["length"]
        assert at == len(raw)
    whole = b"".join(gzip.decompress(p.read_bytes()) for p in sorted((tmp_path / "mono").glob("*.gz")))
    again = b"".join(gzip.decompress((tmp_path / "out" / f.archive).read_bytes()) for f in sorted(files))
    assert sorted(whole.split(b"\r\n\r\n")) == sorted(again.split(b"\r\n\r\n"))


def test_a_cut_stream_is_refused(spark, tmp_path):
    (tmp_path / "in").mkdir()
    data = b"WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 100\r\n\r\nshort"
    (tmp_path / "in" / "a.warc.gz").write_bytes(gzip.compress(data))
    with pytest.raises(Exception, match="ends inside a record"):
        warc.normalise(spark, str(tmp_path / "in"), shared_dir(spark, "cut"))


def test_foreign_archives(spark, tmp_path):
    """Many files in one task, junk before a record, other fields, several members already."""
    (tmp_path / "in").mkdir()
    for i in range(6):
        data = b"junk\r\n" + b"WARC/1.0\r\nwarc-type: resource\r\nContent-Length: 4\r\n\r\n\r\n\r\n\r\n\r\n"
        (tmp_path / "in" / f"{i}.warc.gz").write_bytes(gzip.compress(data) + gzip.compress(data[6:]))
    out = str(tmp_path / "out")
    warc.normalise(spark, str(tmp_path / "in"), out)
    got = warc.read_records(spark, out, run_bytes=100).collect()
    assert len(got) == 12 and {(r.record_type, bytes(r.payload)) for r in got} == {("resource", b"\r\n\r\n")}


def test_reading_back_takes_as_many_tasks_as_the_bytes_ask(spark, tmp_path):
    pages = spark.range(300).select(F.col("id").alias("page_id"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 40).alias("html"), F.lit("http://a.b/c").alias("url"))
    mono, out = str(tmp_path / "mono"), str(tmp_path / "out")
    warc.write_monolithic(warc.revisits(pages), mono)
    warc.normalise(spark, mono, out)
    total = warc.read_index(spark, out).agg(F.sum("length")).first()[0]
    read = warc.read_records(spark, out, run_bytes=total // 20)
    assert read.rdd.getNumPartitions() >= 20
    assert read.count() == 300
