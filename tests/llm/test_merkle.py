import hashlib
import random
import time

import numpy as np
import xxhash
from pyspark.sql import functions as F

from beforehand.llm import merkle, queries

from .helpers import clashing, corpus, docs, text


def test_whole_table(spark, monkeypatch):
    rows = corpus(150)
    monkeypatch.setattr(queries, "table", lambda *_: clashing(docs(spark, rows, 7)))
    got = {r.doc_id: r for r in queries.op3_merkle_fingerprints(spark, "").collect()}
    assert len(got) == len(rows)
    for i, (doc_id, own, *_) in enumerate(rows):
        own, following = own or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(own) // 2
        changed = own[: len(own) - half] + following[:half]
        r = got[doc_id]
        assert r.n_chars == len(own)
        assert r.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert r.fingerprint == merkle.tree(own).hash.hex()
        assert r.edited_fingerprint == merkle.tree(changed).hash.hex()
        assert r.near_edited == merkle.compare(merkle.tree(own), merkle.tree(changed))[0]
        assert r.near_next == merkle.compare(merkle.tree(own), merkle.tree(following))[0]
        assert (r.fingerprint == r.edited_fingerprint) == (own == changed) == (r.near_edited == 1)


def test_one_row_and_none(spark):
    (r,) = merkle.next_edits(docs(spark, [(4, "abcdef", "en", "s", 6)])).collect()
    assert r.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest() and r.near_next == 1
    assert merkle.next_edits(docs(spark, [])).collect() == []


def test_ties_and_repeated_rows(spark):
    rows = [(1, "b b b b", "en", "s", 1), (1, "a a a a", "en", "s", 1), (None, "c c", "en", "s", 1), (1, "a a a a", "en", "s", 1)]
    got = sorted((r.doc_id or 0, r.edited_sha256, r.near_next) for r in merkle.next_edits(docs(spark, rows)).collect())
    # of equal ids by a hash of the text, as a signed number
    hashed = lambda t: np.int64(np.uint64(xxhash.xxh64_intdigest(t, seed=42)))
    order = ["c c", *sorted(["a a a a", "a a a a", "b b b b"], key=hashed)]
    want = []
    for i, t in enumerate(order):
        n = order[(i + 1) % 4]
        want.append((1 if i else 0, hashlib.sha256(merkle.edited(t, n).encode()).hexdigest(), float(t == n)))
    assert [(a, b) for a, b, _ in got] == sorted((a, b) for a, b, _ in want)
    assert sorted(c == 1 for *_, c in got) == sorted(c == 1 for *_, c in want)


def test_trees_hold_every_character():
    rng = random.Random(5)
    for t in ["", "a", "\n\n\n", " \n \n x", "a\n\nb\n \n\nc", "One. Two! Three?\nFour", text(rng, 40), "ü" * 999]:
        def leaves(n):
            return [n] if n.below and isinstance(n.below[0], str) else [x for b in n.below for x in leaves(b)]

        root = merkle.tree(t)
        found = leaves(root)
        assert "".join(n.below[0] for n in found) == t and root.end == len(t)
        assert [t[n.start : n.end] for n in found] == [n.below[0] for n in found]


def test_differences_locate_an_edit():
    rng = random.Random(6)
    for _ in range(50):
        t = text(rng, 30)
        at = rng.randrange(len(t))
        other = t[:at] + "#" + t[at + 1 :]
        near, spans = merkle.compare(merkle.tree(t), merkle.tree(other))
        assert 0.9 < near < 1 and any(a <= at < b for a, b in spans) and sum(b - a for a, b in spans) < len(t) / 3


def test_likeness_follows_the_shared_part():
    rng = random.Random(7)
    for _ in range(30):
        t, n = text(rng, 40), text(rng, 40)
        near = merkle.compare(merkle.tree(t), merkle.tree(merkle.edited(t, n)))[0]
        assert 0.4 < near < 0.75 and merkle.compare(merkle.tree(t), merkle.tree(n))[0] < 0.2
    assert merkle.compare(merkle.tree(""), merkle.tree("x")) == (0.0, [])
    assert merkle.compare(merkle.tree("x"), merkle.tree("")) == (0.0, [(0, 1)])


def test_long_runs_of_stops_take_no_longer(spark):
    dots = "." * 1_000_000
    began = time.time()
    for t in (dots, "a" + dots + " b", "?!" * 500_000 + "\n" + dots):
        own = merkle.tree(t)
        assert own.end == len(t) and merkle.compare(own, own)[0] == 1
    assert time.time() - began < 20
    cuts = [n.below[0] for n in merkle.tree("One... Two?! Three. \nx.y. .. z").below[0].below[0].below]
    assert cuts == ["One... ", "Two?! ", "Three. \n"] or "".join(cuts) == "One... Two?! Three. \n"


def test_rows_without_id_fill_all_ranges(spark, monkeypatch):
    rows = spark.range(4_000).select(
        F.when(F.col("id") % 20 == 0, F.col("id")).alias("doc_id"), F.concat(F.lit("text "), F.col("id") % 700).alias("text")
    )
    sizes = {}
    real = merkle.saved

    def counted(df, label):
        out = real(df, label)
        if label == "walk":
            sizes.update(out.where("kind in ('row', 'first')").groupBy(F.input_file_name()).count().collect())
        return out

    monkeypatch.setattr(merkle, "saved", counted)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = merkle.next_edits(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got.count() == 4_000
    assert len(sizes) >= 6 and max(sizes.values()) < 1_000
