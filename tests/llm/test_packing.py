import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from beforehand.llm import mixing, packing, queries

from .helpers import clashing, corpus, docs

PATH = queries.vocabulary()


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text or "", add_special_tokens=False).ids + [packing.END_ID]


def check(got, rows, reference, length):
    """Each id in one piece, right sums, gapless sequences, only the last not full."""
    want = Counter()
    for doc_id, t, _, source, _ in rows:
        ids = reference(t)
        want[doc_id, source, tuple(ids)] += 1
    by_doc = {}
    for r in got:
        by_doc.setdefault((r.doc_id, r.source), []).append(r)
    for (doc_id, source, ids), n in want.items():
        own = [r for r in by_doc[doc_id, source] if r.doc_tokens == len(ids)]
        for r in own:
            part = np.array(ids[r.start : r.start + r.length], "<u4").tobytes()
            if n == 1 and len({k[2] for k in want if k[:2] == (doc_id, source)}) == 1:
                assert r.ids_crc32 == zlib.crc32(part)
        if len({k[2] for k in want if k[:2] == (doc_id, source)}) == 1:
            covered = sorted((r.start, r.length) for r in own)
            at = Counter(x for s, l in covered for x in range(s, s + l))
            assert set(at) == set(range(len(ids))) and set(at.values()) == {n}
    seqs = {}
    for r in got:
        seqs.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sorted(seqs) == list(range(len(seqs)))
    for s, parts in seqs.items():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at and n > 0
            at += n
        assert at == length or s == len(seqs) - 1
    assert sum(r.length for r in got) == sum(len(k[2]) * n for k, n in want.items())


@pytest.mark.parametrize("parts", [1, 9])
def test_whole_table(spark, monkeypatch, reference, parts):
    rows = corpus(150)
    rows += [rows[2], rows[2], (None, "no id <|endoftext|>", "en", "big", 5), (None, None, "en", None, 0)]
    monkeypatch.setattr(queries, "table", lambda *_: clashing(docs(spark, rows, parts)))
    got = queries.op10_drr_packing(spark, "").collect()
    check(got, rows, reference, 2048)


@pytest.mark.parametrize("weights", [{"a": 1, "b": 1, "c": 2}, {"a": 0.7, "b": 0.1}, {}, {"c": 5, None: 1, "zzz": 3}])
def test_weights(spark, reference, weights):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["to", "of", "in"]) for _ in range(rng.randint(0, 90))), "en", rng.choice(["a", "a", "b", "c", None]), 1) for i in range(300)]
    got = packing.pack(docs(spark, rows), PATH, weights, length=256, grain=32).collect()
    check(got, rows, reference, 256)
    live = {s: w for s, w in weights.items() if s in ("a", "b", "c", None)}
    if len(live) > 1:
        held = Counter()
        for r in got:
            if r.sequence_id < 4:
                held[r.source] += r.length
        for s, w in live.items():
            assert abs(held[s] / sum(held.values()) - w / sum(live.values())) < 0.1


def simulated(totals, length, grain):
    """Grain after grain down the tree, then each window's grains by queue: {queue: [place of each token]}."""
    names, left = [q for q, _ in totals], [n // grain for _, n in totals]

    def walk(low, high, k):
        """The queue of grain k of this branch, and its number there."""
        if high - low == 1:
            return low, k
        half = low + (high - low) // 2
        mine, whole = sum(left[low:half]), sum(left[low:high])
        if (k + 1) * mine // whole > k * mine // whole:
            return walk(low, half, k * mine // whole)
        return walk(half, high, k - k * mine // whole)

    out, per, slot = {q: [] for q in names}, length // grain, 0
    for at in range(0, sum(left), per):
        window = sorted(walk(0, len(names), k) for k in range(at, min(at + per, sum(left))))
        for q, _ in window:
            out[names[q]] += range(slot * grain, (slot + 1) * grain)
            slot += 1
    for q, n in totals:
        out[q] += range(slot * grain, slot * grain + n % grain)
        slot += 0
    return out


@pytest.mark.parametrize("seed,grain", [(s, g) for s in range(6) for g in (1, 4)])
def test_places_are_those_of_a_simulation(seed, grain):
    rng = random.Random(seed * 10 + grain)
    totals = [(f"q{i}", rng.choice([1, 3, 50, 400, 900])) for i in range(rng.randint(1, 9))]
    want, tail = simulated(totals, 64, grain), 0
    plans = packing.plan(totals, None, grain)
    for p, (q, n) in zip(plans, totals):
        places, at = [], 0
        while at < n:
            size = min(n - at, rng.choice([1, 2, 17, 300]))
            covered = 0
            for start, k, sequence, offset in packing.places(at, size, p, 64, grain):
                assert start == covered and k > 0 and offset + k <= 64
                places += range(sequence * 64 + offset, sequence * 64 + offset + k)
                covered += k
            assert covered == size
            at += size
        whole = n // grain * grain
        assert places[:whole] == want[q][:whole]
        assert places[whole:] == list(range(p["tail"], p["tail"] + n % grain))
        tail += n % grain


def test_places_of_very_many_tokens():
    """Totals whose products need more than 64 bits."""
    totals = [("a", 10**13 + 7), ("b", 3 * 10**12), ("c", 11)]
    for p, (q, n) in zip(packing.plan(totals), totals):
        first = max(0, n - 5_000)
        placed = list(packing.places(first, n - first, p))
        assert sum(x[1] for x in placed) == n - first
        for start, size, sequence, offset in placed:
            assert 0 <= sequence * 2048 + offset < sum(n for _, n in totals) and offset + size <= 2048


@pytest.mark.parametrize("sources", [20, 40])
def test_every_window_holds_every_source(spark, sources):
    rng = random.Random(sources)
    rows = [(i, " ".join(["to"] * rng.randint(20, 400)), "en", f"s{i % sources}", 1) for i in range(60 * sources)]
    got = packing.pack(docs(spark, rows), PATH).groupBy("sequence_id", "source").sum("length").collect()
    whole, windows = Counter(), {}
    for s, source, n in got:
        whole[source] += n
        windows.setdefault(s, Counter())[source] += n
    total = sum(whole.values())
    assert len(windows) > 100
    for s, own in windows.items():
        for source, n in whole.items():
            if s < len(windows) - 1:
                assert abs(own[source] / (2048 * n / total) - 1) <= 0.05, (s, source)


def test_queues_as_stored(spark, reference):
    rows = corpus(80)
    table = docs(spark, rows, 5).sortWithinPartitions("n_chars")
    got = packing.pack(table, PATH, order=None, carry=("n_chars",))
    check(got.drop("n_chars").collect(), rows, reference, 2048)
    assert "Exchange rangepartitioning" not in got._jdf.queryExecution().executedPlan().toString()
    assert {(r.doc_id, r.n_chars) for r in got.collect()} == {(r[0], r[4]) for r in rows}


def test_every_window_has_the_mix(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(["to"] * rng.randint(20, 200)), "en", rng.choice(["a"] * 6 + ["b"] * 3 + ["c"]), 1) for i in range(1500)]
    got = packing.pack(docs(spark, rows), PATH, length=2048, grain=128).collect()
    whole = Counter()
    for r in got:
        whole[r.source] += r.length
    total, last = sum(whole.values()), max(r.sequence_id for r in got)
    running = Counter()
    for s in range(last - 1):
        own = Counter()
        for r in got:
            if r.sequence_id == s:
                own[r.source] += r.length
        for source, n in whole.items():
            assert abs(own[source] - 2048 * n / total) <= 2 * 128
            running[source] += own[source]
            assert abs(running[source] - 2048 * (s + 1) * n / total) <= 2 * 128  # deficits are carried, not lost


def test_sequences_hold_the_ids(spark, reference):
    rows = corpus(40)
    pieces = packing.pack(docs(spark, rows), PATH, with_ids=True, carry=("n_chars",))
    got = packing.sequences(pieces, pad_id=7, carry=("n_chars",)).collect()
    texts = {r[0]: (reference(r[1]), r[4], r[3]) for r in rows}
    for r in got:
        own = np.frombuffer(r.ids, "<u4").tolist()
        assert [p.offset for p in r.pieces] == np.cumsum([0, *[p.length for p in r.pieces]])[:-1].tolist()
        for p in r.pieces:
            ids, n_chars, source = texts[p.doc_id]
            assert own[p.offset : p.offset + p.length] == ids[p.start : p.start + p.length]
            assert (p.n_chars, p.source) == (n_chars, source)
    ids = [np.frombuffer(r.ids, "<u4") for r in sorted(got)]
    assert {len(x) for x in ids} == {2048}
    held = Counter(np.concatenate(ids).tolist())
    want = Counter(x for r in rows for x in reference(r[1]))
    pad = 2048 - min(r.n_tokens for r in got)
    want[7] += pad
    assert held == want and sum(r.n_tokens < 2048 for r in got) <= 1


def test_ids_are_those_of_the_vocabulary(reference):
    rng = random.Random(6)
    alphabet = list("ab Z9'\n\t.,!é中 　\x1c\x85​🙂_-§") + ["  ", "'s", " the", "<|endoftext|>", "\r\n", "²", "½", "٣"]
    for _ in range(4000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        assert packing.encode(t, PATH).tolist() == reference(t), repr(t)


@pytest.mark.parametrize("text", [
    "\t" * 1_200_000 + "b", " " * 1_200_000 + "b", "\n" * 1_200_000, "a " + "\u3000" * 1_200_000 + " \nb  c",
], ids=["tabs", "blanks", "lines", "wide"])
def test_long_white_space(reference, text):
    assert packing.encode(text, PATH).tolist() == reference(text)


def test_long_white_space_is_cut_exactly(monkeypatch, reference):
    monkeypatch.setattr(packing, "RUN", 2)
    monkeypatch.setattr(packing, "BLANKS", re.compile(packing.BLANKS.pattern.replace("100000", "2")))
    rng = random.Random(7)
    alphabet = list("ab9'!.\n\t \r\x0b\x1c\x1f\x85\xa0\u2003\u200b\u2028\u3000") + ["  ", "\n\n", "\t\t", "'s"]
    for _ in range(4000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        assert packing.encode(t, PATH).tolist() == reference(t), repr(t)


def test_long_texts_in_parts(monkeypatch, reference):
    rng = random.Random(8)
    alphabet = list("ab9'!.\n\té中") + ["  ", " the", " of", " 12", " \u3000", "<|endoftext|>"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    for size in (1, 3, 17):
        monkeypatch.setattr(packing, "JOINED", size)
        for t in texts:
            assert packing.encode(t, PATH).tolist() == reference(t), repr(t)


def test_the_shuffle_outlives_packing(spark, tmp_path):
    rows = [(i, f"number {i} " * (3 + i % 5), "en", "big" if i % 4 else "rare", 1) for i in range(120)]
    weights = spark.createDataFrame([("big", 1.0), ("rare", 1.0)], "source string, weight double")
    mixed = mixing.replicate(docs(spark, rows), weights, size_ratio=3.0)
    key = {(r.doc_id, r.copy): r.shuffle_key for r in mixed.collect()}
    mixed.drop("rate", "copies").coalesce(1).write.parquet(f"{tmp_path}/mixed")
    got = corpus_pipeline.pack_windows(spark, spark.read.parquet(f"{tmp_path}/mixed"), "").orderBy("sequence_id")
    pieces = [p for r in got.collect() for p in r.pieces if p.start == 0]
    for source in ("big", "rare"):
        own = [(p.doc_id, p.copy) for p in pieces if p.source == source]
        asked = sorted(key, key=lambda k: (key[k], k))
        assert own == [k for k in asked if (k[0] % 4 == 0) == (source == "rare")] and len(own) > 40
        assert sum(a[0] == b[0] for a, b in zip(own, own[1:])) < len(own) / 5


def test_empty_table(spark):
    assert packing.pack(docs(spark, []), PATH).collect() == []
    assert packing.pack(docs(spark, []), PATH, {"a": 1}).collect() == []
