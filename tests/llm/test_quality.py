import random
import re
from collections import Counter

import numpy as np

from beforehand.llm import quality as q
from beforehand.llm import queries

from .helpers import clashing, corpus, docs, text

LABELS = "doc_id long, quality int, toxic int"


def brute(t):
    t = t or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = Counter(zip(words, words[1:], words[2:]))
    marked = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if windows[w] > 1:
            marked |= {i, i + 1, i + 2}
    seen, dup = set(), 0
    for line in t.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), dup, len(marked)


def labelled(n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        good = rng.random() < 0.6
        body = text(rng, rng.randint(8, 14))
        if not good:
            body = " ".join(w + rng.choice(["###", "$$$", " |"]) for w in body.split())
        rows.append((i, body, "en", "s", len(body)))
        labels.append((i, int(good), 0))
    return rows, labels


def test_grams_are_of_characters():
    numbers = lambda t: set(q.features(t.encode())[0].tolist())
    # one word of three characters, seven bytes: itself and one character gram
    assert len(numbers("äé中")) == 2
    # and of four: itself, two grams of three, one of four
    assert len(numbers("äé中文")) == 4
    assert numbers("ABCD") == numbers("abcd") and numbers("") == set()
    long = "añ中b " * 70_000
    whole, blocks = q.features(long.encode()), q.BLOCK
    q.BLOCK = 1000
    try:
        cut = q.features(long.encode())
    finally:
        q.BLOCK = blocks
    assert (whole[0] == cut[0]).all() and np.allclose(whole[1], cut[1])


def test_base_counts():
    rng = random.Random(1)
    texts = [r[1] for r in corpus(120)] + ["a b c a b c", "a\n\na\n \n \na", "a b a b a b a", " x y z", "<|>#" * 9, "x\r\nx\r\ny"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    for t in texts:
        assert tuple(q.base_counts(t or "").values()) == brute(t), t


def test_whole_table(spark, monkeypatch):
    rows, labels = labelled(240, 2)
    edge = [(1000 + r[0], *r[1:]) for r in corpus(60)]
    tables = {"documents": clashing(docs(spark, rows + edge)), "labels": spark.createDataFrame(labels + [(None, 1, 0), (3, None, 0)], LABELS)}
    monkeypatch.setattr(queries, "table", lambda _s, _d, name: tables[name])
    got = {r.doc_id: r for r in queries.op8_quality_ngrams(spark, "").collect()}
    m = q.fit(tables["documents"], tables["labels"])
    assert len(got) == len(rows + edge)
    for doc_id, t, *_ in rows + edge:
        r, n = got[doc_id], brute(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert r.kept == (not r.base_failed and r.quality >= q.THRESHOLD)
        assert np.isclose(r.quality, q.probability(m, (t or "").encode()))
    kept = q.kept(tables["documents"], m)
    assert kept.columns == tables["documents"].columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, r in got.items() if r.kept)


def test_held_out_accuracy_and_calibration(spark):
    rows, labels = labelled(600, 3)
    m = q.train([(l[1], *q.features(r[1].encode())) for r, l in zip(rows[:300], labels)])
    p = np.array([q.probability(m, r[1].encode()) for r in rows[300:]])
    y = np.array([l[1] for l in labels[300:]])
    assert ((p >= 0.5) == y).mean() > 0.97
    assert abs(p.mean() - y.mean()) < 0.05


def test_the_sample_is_bounded_and_repeatable(spark):
    rows, labels = labelled(400, 4)
    d, l = docs(spark, rows), spark.createDataFrame(labels, LABELS)
    a, b = q.fit(d, l, sample_rows=100), q.fit(docs(spark, rows, 7), l, sample_rows=100)
    assert np.array_equal(a.weights, b.weights) and a[1:] == b[1:]
    assert not np.array_equal(a.weights, q.fit(d, l).weights)


def test_without_labels_the_fixed_rules_decide(spark):
    rows, labels = labelled(20, 5)
    for some in ([], [(i, 1, 0) for i in range(20)]):
        m = q.fit(docs(spark, rows), spark.createDataFrame(some, LABELS))
        assert m is None
        got = q.verdicts(docs(spark, rows), m).collect()
        assert all(r.kept == (not r.base_failed) and r.quality is None for r in got)
    assert q.verdicts(docs(spark, []), None).collect() == [] and q.kept(docs(spark, []), None).collect() == []


def test_blocks_do_not_change_features(monkeypatch):
    body = text(random.Random(8), 60).encode()
    at, x = q.features(body)
    for size in (7, 64, 1000):
        monkeypatch.setattr(q, "BLOCK", size)
        assert np.array_equal(q.features(body)[0], at) and np.allclose(q.features(body)[1], x)
    for tiny in (b"", b"a", b"ab", b"abc", b" "):
        assert np.isfinite(q.features(tiny)[1]).all()
