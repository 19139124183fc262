import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from beforehand.llm import queries, spelling

from .helpers import DOCS, clashing, docs


def brute_words(rows):
    out = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    out = {}
    for w, n in words.items():
        near = [v for v in words if abs(len(v) - len(w)) <= 1 and one_edit(v, w)]
        best = min(near, key=lambda v: (-words[v], v), default=None)
        form = best if best is not None and words[best] >= 5 * n else None
        out[w] = [form, w, n, len(near), words[form] if form else None]
    for w in out:
        while out[out[w][1]][0]:
            out[w][1] = out[out[w][1]][0]
    return {w: tuple(v) for w, v in out.items()}


def edited(rng, w):
    at, kind, c = rng.randrange(len(w)), rng.randrange(3), rng.choice("abcdeéÿ×")
    return w[:at] + ("", c, c + w[at])[kind] + w[at + 1 :]


def variety(seed, n_words=60, n_docs=90):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(6, 9))) for _ in range(n_words)]
    words += [edited(rng, rng.choice(words)) for _ in range(2 * n_words)]
    words += ["aaaaaa", "aaaaaaa", "aaaaaaaa", "ééééééé", "Straßenbahn", "short"]
    weights = [rng.choice([1, 3, 20, 120]) for _ in words]
    rows = []
    for i in range(n_docs):
        body = rng.choice([" ", ", ", "\n", "1", "'"]).join(
            w.upper() if rng.random() < 0.1 else w for w in rng.choices(words, weights, k=rng.randint(0, 90))
        )
        rows.append((i * 7, body, "en", "big", 1))
    return rows + [(None, rows[3][1], None, None, None), (5, None, "en", "x", 0), (6, "", "en", "x", 0), rows[4], rows[4]]


@pytest.mark.parametrize("seed,tile", [(1, 512), (2, 3), (3, 16)])
def test_whole_table(spark, monkeypatch, seed, tile):
    rows = variety(seed)
    monkeypatch.setattr(queries, "table", lambda *_: clashing(docs(spark, rows)))
    monkeypatch.setattr(spelling, "TILE", tile)
    got = queries.op11_spelling_tiles(spark, "").collect()
    want = brute(brute_words(rows))
    assert len(want) > 100 and any(v[0] for v in want.values()) and any(v[3] == 0 for v in want.values())
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in got} == want
    assert len(got) == len(want)


def test_chains_of_forms_and_ties(spark):
    chain = ["aaaaaa", "aaaaab", "aaaabb", "aaabbb", "aabbbb", "abbbbb", "bbbbbb"]
    words = {w: 5 * 6**i for i, w in enumerate(chain)}
    words |= {"tietie": 5, "tietif": 40, "tietid": 40, "farawayword": 9}
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    near = {r.word: (r.n_near, r.form_near) for r in spelling.near_words(table).collect()}
    assert near["tietie"] == (2, "tietid") and "farawayword" not in near
    spark_rows = [(i, " ".join(w for w, n in words.items() for _ in range(n))) for i in range(1)]
    rows = [(i, t, None, None, None) for i, t in spark_rows]
    got = {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in spelling.variants(docs(spark, rows)).collect()}
    assert got == brute(brute_words(rows))


@pytest.mark.parametrize("tile", [4, 50])
def test_hot_prefix_is_cut_until_few_agree(spark, monkeypatch, tile):
    """Half of the words share all but two places: intervals are halved, no tile holds more than agree."""
    rng = random.Random(tile)
    words = {f"session{a}{b}end" for a in "abcdefghijklm" for b in "abcdefghijklm"} | {edited(rng, "sessionabend") for _ in range(80)}
    words = {w: rng.randint(5, 90) for w in words if len(w) >= 6}
    monkeypatch.setattr(spelling, "TILE", tile)
    table = spark.createDataFrame(list(words.items()), "word string, n long")
    placed = spelling.tiles(table)
    sizes = {tuple(r[:-1]): r[-1] for r in placed.groupBy("low", "high", "key").count().collect()}
    assert all(n <= tile for (low, high, _), n in sizes.items() if low < high)
    got = {r.word: (r.n_near, r.form_near, r.near_n) for r in spelling.near_words(table).collect()}
    want = {}
    for w in words:
        near = [v for v in words if one_edit(v, w)]
        if near:
            best = min(near, key=lambda v: (-words[v], v))
            want[w] = (len(near), best, words[best])
    assert got == want


def test_no_rows_no_words(spark):
    assert spelling.variants(spark.createDataFrame([], DOCS)).count() == 0
    assert spelling.variants(docs(spark, [(1, "a few short bits", "en", "x", 1), (2, None, None, None, None)])).count() == 0


def test_very_long_text_and_very_long_words():
    text = "lantern " * 900_000 + "x" * 5_000_000 + " lantern"
    assert len(text) > 2 * spelling.PIECE
    found = Counter()
    for runs in spelling._runs(text):
        found.update(runs)
    assert found == {"lantern": 900_001, "x" * 5_000_000: 1}
    long = "ab" * 20_000
    words = [long, long[:777] + "c" + long[778:], long[:30_000] + long[30_001:]]
    n, same = np.array([5, 50, 500]), np.zeros(3, int)
    size = np.array([40_000] * 3)
    for inserts, want in ((False, {0: 1, 1: 0}), (True, {0: 2, 2: 0})):
        at, near, best, who = spelling.near_in_tile(words, n, same, size, np.array([inserts] * 3), same, size)
        assert dict(zip(at.tolist(), who.tolist())) == want and (near == 1).all()
