import hashlib
import math

import pytest

from beforehand.llm import mixing

from .helpers import clashing, corpus, docs


def number(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13], 16)


def draw(rate, u):
    """Inversion by adding up probabilities from zero."""
    k, below = -1, 0.0
    while u >= below and k < 10 * rate + 100:
        k += 1
        below += math.exp(k * math.log(rate) - rate - math.lgamma(k + 1))
    return k


def brute(rows, weights=None, ratio=1.0):
    size = lambda t: len((t or "").encode()) + 1
    total = {}
    for _, t, _, s, _ in rows:
        total[s] = total.get(s, 0) + size(t)
    w = {s: b**0.7 if weights is None else weights.get(s, 0) for s, b in total.items()}
    rate = {s: w[s] / sum(w.values()) * sum(total.values()) * ratio / b for s, b in total.items()}
    out = []
    for doc_id, t, _, s, _ in rows:
        name = doc_id if doc_id is not None else hashlib.md5((t or "").encode()).hexdigest()
        n = draw(rate[s], (number("mix", name) + 0.5) / 2**52) if rate[s] else 0
        out += [(doc_id, s, n, c, number("mix-order", name, c)) for c in range(1, n + 1)]
    return sorted(out, key=lambda r: r[4])


@pytest.mark.parametrize("weights,ratio", [(None, 1.0), (None, 3.0), ({"big": 1.0, "s1": 5.0, None: 2.0}, 2.0), ({"s1": 1.0}, 4.0)])
def test_whole_table(spark, weights, ratio):
    rows = corpus(120)
    rows += [(None, "no id", "en", "big", 5), (None, None, "en", "s2", 0)] + rows[:3]
    given = weights and spark.createDataFrame(list(weights.items()), "source string, weight double")
    got = mixing.replicate(clashing(docs(spark, rows)).drop("rate", "copies", "copy", "shuffle_key"), given, ratio).collect()
    seen = [(r.doc_id, r.source, r.copies, r.copy, r.shuffle_key) for r in got]
    assert sorted(seen, key=str) == sorted(brute(rows, weights, ratio), key=str)
    assert [r[4] for r in seen] == sorted(r[4] for r in seen)


def test_clashing_names_are_kept(spark):
    df = clashing(docs(spark, corpus(20)))
    got = mixing.replicate(df, draws=False)
    assert got.columns == df.columns and {r.copies for r in got.collect()} == {"extra copies"}


@pytest.mark.parametrize("rate", [0.01, 0.7, 1.0, 4.5, 30.0, 400.0, 3000.0])
def test_steps_invert_the_distribution(spark, rate):
    row = mixing.inverses(spark.createDataFrame([("s", rate)], "source string, rate double")).first()
    steps = [row["steps"][i] for i in range(len(row["steps"]))]
    assert abs(steps[-1] - 1) < 1e-9 and steps == sorted(steps)
    mean = row["least"] + sum(1 - p for p in steps)
    assert math.isclose(mean, rate, rel_tol=1e-6, abs_tol=1e-6)


def test_shares_reach_the_targets(spark):
    rows = [(i, "x" * 99, "en", "big" if i % 4 else "small", 99) for i in range(4000)]
    given = spark.createDataFrame([("big", 1.0), ("small", 1.0)], "source string, weight double")
    got = mixing.replicate(docs(spark, rows), given).collect()
    assert abs(sum(r.source == "small" for r in got) / len(got) - 0.5) < 0.03 and abs(len(got) - 4000) < 250


def test_empty_table_and_no_weight(spark):
    assert mixing.replicate(docs(spark, [])).collect() == []
    none = spark.createDataFrame([("other", 1.0)], "source string, weight double")
    assert mixing.replicate(docs(spark, corpus(10)), none).collect() == []
