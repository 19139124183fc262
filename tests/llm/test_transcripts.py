import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from beforehand.llm import transcripts as t

from .helpers import clashing, sentence

TURNS = "conv_id long, turn long, role string, text string"


def conversations(n, seed, lines=3, turns=8):
    rng, rows = random.Random(seed), []
    for c in range(n):
        for i in range(rng.randint(2, turns)):
            role = "system" if i == 0 and c % 5 == 0 else ("user", "assistant")[(i + (c % 5 == 0)) % 2]
            size = 1 if role != "assistant" else rng.randint(1, lines)
            body = "\n".join(sentence(rng, 3 if role == "user" else 14) for _ in range(size))
            rows.append((c, i, role, body[:-1] + "?" if role == "user" else body))
    return rows


def raw(spark, rows):
    return t.raw_turns(spark.createDataFrame(rows, TURNS))


def brute(turns, m):
    """All paths' best score by plain recursion over whole transcripts."""
    out = []
    for conv in sorted({r.conv_id for r in turns}):
        lines = "\n".join(r.text for r in sorted((r for r in turns if r.conv_id == conv), key=lambda r: r.turn)).split("\n")
        seen = t.symbols(lines)
        best = [{s: (m.start[s] + m.emit[s, seen[0]], [s]) for s in range(t.K)}]
        for x in seen[1:]:
            best.append({s: max(((v + m.step[q, s] + m.emit[s, x], p + [s]) for q, (v, p) in best[-1].items()), key=lambda z: z[0]) for s in range(t.K)})
        path = max(best[-1].values(), key=lambda z: z[0])[1]
        for i, x in enumerate(t._turns(lines, path)):
            out.append((conv, i, x["role"], x["n_lines"], x["content"]))
    return out


def parsed(parts, m):
    return sorted((tuple(r)[:5] for r in t.parse(parts, m).collect()), key=str)


@pytest.mark.parametrize("parts", [1, 13])
def test_against_brute_force(spark, parts):
    turns = raw(spark, conversations(25, 1))
    m = t.fit(turns)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = parsed(turns.select("conv_id", F.col("turn").alias("part"), "text"), m)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == sorted(brute(turns.collect(), m), key=str)


def test_one_conversation_over_many_ranges(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"line {i}?\n\nmore of {i}") for i in range(400)]
    turns = raw(spark, rows + conversations(5, 2)[20:])
    m = t.fit(turns)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = parsed(turns.select("conv_id", F.col("turn").alias("part"), "text"), m)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == sorted(brute(turns.collect(), m), key=str)


def test_held_out_roles(spark):
    rows = conversations(300, 3)
    m = t.fit(raw(spark, [r for r in rows if r[0] % 2]))
    held = [r for r in rows if not r[0] % 2]
    turns = raw(spark, held)
    got = {(r.conv_id, r.turn): r.role for r in t.parse(turns.select("conv_id", F.col("turn").alias("part"), "text"), m).collect()}
    right = sum(got.get((c, i)) == role for c, i, role, _ in held)
    assert right / len(held) > 0.9


def test_passages_chain_to_the_whole(spark):
    m = t.fit(raw(spark, conversations(20, 4)))
    rng = random.Random(1)
    seen = [rng.randrange(t.N_SYMBOLS) for _ in range(60)]
    a, b = t.passage(seen[:23], m)[t.K], t.passage(seen[23:], m)[: t.K]
    assert np.isclose((a[:, None] + b).max(), t.passage(seen, m)[t.K].max())


def test_odd_rows(spark):
    rows = [(None, 0, "user", "User: a"), (None, 0, "user", "User: b"), (1, 0, None, None), (2, 0, "tool", ""),
            (3, 1, "user", "User: same\nx"), (3, 1, "user", "User: same\nx"), (4, None, "user", "Human: <|user|>")]
    parts = spark.createDataFrame(rows, TURNS).select("conv_id", F.col("turn").alias("part"), "text")
    m = t.fit(raw(spark, conversations(20, 4)))
    got = t.parse(clashing(parts), m).collect()
    assert sorted((r.conv_id is None, r.conv_id or 0, r.turn, r.content) for r in got) == [
        (False, 1, 0, ""), (False, 2, 0, ""), (False, 3, 0, "same\nx"), (False, 3, 1, "same\nx"), (False, 4, 0, "<|user|>"),
        (True, 0, 0, "a"), (True, 0, 0, "b"),
    ]
    assert [r.rendered for r in got if r.conv_id == 4] == ["<|user|>\n< |user|>\n<|end|>"]


def test_nothing(spark):
    turns = raw(spark, [])
    m = t.fit(turns)
    assert t.parse(turns.select("conv_id", F.col("turn").alias("part"), "text"), m).collect() == []
