"""Roles of raw transcripts, recovered by a hidden Markov model, and turns in one canonical form.

A state is a role and whether the line opens a turn. What a line shows (a speaker marker, a
blank line before it, its length, its end) is one symbol. Start, transition and symbol
counts come from labelled turns; Viterbi finds the best states of a whole transcript.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from itertools import groupby
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import saved

ROLES = ("system", "user", "assistant")
STATES = [(role, opens) for role in ROLES for opens in (True, False)]
K = len(STATES)
ADDED = 0.1

# Names that speakers go by.
SPEAKERS = {
    "system": ["system", "sys", "context"],
    "user": ["user", "human", "customer", "question", "prompt", "q", "me"],
    "assistant": ["assistant", "ai", "bot", "agent", "answer", "response", "a"],
}
_ROLE_OF = {name: role for role, names in SPEAKERS.items() for name in names}
_NAME = "|".join(sorted(_ROLE_OF, key=len, reverse=True))
MARKER = re.compile(
    rf"\s*(?:(?:<\|?|\[|\*\*)\s*({_NAME})\s*(?:\|?>|\]:?|:?\*\*:?)|#+\s*({_NAME})\s*(?::|$)|({_NAME})\s*(?::|>))[ \t]*",
    re.I,
)
LENGTHS = (0, 20, 80, 200)
N_MARKERS = len(ROLES) + 1
N_SHAPES = 2 * (len(LENGTHS) + 1) * 3
N_SYMBOLS = N_MARKERS * N_SHAPES


def marker(line: str) -> tuple[str | None, str]:
    """The role a line's marker names, or None, and the line without it."""
    m = MARKER.match(line)
    if not m:
        return None, line
    return _ROLE_OF[(m[1] or m[2] or m[3]).lower()], line[m.end() :]


def symbols(lines: list[str], blank_before: bool = False) -> list[int]:
    """One symbol a line: marker, blank line before it, length class, how it ends."""
    out = []
    for line in lines:
        role, rest = marker(line)
        text = rest.strip()
        size = sum(len(text) > n for n in LENGTHS)
        end = 0 if not text else 1 if text[-1] == "?" else 2
        out.append(((((ROLES.index(role) + 1 if role else 0) * 2 + blank_before) * (len(LENGTHS) + 1)) + size) * 3 + end)
        blank_before = not line.strip()
    return out


class Model(NamedTuple):
    """Logarithms of start, transition and symbol probabilities."""

    start: np.ndarray
    step: np.ndarray
    emit: np.ndarray


def model(counts: dict[tuple[str, int, int], int]) -> Model:
    """From counts of ("start", state, 0), ("step", from, to) and ("emit", state, symbol).

    Markers and shapes are taken as independent given the state, so a rare pair is not unseen.
    """
    start, step, emit = np.full(K, ADDED), np.full((K, K), ADDED), np.zeros((K, N_SYMBOLS))
    for (kind, a, b), n in counts.items():
        if kind == "start":
            start[a] += n
        else:
            (step if kind == "step" else emit)[a, b] += n
    for s, (role, _) in enumerate(STATES):
        for t, (other, opens) in enumerate(STATES):
            if not opens and other != role:
                step[s, t] = 0  # a turn does not change its role
    start[[not opens for _, opens in STATES]] = 0
    pairs = emit.reshape(K, N_MARKERS, N_SHAPES)
    with np.errstate(divide="ignore"):
        start, step, marks, shapes = (
            np.log(x / x.sum(-1, keepdims=True)) for x in (start, step, pairs.sum(2) + ADDED, pairs.sum(1) + ADDED)
        )
    return Model(start, step, (marks[:, :, None] + shapes[:, None, :]).reshape(K, N_SYMBOLS))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: Counter = Counter()
    for batch in batches:
        for role, before, text in zip(*(c.to_pylist() for c in batch.columns)):
            opens, inside = 2 * ROLES.index(role), 2 * ROLES.index(role) + 1
            seen = symbols((text or "").split("\n"))
            if before is None:
                found["start", opens, 0] += 1
            found["emit", opens, seen[0]] += 1
            for x in seen[1:]:
                found["emit", inside, x] += 1
            last = inside if len(seen) > 1 else opens
            if len(seen) > 1:
                found["step", opens, inside] += 1
                found["step", inside, inside] += len(seen) - 2
            found["end", last, 0] += 1
            if before in ROLES:
                found["turn", 2 * ROLES.index(before), opens] += 1
    yield pa.RecordBatch.from_pylist(
        [{"kind": k, "a": a, "b": b, "n": n} for (k, a, b), n in found.items()],
        pa.schema([("kind", pa.string()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64())]),
    )


def fit(turns: DataFrame) -> Model:
    """A model from all labelled turns: ``conv_id, turn, role, text`` (the raw text, markers included).

    Rows whose role is none of ``ROLES`` are left out. The turn before is that with the next lower
    number, found by a join on unique (conv_id, turn), so one long conversation is spread.
    Counts are added up in Spark; their number is bounded by states times symbols.
    """
    known = turns.where(F.col("role").isin(*ROLES)).select("conv_id", "turn", "role", "text")
    before = known.groupBy("conv_id", (F.col("turn") + 1).alias("turn")).agg(F.min("role").alias("before"))
    rows = known.join(saved(before, "turns-before"), ["conv_id", "turn"], "left").select("role", "before", "text")
    counted = rows.mapInArrow(_counted, "kind string, a long, b long, n long")
    found = {(r.kind, r.a, r.b): r.n for r in counted.groupBy("kind", "a", "b").agg(F.sum("n").alias("n")).collect()}
    # a turn ends in its opening line or inside; either way the next role follows as often
    shares = {}
    for (kind, a, b), n in found.items():
        if kind == "turn":
            for last in (a, a + 1):
                ends = sum(found.get(("end", s, 0), 0) for s in (a, a + 1))
                shares["step", last, b] = n * found.get(("end", last, 0), 0) / max(1, ends)
    return model({**{k: n for k, n in found.items() if k[0] in ("start", "step", "emit")}, **shares})


def viterbi(seen: list[int], m: Model, entry: int | None = None, leave: int | None = None) -> list[int]:
    """The best states of a run of symbols; ``entry``: the state before it, ``leave``: its last state."""
    score = (m.start if entry is None else m.step[entry]) + m.emit[:, seen[0]]
    back = np.empty((len(seen), K), np.int8)
    for i, x in enumerate(seen[1:], 1):
        ways = score[:, None] + m.step
        back[i] = ways.argmax(0)
        score = ways.max(0) + m.emit[:, x]
    path = [int(score.argmax()) if leave is None else leave]
    for i in range(len(seen) - 1, 0, -1):
        path.append(int(back[i, path[-1]]))
    return path[::-1]


def passage(seen: list[int], m: Model) -> np.ndarray:
    """Best scores through a run: a row for each state before it, a last row for its being the start."""
    score = np.vstack([m.step, m.start]) + m.emit[:, seen[0]]
    for x in seen[1:]:
        score = (score[:, :, None] + m.step[None]).max(1) + m.emit[:, x]
    return score


def _turns(lines: list[str], path: list[int]) -> list[dict]:
    """Runs of one turn: ``role, fresh`` (whether it opens here)``, n_lines, content``."""
    out: list[dict] = []
    for line, state in zip(lines, path):
        role, opens = STATES[state]
        if opens or not out:
            out.append({"role": role, "fresh": opens, "n_lines": 0, "parts": []})
        out[-1]["n_lines"] += 1
        out[-1]["parts"].append(marker(line)[1] if opens else line)
    for x in out:
        x["content"] = "\n".join(x.pop("parts"))
    return out


_TURN = "conv_id long, turn long, role string, n_lines long, content string"
_OPEN = f"{_TURN}, kind string, own long, part long, spot long"
_ARROW = {"long": pa.int64(), "string": pa.string()}


def _decoder(m: Model):
    shape = pa.schema([(n, _ARROW[t]) for n, t in (c.split() for c in _OPEN.split(", "))])

    def whole(conv, texts: list[str]) -> list[dict]:
        lines = "\n".join(texts).split("\n")
        found = _turns(lines, viterbi(symbols(lines), m))
        return [
            {"conv_id": conv, "turn": i, "kind": "turn", **{k: x[k] for k in ("role", "n_lines", "content")}}
            for i, x in enumerate(found)
        ]

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, first, out = TaskContext.get().partitionId(), True, []
        rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns)))
        held: list[dict] = []
        for (conv, own), run in groupby(rows, key=lambda r: r[:2]):
            if held and not first:  # it has ended inside this range
                out += whole(held[0]["conv_id"], [h["content"] for h in held])
            else:
                out += held
                first = not held
            held = [
                {"conv_id": conv, "own": own, "kind": "open", "part": part, "spot": i, "content": r[2] or ""}
                for i, r in enumerate(run)
            ]
            if len(out) >= 2048:
                yield pa.RecordBatch.from_pylist(out, shape)
                out = []
        out += held
        if out:
            yield pa.RecordBatch.from_pylist(out, shape)

    return decode


def parse(parts: DataFrame, m: Model) -> DataFrame:
    """``conv_id, turn, role, n_lines, content, rendered`` of raw transcripts.

    ``parts`` has ``conv_id, part, text``: pieces of a transcript in the order of ``part`` (ties
    by text), joined by line feeds; NULL is an empty piece. Rows without conv_id are
    transcripts of their own. Turns count from 0. In ``rendered``, marks inside the content are
    broken up, so that a turn cannot forge another.

    Parts are sorted in ranges, so no task takes more than a range, however long a
    transcript. One that crosses the end of a range is decoded in pieces: best scores through
    each piece, chained, give the exact states at the seams, and so the same turns.
    """
    row = F.monotonically_increasing_id()
    rows = parts.select("conv_id", "part", F.col("text").alias("content"), row.alias("_row"))
    rows = rows.withColumn("own", F.when(F.col("conv_id").isNull(), F.col("_row")).otherwise(-1))
    # equal rows differ by number only, so that their lines are not mixed
    order = ["conv_id", "own", "part", F.xxhash64("content"), "_row"]
    ordered = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    walked = ordered.select(F.col("conv_id").cast("long"), "own", "content").mapInArrow(_decoder(m), _OPEN)
    walked = saved(walked, "transcripts")
    inside = walked.where("kind = 'turn'").select(*[c.split()[0] for c in _TURN.split(", ")])
    turns = inside.unionByName(_seamed(walked.where("kind = 'open'"), m))
    return turns.withColumn(
        "rendered",
        F.concat(
            F.lit("<|"), "role", F.lit("|>\n"), F.replace("content", F.lit("<|"), F.lit("< |")), F.lit("\n<|end|>")
        ),
    )


def _seamed(open_: DataFrame, m: Model) -> DataFrame:
    """Turns of the transcripts that touch the end of a range: at most two pieces a range."""
    piece = ["conv_id", "own", "part"]

    def lines_of(pdf: pd.DataFrame) -> list[str]:
        return "\n".join(pdf.sort_values("spot")["content"]).split("\n")

    def through(pdf: pd.DataFrame) -> pd.DataFrame:
        lines = lines_of(pdf)
        # whether a blank line comes before a piece is not known here: both are tried
        best = [passage(symbols(lines, b), m).ravel().tolist() for b in (False, True)]
        return pd.DataFrame(
            {
                "conv_id": pdf["conv_id"].iloc[:1].astype("Int64"),
                "own": pdf["own"].iloc[:1],
                "part": pdf["part"].iloc[:1],
                "best": [best[0]],
                "best_blank": [best[1]],
                "ends_blank": [not lines[-1].strip()],
            }
        )

    def chained(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("part").reset_index(drop=True)
        blank, score, backs = False, None, []
        blanks = [False, *pdf["ends_blank"].tolist()[:-1]]
        for i, r in pdf.iterrows():
            best = np.array(r["best_blank"] if blanks[i] else r["best"]).reshape(K + 1, K)
            if score is None:
                score = best[K]
            else:
                ways = score[:, None] + best[:K]
                backs.append(ways.argmax(0))
                score = ways.max(0)
        leave = [int(score.argmax())]
        for b in reversed(backs):
            leave.append(int(b[leave[-1]]))
        leave.reverse()
        out = pdf[["conv_id", "own", "part"]].copy()
        out["conv_id"] = out["conv_id"].astype("Int64")
        out["entry"], out["leave"], out["blank"] = [-1, *leave[:-1]], leave, blanks
        return out

    def decoded(pdf: pd.DataFrame) -> pd.DataFrame:
        lines, r = lines_of(pdf), pdf.iloc[0]
        seen = symbols(lines, bool(r["blank"]))
        found = _turns(lines, viterbi(seen, m, None if r["entry"] < 0 else int(r["entry"]), int(r["leave"])))
        out = pd.DataFrame(found)
        out["conv_id"] = pd.array([None if pd.isna(r["conv_id"]) else int(r["conv_id"])] * len(out), "Int64")
        out["own"], out["part"], out["local"] = r["own"], r["part"], np.cumsum(out["fresh"])
        return out[["conv_id", "own", "part", "local", "role", "n_lines", "content"]]

    keys = "conv_id long, own long, part long"
    best = f"{keys}, best array<double>, best_blank array<double>, ends_blank boolean"
    scores = open_.groupBy(*piece).applyInPandas(through, best)
    seams = scores.groupBy("conv_id", "own").applyInPandas(chained, f"{keys}, entry long, leave long, blank boolean")
    seams = saved(seams, "seams")
    same = [open_[c].eqNullSafe(seams[c]) for c in piece]
    told = open_.join(seams, same[0] & same[1] & same[2]).select(
        *[open_[c] for c in piece], "spot", "content", "entry", "leave", "blank"
    )
    runs = told.groupBy(*piece).applyInPandas(
        decoded, f"{keys}, local long, role string, n_lines long, content string"
    )
    runs = saved(runs, "runs")
    # turns opened in earlier pieces: one row a piece
    opened = runs.groupBy(*piece).agg(F.max("local").alias("n"))
    earlier = Window.partitionBy("conv_id", "own").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    opened = saved(opened.select(*piece, F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "opened")
    same = [runs[c].eqNullSafe(opened[c]) for c in piece]
    runs = runs.join(opened, same[0] & same[1] & same[2]).select(
        runs["conv_id"], runs["own"], runs["part"], "role", "n_lines", "content",
        (F.col("before") + F.col("local") - 1).alias("turn"),
    )
    # a turn that goes on in the next piece is joined again
    parts = F.array_sort(F.collect_list(F.struct("part", "content")))
    return runs.groupBy("conv_id", "own", "turn").agg(
        F.first("role").alias("role"),
        F.sum("n_lines").alias("n_lines"),
        F.array_join(F.transform(parts, lambda x: x["content"]), "\n").alias("content"),
    ).drop("own")


def raw_turns(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text`` as a careless export would write them.

    Five styles of marker, by conversation; in the last, one turn in seven has none.
    A NULL role is written without a marker.
    """
    style = F.pmod(F.xxhash64("conv_id"), F.lit(5))
    lost = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(7)) == 0
    other = F.when(F.col("role") == "user", F.lit("Human")).when(F.col("role") == "assistant", F.lit("AI"))
    short = F.when(F.col("role") == "user", F.lit("Q")).when(F.col("role") == "assistant", F.lit("A"))
    name = F.initcap("role")
    mark = (
        F.when(style == 0, F.concat(name, F.lit(": ")))
        .when(style == 1, F.concat(F.coalesce(other, name), F.lit(": ")))
        .when(style == 2, F.concat(F.lit("<|"), "role", F.lit("|>\n")))
        .when(style == 3, F.concat(F.lit("### "), name, F.lit(":\n")))
        .when(lost, F.lit("\n"))
        .otherwise(F.concat(F.coalesce(short, name), F.lit(": ")))
    )
    text = F.concat(F.coalesce(mark, F.lit("")), F.coalesce("text", F.lit("")))
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role", text.alias("text"))
