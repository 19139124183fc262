"""Secret scans: a trigram index names the texts that can match a rule, and the rule is run on those."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved
from .grams import ANY, Query, query

BLOCK = 512
MASK_BITS = 60
REDACTED = "[REDACTED]"


class Rule(NamedTuple):
    """A pattern; ``group`` of a match must have ``least`` characters, or the match is dropped.

    ``strict`` is the pattern to redact by, where the two differ: with that length inside, as a dropped
    match still hides what overlaps it, or with all of a secret of which ``pattern`` is only the start.
    """

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    strict: str | None = None


_NAMED = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
# The base rules, in the order of their kinds. Runs of one class are matched whole, so
# the least length of the second and third stands in the pattern.
BASE = (
    Rule("assign", _NAMED + "([A-Za-z0-9+/_.=-]+)", 2, 6, _NAMED + "([A-Za-z0-9+/_.=-]{6,})"),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
_PEM = "-----BEGIN [A-Z ]*PRIVATE KEY-----"
_GAP = r"""(?:[\s"'>#*|,+]|\\[nrt])*+"""
# To the END line if there is one before the next such line. Otherwise headers, lines of a key's characters, and
# the run after them, which may be its last line. Loops are possessive: Java's others recurse on long texts.
_PEM_BLOCK = (
    _PEM + r"(?:[^-]*+(?:-(?!----)[^-]*+)*+-----END [A-Z ]*PRIVATE KEY-----"
    r"|(?:\s*+(?:Proc-Type|DEK-Info):\s*+\S++)*+"
    rf"(?:(?:{_GAP}[A-Za-z0-9+/=]{{24,}}+)++(?:{_GAP}[A-Za-z0-9+/=]++)?+)?+)"
)
# Forms that issuers publish.
MORE = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{20,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", _PEM, strict=_PEM_BLOCK),
)
RULES = BASE + MORE


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """The inverted index over ``grams``: ``gram`` (its number)``, doc_id``, one row a list entry.

    Written where it is made, by the task that read the text: texts are searched for grams once, and a list
    that names a third of all texts spans many files. Case is ignored.
    """
    low = docs.where("doc_id is not null").select("doc_id", F.lower("text").alias("low"))
    numbered = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(g).alias("g")) for i, g in enumerate(grams)])
    held = F.filter(numbered, lambda x: F.contains(F.col("low"), x["g"]))
    rows = low.select("doc_id", F.explode(held).alias("x")).select(F.col("x.i").alias("gram"), "doc_id")
    return saved(rows, "postings")


def candidates(index: DataFrame, grams: list[str], queries: dict[str, Query]) -> DataFrame:
    """``doc_id`` and a boolean for each kind in ``queries``: lists intersected and united per text.

    Entries of one text meet as bits of a mask, combined before the shuffle. Only texts that
    satisfy some query are returned. Repeated ids count as one text: a superset, as matches are
    verified later.
    """
    number = {g: i for i, g in enumerate(grams)}
    n_masks = -(-len(grams) // MASK_BITS)
    gram = F.col("gram")
    masks = [
        F.bit_or(
            F.when((gram >= k * MASK_BITS) & (gram < (k + 1) * MASK_BITS), F.call_function("shiftleft", F.lit(1).cast("long"), gram - k * MASK_BITS))
            .otherwise(F.lit(0).cast("long"))
        ).alias(f"_m{k}")
        for k in range(n_masks)
    ]
    met = index.groupBy("doc_id").agg(*masks)
    flags = {}
    for kind, q in queries.items():
        flag = F.lit(False)
        for need in sorted(map(sorted, q)):
            every = F.lit(True)
            for k in range(n_masks):
                bits = sum(1 << (number[g] - k * MASK_BITS) for g in need if number[g] // MASK_BITS == k)
                if bits:
                    every = every & (F.col(f"_m{k}").bitwiseAND(F.lit(bits).cast("long")) == bits)
            flag = flag | every
        flags[kind] = flag
    met = met.select(F.col("doc_id").alias("_id"), *[f.alias(f"_may_{kind}") for kind, f in flags.items()])
    some = F.lit(False)
    for kind in flags:
        some = some | F.col(f"_may_{kind}")
    return saved(met.where(some), "candidates")


def _starts(sizes: Column) -> Column:
    """Running sums of an array: block totals first, then inside each block, so no long array is copied for each element."""
    n = F.size(sizes)
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice(sizes, b * BLOCK + 1, F.lit(BLOCK)), F.lit(0).cast("long"), lambda a, x: a + x),
    )
    before = F.aggregate(
        blocks,
        F.array(F.lit(0).cast("long")),
        lambda done, x: F.concat(done, F.array(F.element_at(done, -1) + x)),
    )
    return before


def _spans(df: DataFrame, rule: Rule, number: int, may: Column) -> DataFrame:
    """``df`` and ``_s<number>``: the rule's spans in order, as (start, number, stop) in code points.

    Built-in functions return matches and the text between them, but no places: a match
    starts where the pieces before it end.
    """
    found, kept, sizes, before = f"_f{number}", f"_k{number}", f"_z{number}", f"_b{number}"
    text, none = F.coalesce("text", F.lit("")), F.array().cast("array<string>")
    df = df.withColumn(found, F.when(may, F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))).otherwise(none))
    some = F.size(found) > 0
    group = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else F.col(found)
    df = df.withColumn(kept, F.when(some, group).otherwise(none))
    pieces = F.when(some, F.split(text, rule.pattern, -1)).otherwise(none)
    # from the end of a match's predecessor to its own start, and the predecessor itself
    df = df.withColumn(sizes, pieces).withColumn(
        sizes,
        F.transform(
            F.slice(sizes, F.lit(1), F.size(found)),
            lambda p, i: (F.length(p) + F.when(i > 0, F.length(F.get(F.col(found), i - 1))).otherwise(0)).cast("long"),
        ),
    )
    df = df.withColumn(before, F.when(some, _starts(F.col(sizes))))
    start = lambda i: F.get(F.col(before), F.floor(i / BLOCK).cast("int")) + F.aggregate(
        F.slice(F.col(sizes), F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK + 1),
        F.lit(0).cast("long"),
        lambda a, x: a + x,
    )
    spans = F.transform(
        F.col(found),
        lambda m, i: F.struct(
            start(i).alias("start"),
            F.lit(number).alias("kind"),
            F.length(m).cast("long").alias("size"),
            (F.length(F.get(F.col(kept), i)) >= rule.least).alias("ok"),
        ),
    )
    spans = F.filter(spans, lambda s: s["ok"])
    spans = F.transform(
        spans,
        lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), (s["start"] + s["size"]).alias("stop")),
    )
    return df.withColumn(f"_s{number}", spans).drop(found, kept, sizes, before)


def _marked(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``docs`` and, for each rule that trigrams narrow down, whether a text may match it."""
    queries = {r.kind: q for r in rules if (q := query(r.pattern)) != ANY}
    grams = sorted({g for q in queries.values() for need in q for g in need})
    if not grams:
        return docs
    met = candidates(postings(docs, grams), grams, queries)
    docs = docs.join(met, docs["doc_id"] == met["_id"], "left")
    unknown = F.col("doc_id").isNull()  # in no list: searched in full
    for kind in queries:
        docs = docs.withColumn(f"_may_{kind}", unknown | F.coalesce(f"_may_{kind}", F.lit(False)))
    return docs.drop("_id")


def _may(df: DataFrame, rule: Rule) -> Column:
    name = f"_may_{rule.kind}"
    return F.col(name) if name in df.columns else F.lit(True)


def _told(spans: Column, rules: tuple[Rule, ...]) -> Column:
    names = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))),
        ",",
    )


def scan(docs: DataFrame, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_sha256, spans`` of every whole text.

    Spans are ``kind:start:stop`` in code points, by start, then in the order of the rules;
    ``base_sha256`` is over those of the base rules alone. NULL and empty texts have none.
    A NULL doc_id is in no posting list, and its text is searched for every rule.
    """
    rules = BASE + more
    df = _marked(docs.select("doc_id", "text"), rules)
    for i, rule in enumerate(rules):
        df = _spans(df, rule, i, _may(df, rule))
    df = df.withColumn("_base", F.array_sort(F.concat(*[F.col(f"_s{i}") for i in range(len(BASE))])))
    every = F.array_sort(F.concat(*[F.col(f"_s{i}") for i in range(len(rules))]))
    return df.select(
        "doc_id",
        *[F.size(f"_s{i}").cast("long").alias(f"n_{r.kind}") for i, r in enumerate(BASE)],
        F.sha2(_told(F.col("_base"), rules), 256).alias("base_sha256"),
        _told(every, rules).alias("spans"),
    )


def _cut(df: DataFrame) -> DataFrame:
    """``df`` with the union of ``_every``, spans by start, replaced in ``text``.

    What stays lies between the furthest stop so far and the next start. Stops and pieces are taken block
    by block, so no long array or text is gone through for each span.
    """
    every, text = F.col("_every"), F.col("text")
    numbers = lambda spans: F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / BLOCK).cast("int"))
    block = lambda spans, b: F.slice(spans, b * BLOCK + 1, F.lit(BLOCK))
    furthest = lambda spans: F.array_max(F.transform(spans, lambda s: s["stop"]))
    part = lambda t, start, stop: t.substr((start + 1).cast("int"), (stop - start).cast("int"))
    some = F.size(every) > 0
    reach = F.aggregate(
        F.transform(numbers(every), lambda b: furthest(block(every, b))),
        F.array(F.lit(0).cast("long")),
        lambda done, x: F.concat(done, F.array(F.greatest(F.element_at(done, -1), x))),
    )
    df = df.withColumn("_reach", F.when(some, reach))
    before = lambda i: F.greatest(
        F.get(F.col("_reach"), F.floor(i / BLOCK).cast("int")),
        furthest(F.slice(every, F.floor(i / BLOCK).cast("int") * BLOCK + 1, i % BLOCK)),
    )
    stays = F.transform(every, lambda s, i: F.struct(before(i).alias("start"), s["start"].alias("stop")))
    df = df.withColumn("_stays", F.when(some, F.filter(stays, lambda c: c["start"] <= c["stop"])))
    stays = F.col("_stays")
    blocks = F.transform(numbers(stays), lambda b: block(stays, b))
    blocks = F.transform(
        blocks,
        lambda own: F.struct(
            own.alias("own"),
            F.get(own, 0)["start"].alias("from"),
            part(text, F.get(own, 0)["start"], F.element_at(own, -1)["stop"]).alias("text"),
        ),
    )
    pieces = F.transform(
        blocks,
        lambda x: F.array_join(
            F.transform(x["own"], lambda c: F.concat(part(x["text"], c["start"] - x["from"], c["stop"] - x["from"]), F.lit(REDACTED))), ""
        ),
    )
    tail = part(text, F.element_at("_reach", -1), F.length(text))
    return df.withColumn("text", F.when(some, F.concat(F.array_join(pieces, ""), tail)).otherwise(text))


def redact(docs: DataFrame, more: tuple[Rule, ...] = MORE) -> DataFrame:
    """``docs`` with every match in ``text`` replaced; ``n_chars``, if it is there, counts the new text.

    Texts that the index rules out for a rule are not searched for it. All rules are run on the text as
    it came, and what any of them finds, or its strict form, goes: a match cannot break another.
    """
    rules = BASE + more
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    # as one column, so that no name of theirs can clash
    packed = F.struct(*rest) if rest else F.struct(F.lit(0))
    df = _marked(docs.select("doc_id", "text", packed.alias("_rest")), rules)
    runs = [(r, r) for r in rules] + [(r, r._replace(pattern=r.strict, group=0, least=1)) for r in rules if r.strict]
    for i, (rule, run) in enumerate(runs):
        df = _spans(df, run, i, _may(df, rule))
    df = _cut(df.withColumn("_every", F.array_sort(F.concat(*[F.col(f"_s{i}") for i in range(len(runs))]))))
    out = {c: F.col("_rest").getField(c).alias(c) for c in rest} | {c: F.col(c) for c in ("doc_id", "text")}
    if "n_chars" in rest:
        out["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType).alias("n_chars")
    return df.select(*[out[c] for c in docs.columns])
