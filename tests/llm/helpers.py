"""Small corpora for the text operators."""

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the and of to in a harbour lantern meadow copper thistle quarry velvet orchard ember willow".split()


def sentence(rng, n=9):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + "."


def text(rng, lines=6):
    return "\n".join(sentence(rng, rng.randint(3, 14)) for _ in range(lines))


def corpus(n=120, seed=1):
    """Rows with copies, near copies, NULLs, empty, blank and long texts, and one large source."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        body = text(rng, rng.randint(1, 12))
        if i % 7 == 3 and rows and rows[-1][1]:
            body = rows[-1][1]
        elif i % 11 == 5 and rows and rows[-1][1]:
            body = rows[-1][1] + " and more"
        rows.append((i * 3, body, "en" if i % 4 else "fr", "big" if i % 3 else f"s{i % 5}", len(body)))
    rows[5] = (15, None, None, None, None)
    rows[6] = (18, "", "en", "big", 0)
    rows[7] = (21, " \n\t ", "en", "s1", 4)
    rows[8] = (24, "Ünïcode wörds ärè hère. " * 5, "de", "s1", 120)
    rows.append((n * 3, text(rng, 900), "en", "big", 1))
    return rows


def docs(spark, rows=None, parts=4):
    rows = corpus() if rows is None else rows
    return spark.createDataFrame(rows, DOCS).repartition(parts) if rows else spark.createDataFrame([], DOCS)


def clashing(df):
    """``df`` with further columns named like those the operators make and use."""
    from pyspark.sql import functions as F

    names = (
        "fp component_id component fingerprint kind part start queue ids plan rate copies copy rank shard slot "
        "curve size kept quality spans payload low x gram source_id n _id _row shuffle_key"
    ).split()
    return df.select("*", *[F.lit(f"extra {n}").alias(n) for n in names if n not in df.columns])
