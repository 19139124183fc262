from collections import Counter
from pathlib import Path

import numpy as np
from tokenizers import Tokenizer

import corpus_pipeline
from beforehand.llm import packing, quality, queries

from . import test_mixing, test_quality, test_secrets, test_simhash
from .helpers import docs

PATH = queries.vocabulary()


def corpus():
    rows, labels = test_quality.labelled(150, 21)
    bits = [text for text, _ in test_secrets.pem_texts()[:10]] + ["xoxb-1234567890-" + "0123456789ab" * 2 + "-TAILSECRET", "token=abcdefgh"]
    out = []
    for i, body, lang, _, _ in rows:
        if i % 5 == 4:
            body = out[-1][1]
        elif i % 3 == 0:
            body = f"{body}\n{bits[i // 3 % len(bits)]}\n{body[::2]}"
        out.append((i, body, lang, "rare" if i % 6 == 0 else "big", len(body)))
    return out, labels


def brute(rows, model):
    """The five stages in plain Python, with the fitted model and the plan of the queues."""
    kept = []
    for r in rows:
        words, _, _, _, repeated = test_quality.brute(r[1])
        if words >= 50 and 100 * repeated <= 50 * words and quality.probability(model, r[1].encode()) >= quality.THRESHOLD:
            kept.append(r)
    groups = test_simhash.brute_groups([test_simhash.brute_print(r[1]) for r in kept])
    first = [r for i, r in enumerate(kept) if groups[i] == i]
    clean = [(i, test_secrets.without(t), lang, source, n) for i, t, lang, source, n in first]
    texts = {r[0]: r[1] for r in clean}
    mixed = [(key, i, copy, source) for i, source, _, copy, key in test_mixing.brute(clean)]
    reference = Tokenizer.from_file(PATH)
    ids = {i: reference.encode(t, add_special_tokens=False).ids + [packing.END_ID] for i, t in texts.items()}
    return kept, first, sorted(mixed), ids


def test_the_whole_pipeline(spark, tmp_path):
    rows, labels = corpus()
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, test_quality.LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    table = lambda name: spark.read.parquet(f"{tmp_path}/{name}.parquet")
    kept, first, mixed, ids = brute(rows, quality.fit(table("documents"), table("labels")))
    assert len(rows) > len(kept) > len(first) > 30 and len(mixed) > len({m[1] for m in mixed})
    got = corpus_pipeline.run(spark, str(tmp_path)).orderBy("sequence_id").collect()
    assert [r.sequence_id for r in got] == list(range(len(got))) and {len(r.ids) for r in got} == {4 * 2048}

    # every copy of the mixing decodes from the sequences
    held = {}
    for r in got:
        own = np.frombuffer(r.ids, "<u4").tolist()
        assert sum(p.length for p in r.pieces) == r.n_tokens and (r.n_tokens == 2048 or r is got[-1])
        for p in r.pieces:
            held.setdefault((p.doc_id, p.copy, p.source), {})[p.start] = own[p.offset : p.offset + p.length]
    joined = {k: [x for start in sorted(v) for x in v[start]] for k, v in held.items()}
    assert joined == {(i, copy, source): ids[i] for _, i, copy, source in mixed}
    clean, decode = {r[0]: test_secrets.without(r[1]) for r in first}, Tokenizer.from_file(PATH).decode
    assert all(decode(x[:-1], skip_special_tokens=False) == clean[i] for (i, _, _), x in joined.items())

    # windows hold the sources as the whole does
    totals = Counter()
    for (_, _, source), x in joined.items():
        totals[source] += len(x)
    for r in got[:-1]:
        for source, n in totals.items():
            size = sum(p.length for p in r.pieces if p.source == source)
            assert abs(size - 2048 * n / sum(totals.values())) <= 3


def test_what_stages_leave_is_deleted(spark, tmp_path, monkeypatch):
    rows, labels = corpus()
    docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, test_quality.LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = set(shared.iterdir())
    corpus_pipeline.run(spark, str(tmp_path)).count()
    assert [p.name.split("-")[0] for p in set(shared.iterdir()) - before] == ["packing"]
