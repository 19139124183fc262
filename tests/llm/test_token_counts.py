import random

import pytest
import sentencepiece

from beforehand.llm import queries, token_counts

from .helpers import DOCS, clashing, corpus, docs

PATH = queries.vocabulary("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)
# What may be special to such a vocabulary.
ODD = ["<s>", "</s>", "<unk>", "<0x0A>", "▁", "▁▁x", "\x00", "\t", "\r\n", "();\r", "　", "\xa0", "é", "漢字かな", "🙂🙃", "ﬁ", "①", " " * 40, "\n\n"]


def brute(text):
    return len(MODEL.encode(text or ""))


def total(text):
    found = token_counts.pre_tokens(text, PATH)
    return sum(n * u for n, u in zip(token_counts.piece_counts(list(found), PATH), found.values()))


@pytest.mark.parametrize("seed", range(40))
def test_counts_add_up(seed):
    rng = random.Random(seed)
    words = ["the", "naïve", "Straße", "x1", "if(a){", "});", "http://a.b/c?d=e", "don't", "1234567", "ТЕСТ", *ODD]
    text = "".join(rng.choice(words) + rng.choice(["", " ", "  ", "\n", "\t", " "]) for _ in range(rng.randint(0, 120)))
    text += "".join(chr(rng.choice([rng.randint(1, 0x2FF), rng.randint(0x370, 0xD7FF), rng.randint(0xE000, 0x1FFFF)])) for _ in range(60))
    assert total(text) == brute(text)


@pytest.mark.parametrize("text", ["", " ", "  ", "a", " a", "a ", "\n", "\n\n", "▁", "<s>", *ODD])
def test_short_texts(text):
    assert total(text) == brute(text)


def test_whole_table(spark, monkeypatch):
    rows = corpus(150)
    rows += [(None, "no id", None, None, None), rows[0], rows[0]]
    rows += [(900 + i, " ".join(ODD) + " long" * i, "en", "big", 1) for i in range(30)]
    rows.append((2000, "word " * 4096, "en", "big", 1))
    rows += [(2001 + i, "q" * 3000 + f" {i}", "en", "big", 1) for i in range(40)]
    monkeypatch.setattr(queries, "table", lambda *_: clashing(docs(spark, rows)))
    for common in (token_counts.COMMON, 40, 0):  # all pre-tokens sent to all tasks, some, none
        monkeypatch.setattr(token_counts, "COMMON", common)
        got = queries.op13_token_counts(spark, "").collect()
        want = [(r[0], len((r[1] or "").encode()), brute(r[1]), brute(r[1]) > 4096) for r in rows]
        key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2])
        assert sorted(map(tuple, got), key=key) == sorted(want, key=key)


def test_no_rows(spark):
    assert token_counts.token_counts(spark.createDataFrame([], DOCS), PATH).count() == 0


def test_very_long_text():
    text = ("Lantern  meadow, 漢字; x=1\n" * 300_000) + "z" * 100_000
    assert total(text) == brute(text)


def test_cut_in_parts(monkeypatch):
    text = "".join(random.Random(5).choice(["the ", "naïve", "  ", "x=1;", "\n", "漢", "aaaa", "});\r"]) for _ in range(400))
    whole = token_counts.pre_tokens(text, PATH)
    for size in (1, 2, 7, 100):
        monkeypatch.setattr(token_counts, "LONG", size)
        assert token_counts.pre_tokens(text, PATH) == whole


def test_a_vocabulary_that_rewrites_texts_is_refused(monkeypatch):
    class Rewriting(sentencepiece.SentencePieceProcessor):
        def normalize(self, text):
            return super().normalize(text).lower().replace("ﬁ", "fi")

    monkeypatch.setattr(sentencepiece, "SentencePieceProcessor", Rewriting)
    monkeypatch.setattr(token_counts, "_loaded", {})
    with pytest.raises(ValueError, match="rewrites"):
        token_counts.pre_tokens("a", PATH)
