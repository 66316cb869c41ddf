"""Language identification: codes, classifiers against a plain version, held-out accuracy, edge cases."""

from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from charloom.llm import langcodes

SYLLABLES = {
    "en": ["the", "ing", "and", "th", "er", "ly", "wh", "ed"],
    "de": ["sch", "ung", "ich", "ein", "zu", "ß", "der", "ö"],
    "es": ["ción", "que", "los", "ñ", "ar", "osa", "el", "í"],
    "ru": ["при", "ть", "ого", "на", "ж", "сто", "ы", "ко"],
    "el": ["τον", "και", "ς", "μα", "ου", "θε", "ικ", "ά"],
    "tr": ["lar", "ı", "ğ", "ler", "dan", "ş", "yor", "bu"],
}


def sentence(r, lang, n):
    return " ".join("".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 3))) for _ in range(n))


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 6, 12, 60])
def test_codebooks_correct_errors(n):
    code = langcodes.codebook(n)
    assert code.shape[0] == n and (code == langcodes.codebook(n)).all()
    columns = {tuple(c * c[0]) for c in code.T.tolist() for c in [np.array(c)]}
    assert len(columns) == code.shape[1] and all(len(set(c)) == 2 for c in columns)
    apart = [int((code[i] != code[j]).sum()) for i in range(n) for j in range(i)]
    assert n < 2 or min(apart) >= (1 if n == 2 else 2 if n == 3 else 4)


def test_letters_and_grams():
    assert bytes(langcodes.letters("  Ab-1c. ").astype(np.uint8)) == b" ab c "
    assert not len(langcodes.letters(" 12 .!")) and not len(langcodes.letters(None))
    index, share = langcodes.features("abcabc", 17)
    assert share.sum() == pytest.approx(1, abs=1e-6) and (np.diff(index) > 0).all()
    # Every position ends one n-gram of each length that fits: " abcabc " has 8, 7 and 6.
    assert len(langcodes.grams(langcodes.letters("abcabc"), 17)) == 8 + 7 + 6


def test_a_long_text_is_read_whole(monkeypatch):
    r = random.Random(1)
    text = sentence(r, "de", 400)
    whole = langcodes.features(text, 12)
    model = langcodes.Model(["a", "b"], langcodes.codebook(2), np.random.default_rng(2).normal(size=(1 << 12, 1)).astype(np.float32), np.zeros(1), np.ones((2, 1)))
    margin = model.margins(text, 12)
    # The margin is the sparse dot product of shares and weights.
    assert margin[0] == pytest.approx(float(whole[1] @ model.weights[whole[0], 0]), rel=1e-4)
    monkeypatch.setattr(langcodes, "CHUNK", 50)
    again = langcodes.features(text, 12)
    # Pieces share the characters that a longer n-gram needs; single characters there count again.
    assert (again[0] == whole[0]).all() and np.abs(again[1] - whole[1]).sum() < 0.06


def test_decoding_takes_the_nearest_word_and_mends_a_wrong_bit():
    code = langcodes.codebook(4)
    model = langcodes.Model(list("abcd"), code, None, None, np.full(code.shape, 1 / code.shape[1]))
    for k in range(4):
        for wrong in range(code.shape[1]):
            margin = 3.0 * code[k]
            margin[wrong] *= -0.8
            got, score, close = model.decode(margin)
            plain = [np.mean([np.log1p(np.exp(-c * m)) for c, m in zip(word, margin, strict=True)]) for word in code]
            assert got == k == int(np.argmin(plain)) and 0.5 < score <= 1 and not close
    assert model.decode(np.zeros(code.shape[1]))[2]


def held(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 4 == 2


def test_held_out_accuracy_and_edges(spark):
    r = random.Random(4)
    langs = [*SYLLABLES, "en", "en"]
    data = [(i, sentence(r, lang := r.choice(langs), r.randint(4, 60)), lang) for i in range(900)]
    odd = [(None, "the ing", "en"), (9001, None, "en"), (9002, "", "xx"), (9003, " 12 !", "xx"), (9004, "the and " * 200_000, None)]
    odd += [(2**60 + 1, "ψ", None), (9001, None, "en")]
    docs = spark.createDataFrame(data + odd, "doc_id long, text string, lang string").withColumn("score", F.lit("x"))
    got = langcodes.identify(docs.repartition(3)).collect()
    assert len(got) == 907
    by = {g["doc_id"]: g for g in got}
    assert all(g["held_out"] == held(g["doc_id"]) and 0 <= g["score"] <= 1 for g in got)
    test = [by[i]["lang_pred"] == lang for i, _, lang in data if held(i)]
    assert len(test) > 150 and np.mean(test) > 0.97
    assert by[9001]["lang_pred"] == by[9002]["lang_pred"] == by[9003]["lang_pred"] == "und" and by[9001]["score"] == 0
    assert by[9004]["lang_pred"] == "en" and by[2**60 + 1]["lang_pred"] in SYLLABLES
    again = {g["doc_id"]: g["score"] for g in langcodes.identify(docs.repartition(7)).collect()}
    assert all(again[k] == g["score"] for k, g in by.items())


def test_held_out_languages_do_not_teach_and_few_languages(spark):
    rows = [(i, f"{'ab ba' if i % 2 else 'cd dc'} " * 5, "x" if i % 2 else "y") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    wrong = docs.withColumn("lang", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, "z").otherwise(F.col("lang")))
    one, two = (sorted(map(tuple, langcodes.identify(d).collect())) for d in (docs, wrong))
    assert one == two and all(p == x for (_, _, p, *_), (_, _, x) in zip(one, rows, strict=True))
    alone = langcodes.identify(docs.withColumn("lang", F.lit("q"))).select("lang_pred", "score").distinct().collect()
    assert [tuple(a) for a in alone] == [("q", 1.0)]
    none = langcodes.identify(docs.withColumn("lang", F.lit(None).cast("string"))).select("lang_pred", "score").distinct().collect()
    assert [tuple(a) for a in none] == [("und", 0.0)]
    assert langcodes.identify(docs.limit(0)).count() == 0
