"""Tokens of varying length against a plain longest match."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from charloom.operators import ngrams, predict, tokens


def cut(text, vocabulary):
    out, at = [], 0
    while at < len(text or ""):
        size = next((n for n in range(8, 1, -1) if len(text) - at >= n and text[at : at + n] in vocabulary), 1)
        out.append(text[at : at + size])
        at += size
    return out


def sample():
    r = random.Random(2)
    alphabet = ["a", "b", "c", ".", "*", "\\", "\n", " ", "é", "日", "🙂", "]", "-"]
    strings = ["".join(r.choice(alphabet) for _ in range(r.randint(2, 5))) for _ in range(60)]
    texts = ["".join(r.choice(alphabet + strings) for _ in range(r.randint(0, 40))) for _ in range(150)]
    return sorted(set(strings)), [*texts, None, "", "abab" * 30_000]


def test_longest_match_equals_a_plain_search(spark):
    vocabulary, texts = sample()
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(5)
    got = {r["i"]: r["w"] for r in df.select("i", tokens.longest_match(F.col("text"), vocabulary).alias("w")).collect()}
    assert got == {i: cut(t, set(vocabulary)) for i, t in enumerate(texts)}
    alone = df.select("i", tokens.longest_match(F.col("text"), []).alias("w")).collect()
    assert {r["i"]: r["w"] for r in alone} == {i: list(t or "") for i, t in enumerate(texts)}


@pytest.mark.parametrize("n", [1, 2, 4])
def test_counts_and_model_equal_plain_ones(spark, n):
    vocabulary, texts = sample()
    df = spark.createDataFrame([(t, i % 2) for i, t in enumerate(texts)], "text string, side int")
    want = Counter()
    for i, t in enumerate(texts):
        before = ""
        for token in cut(t, set(vocabulary)):
            full = before[-(n - 1) :] if n > 1 else ""
            for k in range(len(full) + 1):
                want[(i % 2, full[len(full) - k :], token)] += 1
            before += token
    got = tokens.token_counts(df, vocabulary, n, by=["side"])
    assert {(r["side"], r["ctx"], r["token"]): r["cnt"] for r in got.collect()} == want

    mass = {}
    totals = Counter()
    for (_, ctx, _), c in want.items():
        totals[ctx] += c
    for (_, ctx, token), c in want.items():
        shown = token.strip()
        if shown:
            mass.setdefault(ctx, Counter())[shown[0]] += c / totals[ctx]
    model = tokens.token_model(df, vocabulary, n)
    tops = {r["ctx"]: r["tops"] for r in model.topk.collect()}
    assert set(tops) == set(mass)
    for ctx, best in mass.items():
        ranked = sorted(best, key=lambda ch: (-round(math.log(best[ch]), 9), ch))
        assert tops[ctx] == ranked[:3]


def test_vocabulary_and_route(spark):
    df = spark.createDataFrame([("the then the",), ("日本語日本語",), (None,), ("",)], "text string")
    counts = ngrams.order_counts(ngrams.full_gram_counts(df, 4), 4)
    chosen = [(r["token"], r["cnt"]) for r in tokens.token_vocabulary(counts, 4).collect()]
    assert chosen == [("he", 3), ("th", 3), ("the", 3), (" t", 2)]
    model = tokens.token_model(df, [t for t, _ in chosen] + ["日本語"], 3)
    asked = spark.createDataFrame([(1, "x日本語", False), (2, "", False), (3, "the ", False)], "pos int, text string, is_english boolean")
    got = {r["pos"]: r["pred"] for r in predict.route_predict(asked, model, model).collect()}
    assert got[1][0] == "日" and got[2] == predict.TOKEN_EMPTY_GUESS and got[3][0] == "t"
    assert tokens.token_counts(df.limit(0), ["ab"], 3).count() == 0
