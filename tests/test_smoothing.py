"""Kneser-Ney and deleted interpolation against plain versions."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from charloom.operators import ngrams, smoothing
from charloom.session import stage

TEXTS = ["the cat sat on the mat", "abab", "a", "", "今天天气很好", "x😀y😀z", "that hat is the fat cat's", "then the other bather", None]
HELD = ["the hat that sat", "bad cat 今天 zq", "other", "", None]


def counts_of(spark, texts, n):
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    return stage(ngrams.order_counts(ngrams.full_gram_counts(df, n), n), "t")


def plain_counts(texts, n):
    return Counter(t[i : i + o] for o in range(1, n + 1) for t in texts if t for i in range(len(t) - o + 1))


def plain_kneser_ney(texts, n):
    c = plain_counts(texts, n)
    lefts = {g: {x[0] for x in c if len(x) == len(g) + 1 and x[1:] == g} for g in c}
    fronts = {t[:k] for t in texts if t for k in range(1, n + 1)}
    a = {g: c[g] if len(g) == n else len(lefts[g]) + (g in fronts) for g in c}
    d = {}
    for o in range(1, n + 1):
        t = [sum(v == j for g, v in a.items() if len(g) == o) for j in range(5)]
        y = t[1] / (t[1] + 2 * t[2]) if t[1] else 0.5
        for j in (1, 2, 3):
            d[o, j] = min(max(j - (j + 1) * y * t[j + 1] / t[j] if t[j] else y, 0), j)
    v = len({g for g in c if len(g) == 1})

    def p(gram):
        if not gram:
            return 1 / v
        own = {g: x for g, x in a.items() if len(g) == len(gram) and g[:-1] == gram[:-1]}
        total = sum(own.values())
        if not total:
            return p(gram[1:])
        off = {g: d[len(g), min(x, 3)] for g, x in own.items()}
        return (own[gram] - off[gram] if gram in own else 0) / total + sum(off.values()) / total * p(gram[1:])

    return p


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_kneser_ney_equals_a_plain_version(spark, n):
    model = smoothing.kneser_ney(counts_of(spark, TEXTS, n), n)
    plain = plain_kneser_ney(TEXTS, n)
    asked = [q[-n:] for q in ["the c", "a", "zthe ", "今天天气很", "Qqqqq", "hat", "t", "😀", "ab"]]
    got = {r["g"]: r["p"] for r in smoothing.kneser_ney_probs(model, spark.createDataFrame([(q,) for q in asked], "g string")).collect()}
    assert got == {q: pytest.approx(plain(q), abs=1e-12) for q in asked}


@pytest.mark.parametrize("n", [2, 3])
def test_kneser_ney_sums_to_one(spark, n):
    model = smoothing.kneser_ney(counts_of(spark, TEXTS, n), n)
    letters = sorted({c for t in TEXTS if t for c in t})
    asked = spark.createDataFrame([(x[-(n - 1) :] + y,) for x in ("th", "at", "zz", "很好") for y in letters], "g string")
    sums = smoothing.kneser_ney_probs(model, asked).groupBy(ngrams.context(F.col("g"))).agg(F.sum("p").alias("p")).collect()
    assert [r["p"] for r in sums] == pytest.approx([1.0] * len(sums))


def test_the_front_of_a_text_is_a_neighbour(spark):
    got = {r["g"]: r["a"] for r in smoothing.continuation_counts(counts_of(spark, ["ab", "cab", "xb"], 2), 2).collect()}
    assert got == {"a": 2, "b": 2, "c": 1, "x": 1, "ab": 2, "ca": 1, "xb": 1}


def test_discounts_without_evidence():
    assert smoothing.discounts({}) == (0.5, 0.5, 0.5)
    one = smoothing.discounts({1: 10, 2: 4, 3: 2, 4: 1})
    y = 10 / 18
    assert one == pytest.approx((1 - 2 * y * 4 / 10, 2 - 3 * y * 2 / 4, 3 - 4 * y * 1 / 2))
    assert smoothing.discounts({1: 1, 2: 100, 3: 1})[0] == pytest.approx(1 - 200 / 201)


def plain_components(c, v, gram, n):
    totals = Counter()
    for g, x in c.items():
        totals[len(g), g[:-1]] += x
    out, bucket = [1 / v], 0
    for o in range(1, n + 1):
        g = gram[-o:]
        t = totals[o, g[:-1]] if len(gram) >= o else 0
        out.append(c[g] / t if t else out[-1])
        if o == n and t:
            bucket = len(str(t))
    return out, bucket


def plain_em(texts, held, n, rounds):
    c = plain_counts(texts, n)
    v = sum(len(g) == 1 for g in c)
    grams = Counter(t[max(0, i - n + 1) : i + 1] for t in held if t for i in range(len(t)))
    rows = [(*plain_components(c, v, g, n), x) for g, x in grams.items()]
    weights = {b: [1 / (n + 1)] * (n + 1) for _, b, _ in rows}
    seen = []
    for r in range(rounds + 1):
        p = [sum(w * q for w, q in zip(weights[b], parts, strict=True)) for parts, b, _ in rows]
        seen.append(sum(x * math.log(q) for (_, _, x), q in zip(rows, p, strict=True)))
        if r == rounds:
            break
        new = {b: [0.0] * (n + 1) for b in weights}
        for (parts, b, x), q in zip(rows, p, strict=True):
            for o in range(n + 1):
                new[b][o] += x * weights[b][o] * parts[o] / q
        weights = {b: [y / sum(w) for y in w] for b, w in new.items()}
    return weights, seen


@pytest.mark.parametrize("n", [1, 2, 3])
def test_learnt_weights_equal_a_plain_version(spark, n):
    counts = counts_of(spark, TEXTS, n)
    held = ngrams.full_gram_counts(spark.createDataFrame([(t,) for t in HELD], "text string"), n)
    got = smoothing.deleted_interpolation(held, counts, n, rounds=6, tolerance=-1)
    weights, seen = plain_em(TEXTS, HELD, n, 6)
    assert got.weights == {b: pytest.approx(w) for b, w in weights.items()}
    assert got.likelihoods == pytest.approx(seen)
    assert all(a <= b + 1e-9 for a, b in zip(got.likelihoods, got.likelihoods[1:], strict=False))
    assert all(sum(w) == pytest.approx(1) for w in got.weights.values())


def test_learnt_weights_stop_and_sum_to_one(spark):
    counts = counts_of(spark, TEXTS, 3)
    held = ngrams.full_gram_counts(spark.createDataFrame([(t,) for t in HELD], "text string"), 3)
    got = smoothing.deleted_interpolation(held, counts, 3, rounds=200, tolerance=1e-3)
    assert len(got.likelihoods) < 60
    letters = sorted({c for t in TEXTS if t for c in t})
    asked = spark.createDataFrame([(c + x,) for c in ("th", "at", "zz") for x in letters], "g string")
    probs = smoothing.interpolated_probs(counts, 3, got, asked)
    sums = probs.groupBy(F.substring("g", 1, 2)).agg(F.sum("p").alias("p")).collect()
    assert [r["p"] for r in sums] == pytest.approx([1.0] * 3)
    assert smoothing.deleted_interpolation(held.limit(0), counts, 3) == smoothing.Interpolation({}, ())
