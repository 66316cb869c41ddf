"""Phrases of several words: the automaton against a plain search."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from charloom.operators import topics


def plain(text, phrases):
    found = [w for w in re.split(r"[^\w]|_", (text or "").lower()) if w]
    out = []
    for i, p in enumerate(phrases):
        want = p.lower().split()
        at = [j for j in range(len(found)) if found[j : j + len(want)] == want]
        if at:
            out.append((i, len(at), at[0]))
    return out


def test_hits_equal_a_plain_search(spark):
    r = random.Random(5)
    vocabulary = ["a", "b", "ab", "ba", "é", "日本", "x1"]
    phrases = ["a", "a b", "a b a", "b a", "ab", "É", "日本 a", "x1 x1"]
    texts = ["".join(r.choice(vocabulary).upper() if r.random() < 0.2 else r.choice(vocabulary) + r.choice([" ", ", ", "\n", "-", "  "])
                     for _ in range(r.randint(0, 60))) for _ in range(200)]
    texts += [None, "", " \n", "...", "a b a b a", "A-B,a", "abab " * 20_000, "x1 x1 x1"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string").repartition(6)
    got = df.select("i", topics.phrase_hits(F.col("text"), phrases).alias("h")).collect()
    assert {x["i"]: [tuple(h) for h in x["h"]] for x in got} == {i: plain(t, phrases) for i, t in enumerate(texts)}


def test_topics_overlap_and_weigh(spark):
    named = {"one": ["a b", "c"], "two": ["B", "a  b"], "none": ["zz top"]}
    df = spark.createDataFrame([(1, "A b, c"), (2, "c"), (3, "ab"), (4, None), (5, "b b")], "i int, text string")
    got = {r["i"]: r["topic_hits"] for r in topics.topic_hits(df, named).collect()}
    assert got == {1: {"one": 2, "two": 2}, 2: {"one": 1}, 3: {}, 4: {}, 5: {"two": 2}}
    ids = lambda d: sorted(r["i"] for r in d.collect())
    assert ids(topics.topic_filter(df, named)) == [3, 4] and ids(topics.topic_filter(df, named, "keep")) == [1, 2, 5]
    weights = topics.topic_filter(df, named, "weight", {"one": 0.5, "two": 0.25, "none": 0.0})
    assert {r["i"]: r["weight"] for r in weights.collect()} == {1: 0.25, 2: 0.5, 3: 1.0, 4: 1.0, 5: 0.25}
    assert ids(topics.topic_filter(df, {})) == [1, 2, 3, 4, 5]
    assert topics.topic_filter(df.limit(0), named).count() == 0
    for bad in (["a", "A "], ["!"]):
        with pytest.raises(ValueError):
            topics.phrase_hits(F.col("text"), bad)
