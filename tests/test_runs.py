"""Grams and tokens counted a run of texts at a time, against plain loops."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from charloom.operators import ngrams, runs

ALPHABETS = ["ab", "ab é\0\U0001f600x\n", "".join(map(chr, range(0x4E00, 0x8E00)))]


def some_texts(alphabet):
    draw = random.Random(3)
    return ["".join(draw.choice(alphabet) for _ in range(draw.choice([1, 2, 3, 5, 40]))) for _ in range(200)]


def total(counted):
    found = Counter()
    for strings, n in counted:
        for key, k in zip(zip(*strings, strict=True), n.tolist(), strict=True):
            found[key] += k
    return found


@pytest.mark.parametrize("alphabet", ALPHABETS)
@pytest.mark.parametrize("n", [1, 2, 3, 6])
def test_grams_of_a_run(monkeypatch, alphabet, n):
    monkeypatch.setattr(runs, "RUN_CHARS", 1000)
    texts = some_texts(alphabet)
    for heads in (True, False):
        want = Counter((t[max(0, i - n + 1) : i + 1],) for t in texts for i in range(len(t)) if heads or i >= n - 1)
        assert total(runs.grams(n, heads)(texts)) == want


@pytest.mark.parametrize("alphabet", ALPHABETS)
@pytest.mark.parametrize("cells", [1 << 22, 0])
def test_tokens_of_a_run(monkeypatch, alphabet, cells):
    monkeypatch.setattr(runs, "RUN_CHARS", 1000)
    monkeypatch.setattr(runs, "TABLE_CELLS", cells)
    monkeypatch.setattr(runs, "WALK", 100)
    texts = some_texts(alphabet)
    for words in ({x for t in texts if len(t) > 4 for x in (t[:2], t[1:4], t[:4], t[3:4])}, set()):
        for n in (1, 3):
            want = Counter()
            for t in texts:
                i = 0
                while i < len(t):
                    k = max((k for k in range(2, 5) if t[i : i + k] in words and i + k <= len(t)), default=1)
                    want[t[max(0, i - n + 1) : i], t[i : i + k]] += 1
                    i += k
            assert total(runs.tokens_in_context(sorted(words), n)(texts)) == want


def test_positions_collapse_before_they_are_rows(spark):
    """No plan has a row per text position: the scan hands on counted grams."""
    rows = [("en" if i % 3 else None, f"abc {i % 2}" * 50 if i % 7 else None) for i in range(100)]
    df = spark.createDataFrame(rows, "lang string, text string")
    got = ngrams.full_gram_counts(df, 3, by=["lang"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Generate" not in plan and "MapInArrow" in plan
    want = Counter((x, t[max(0, i - 2) : i + 1]) for x, t in rows if t for i in range(len(t)))
    assert {(r["lang"], r["g"]): r["cnt"] for r in got.collect()} == want
