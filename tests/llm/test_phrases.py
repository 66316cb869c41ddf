"""Phrase mining: automata against plain counts, the operator against a plain version."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from charloom.llm import phrases
from charloom.llm.automata import Transducer, distinct, union

GRAMS = st.lists(st.lists(st.integers(1, 5), min_size=1, max_size=4).map(tuple), max_size=60)


def matrix(grams):
    return np.array([[*g, *[0] * (4 - len(g))] for g in grams], np.int32).reshape(-1, 4)


def built(grams):
    rows, counts, _ = distinct(matrix(grams), np.ones(len(grams), np.int64))
    return Transducer.build(rows, counts), rows, counts


@settings(max_examples=150, deadline=None)
@given(GRAMS, GRAMS)
def test_automata_count_prefixes_and_unite(one, two):
    a, rows, counts = built(one)
    b, _, _ = built(two)
    again = Transducer.unpack(a.pack())
    assert (again.grams() == rows).all() and (again.weight == counts).all()
    asked = [g for g in {*one, *two, (1,), (5, 5), (2, 3, 4, 5)}]
    want = [sum(g[: len(q)] == q for g in one) for q in asked]
    assert again.compose(matrix(asked)).tolist() == want
    both, sums, places = union([again, b], 4)
    plain = Counter(one) + Counter(two)
    assert {tuple(x for x in r if x): n for r, n in zip(both.tolist(), sums.tolist(), strict=True)} == plain
    assert (both[places[0]] == rows).all()


def test_equal_futures_are_one_state():
    a, _, _ = built([(x, y, 7, 8) for x in range(1, 40) for y in (1, 2, 3)])
    assert len(a.final) == 5


def plain(docs, least, covered, top):
    f, n = defaultdict(Counter), Counter()
    for text, lang in docs:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in (1, 2, 3, 4):
                f[lang or "und"].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in found.items():
            around = [b for q, b in found.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))]
            if any(100 * b >= covered * a for b in around):
                continue
            score, _, l, r = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), l, r))
        for i, (s, a, p, l, r) in enumerate(sorted(rows)[:top]):
            out.append((lang, i + 1, p.decode(), -a, l, r, n[lang], -s))
    return sorted(out)


def corpus():
    r = random.Random(3)
    words = ["New", "york", "É", "é", "a\xa0b", "the", "of", "x", "\x1c", "don't", "日本"]
    docs = []
    for _ in range(500):
        run = [r.choice(words) for _ in range(r.randint(0, 30))]
        if r.random() < 0.5:
            run += ["new", "york", "city", "hall"]
        sep = r.choice([" ", "  ", "\t", " "])
        text = "".join(w + (r.choice([". ", ",", "\n", "\x0b", "! "]) if r.random() < 0.15 else sep) for w in run)
        docs.append((text, r.choice(["en", "en", "en", "fr", None, "und"])))
    docs += [(None, "en"), ("", "en"), (" \t ", None), (".,;:", "fr"), (None, None), ("lone words only here", "rare")]
    docs += [("The copy of a copy of THE copy. " * 400, "en")] + [("same same same row", "de")] * 40
    return docs


@pytest.mark.parametrize("shard_bytes, range_words", [(1 << 30, 1 << 30), (2_000, 500), (1, 50)])
def test_mined_phrases_equal_a_plain_version(spark, shard_bytes, range_words):
    docs = corpus()
    if shard_bytes == 1:
        docs = docs[:60] + docs[-41:]
    df = spark.createDataFrame([(t, x, 1, "p") for t, x in docs], "text string, lang string, f int, phrase string")
    got = phrases.mine_phrases(df.repartition(3), least=12, top=40, shard_bytes=shard_bytes, range_words=range_words)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == plain(docs, 12, 80, 40)


def test_tables_without_candidates(spark):
    df = spark.createDataFrame([("a b c", "en")], "text string, lang string")
    assert phrases.mine_phrases(df).count() == 0
    assert phrases.mine_phrases(df.limit(0)).count() == 0
    assert phrases.mine_phrases(spark.createDataFrame([(None, None)], df.schema)).count() == 0
