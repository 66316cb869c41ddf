"""Quality, toxicity and text scoring: brute force, held-out accuracy, edge cases."""

from __future__ import annotations

import itertools
import math
import random
import tracemalloc
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from charloom.llm import ppm, quality, toxicity


def held(key, n):
    return zlib.crc32(("" if key is None else str(key)).encode()) % n


# --- quality ----------------------------------------------------------------------------------------


def prose(r, n):
    return " ".join(r.choice(["and", "the", "river", "house", "walked", "slowly", "Night.", "over"]) for _ in range(n))


def junk(r, n):
    kind = r.randint(0, 2)
    if kind == 0:
        return " ".join([r.choice(["spam", "buy", "Que"])] * n)
    return " ".join(f"w{r.randint(0, 999)}{'###' if kind == 1 else '!!'}" for _ in range(n))


def test_quality_held_out_accuracy_and_edges(spark):
    r = random.Random(5)
    data = [(i, prose(r, r.randint(10, 80)) if i % 4 else junk(r, r.randint(10, 80)), int(i % 4 > 0)) for i in range(600)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, quality int")
    odd = spark.createDataFrame([(None, "x"), (9000, None), (9001, ""), (9002, " \t"), (9003, "a " * 100_000), (9001, ""), (2**60 + 1, "y")], docs.schema)
    labels = labels.union(spark.createDataFrame([(None, 1), (1, None), (2, 0), (2, 1)], labels.schema))
    got = quality.score_quality(docs.union(odd).withColumn("score", F.lit(1)), labels).collect()
    by = {g["doc_id"]: g for g in got}
    assert len(got) == 607 and 2**60 + 1 in by and all(0 <= g["score"] <= 1 and g["predicted"] == int(g["score"] >= 0.3) for g in got)
    assert all(g["held_out"] == (held(g["doc_id"], 5) == 0) for g in got)
    test = [(by[i]["predicted"], y) for i, _, y in data if held(i, 5) == 0]
    assert len(test) > 80 and np.mean([p == y for p, y in test]) > 0.95
    assert by[9000]["score"] == by[9001]["score"] == by[9002]["score"]
    none = quality.score_quality(docs.limit(5), labels.limit(0)).collect()
    assert {g["score"] for g in none} == {0.5}
    assert quality.score_quality(docs.limit(0), labels).count() == 0


def test_labels_of_held_out_rows_do_not_teach(spark):
    docs = spark.createDataFrame([(i, f"t{i % 2} " * 5) for i in range(100)], "doc_id long, text string")
    y = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("doc_id") % 2).otherwise(F.col("doc_id") % 2)
    a = docs.select("doc_id", y.cast("int").alias("quality"))
    b = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"))
    first, second = (sorted(map(tuple, quality.score_quality(docs, x).collect())) for x in (a, b))
    assert first == second


def test_quality_scores_depend_on_the_ratio_of_classes_and_not_on_their_size(spark, monkeypatch):
    r = random.Random(9)
    # Texts that do not tell the classes apart: a score is the share of the class.
    data = [(i, " ".join(r.choice(["and", "the", "over", "river"]) for _ in range(r.randint(3, 30))), int(i % 7 == 0)) for i in range(2100)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, quality int")
    sampled = quality.labelled_sample

    def scores(size, per_class):
        # The same sample of classes ``size`` times as large has shares of one in ``size``.
        def larger(*a, **k):
            return sampled(*a, **k).withColumn("share", F.col("share") / size)

        monkeypatch.setattr(quality, "labelled_sample", larger)
        return {g["doc_id"]: g["score"] for g in quality.score_quality(docs, labels, per_class=per_class).collect()}

    small, large = scores(1, 250), scores(5000, 250)
    assert all(large[k] == pytest.approx(s, abs=1e-6) for k, s in small.items())
    # A sample of as many rows of both classes knows that one has six times the rows of the other, log-odds of 1.8.
    odds = lambda got: np.mean([math.log(s / (1 - s)) for s in got.values()])
    assert odds(scores(1, 10_000)) == pytest.approx(odds(large), abs=0.6)
    assert odds(large) < -1.2


def test_features_are_unit_vectors_and_ftrl_learns():
    make = quality.Features(12)
    index, value = make("Aa bb bb 12")
    assert index[-1] == 0 and np.dot(value[:-1], value[:-1]) == pytest.approx(1, rel=1e-5)
    assert quality.shape("HeLLo12!!") == "XxXx0!"
    rows = [(*make("good fine"), 1, 1.0), (*make("bad worse"), 0, 1.0)] * 20
    w = quality.train_ftrl(rows, 12)
    score = lambda t: float(w[make(t)[0]] @ make(t)[1])
    assert score("good fine") > 0 > score("bad worse")


# --- toxicity ---------------------------------------------------------------------------------------


def test_chain_equals_enumeration():
    r = np.random.default_rng(1)
    e, first = r.normal(size=11) * 2, np.zeros(11, bool)
    first[[0, 4, 5]] = True
    trans, start = r.normal(size=(2, 2)), r.normal(size=2)
    chain = toxicity.Chain(e, first, trans, start)
    total, ones, pairs = 0.0, np.zeros(11), np.zeros((2, 2))
    for path in itertools.product((0, 1), repeat=11):
        s = sum(e[t] * path[t] + (start[path[t]] if first[t] else trans[path[t - 1], path[t]]) for t in range(11))
        w = math.exp(s)
        total += w
        ones += w * np.array(path)
        for t in range(11):
            if not first[t]:
                pairs[path[t - 1], path[t]] += w
    assert chain.marginals() == pytest.approx(ones / total, rel=1e-9)
    assert chain.pairs(first) == pytest.approx(pairs / total, rel=1e-9)


def test_chain_survives_extreme_and_long_input():
    e = np.tile([500.0, -500.0, 0.0], 70_000)
    p = toxicity.Chain(e, np.zeros(len(e), bool), np.zeros((2, 2)), np.zeros(2)).marginals()
    assert np.isfinite(p).all() and p[0] > 0.99 and p[1] < 0.01


def test_toxicity_held_out_spans_and_edges(spark):
    r = random.Random(2)
    bad = ["scumbag", "idiotic", "Trash"]
    data = []
    for i in range(400):
        words = [r.choice(["and", "the", "river", "house", "walked", "trashcan", "over"]) for _ in range(r.randint(5, 60))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(r.randint(1, 3)):
                words.insert(r.randint(0, len(words)), r.choice(bad))
        data.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([(i, t) for i, t, _ in data], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in data], "doc_id long, toxic int")
    odd = spark.createDataFrame([(None, "x"), (9000, None), (9001, ""), (9002, "..."), (9003, "the " * 50_000 + "SCUMBAG"), (9001, "")], docs.schema)
    mixed = docs.union(odd).withColumn("_tag", F.lit(1)).withColumn("_Score", F.lit(2))
    got = toxicity.score_toxicity(mixed, labels).collect()
    by = {g["doc_id"]: g for g in got}
    assert len(got) == 406 and "_tag" in got[0].asDict() and "_Score" not in got[0].asDict()
    test = [(by[i]["_predicted"], y) for i, _, y in data if held(i, 5) == 0]
    assert len(test) > 50 and np.mean([p == y for p, y in test]) > 0.97
    for i, text, y in data:
        spans = {text[s["start"] : s["end"]] for s in by[i]["_spans"]}
        if y:
            assert spans <= set(bad) | set() and spans
        else:
            assert not spans
    assert by[9000]["_score"] == by[9001]["_score"] == by[9002]["_score"] < 0.5 and by[9000]["_spans"] == []
    assert [(s["start"], s["end"]) for s in by[9003]["_spans"]] == [(200_000, 200_007)]
    one = toxicity.score_toxicity(docs.limit(5), labels.where("toxic = 0")).collect()
    assert max(g["_score"] for g in one) < 0.01
    assert {g["_score"] for g in toxicity.score_toxicity(docs.limit(5), labels.limit(0)).collect()} == {0.5}
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0


def insults(seed, n, words):
    """Texts with made-up words among common ones; every fourth is toxic."""
    r = random.Random(seed)
    common = ["and", "the", "river", "House", "walked", "over", "été", "x1"]
    toxic = np.arange(n) % 4 == 0
    texts = []
    for t in toxic:
        ws = [r.choice(common) if r.random() < 0.95 else f"w{r.randint(0, 9999)}" for _ in range(words)]
        if t:
            ws.insert(r.randint(0, words), r.choice(["Scumbag", "scumbags", "İdiotic", "idiot"]))
        texts.append(" ".join(ws))
    return texts, toxic


def peak(call):
    """MB that a call takes at its highest."""
    tracemalloc.start()
    try:
        call()
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_toxicity_training_and_tagging_take_bounded_memory():
    texts, toxic = insults(1, 400, 1500)  # 600,000 tokens, which took 168 MB when their messages were all held at once
    weight = np.ones(len(texts))
    train = lambda: toxicity.train_chain(texts, toxic, weight, rounds=1, bits=10)
    assert peak(train) < 40
    model = toxicity.train_chain(texts[:40], toxic[:40], weight[:40], rounds=1, bits=10)
    words = [" ".join(f"n{at}x{i}" for i in range(500)) for at in range(160)]
    tag = toxicity.Tagger(model)
    assert peak(lambda: tag(words)) < 32  # 80,000 words to remember, which took 48 MB with a list of features each


def test_toxicity_blocks_do_not_change_the_model(monkeypatch):
    texts, toxic = insults(2, 60, 40)
    texts[5:7] = ["", "..."]
    texts[9] = "the " * 700 + "Scumbag"
    weight = np.where(toxic, 1.0, 2.0)
    whole = toxicity.train_chain(texts, toxic, weight, bits=12)
    monkeypatch.setattr(toxicity, "BLOCK_TOKENS", 90)
    parts = toxicity.train_chain(texts, toxic, weight, bits=12)
    for name in ("own", "left", "right", "bias", "trans", "start", "doc", "prior"):
        assert getattr(parts, name) == pytest.approx(getattr(whole, name), rel=1e-6, abs=1e-8)
    assert toxicity.blocks(np.array([3, 3, 9, 1, 2]), 6) == [(0, 2), (2, 3), (3, 5)]
    assert toxicity.blocks(np.array([7]), 6) == [(0, 1)]


def test_toxic_marks_equal_counting_by_text():
    texts, toxic = insults(3, 120, 12)
    texts[4] = ""
    found = [toxicity.TOKEN.findall(t) for t in texts]
    words = toxicity.Vocabulary(8)
    codes, sizes = np.concatenate([words(f) for f in found]), np.array([len(f) for f in found])
    assert words.take().shape == (len(words.code), 7) and words.take().shape == (0, 7)
    got = toxicity.mark_tokens(list(words.code), codes, sizes, toxic)

    def keys(word):
        w = word.lower()
        return {("w", w), *((n, w[:n]) for n in (4, 5, 6) if len(w) > n)}

    count = [{}, {}]
    for f, t in zip(found, toxic, strict=True):
        for k in set().union(*map(keys, f)):
            count[int(t)][k] = count[int(t)].get(k, 0) + 1
    n1, n0 = int(toxic.sum()), int((~toxic).sum())
    marks = {k: n for k, n in count[1].items() if n >= 5 and n / n1 >= 20 * (count[0].get(k, 0) + 0.5) / n0}
    want = []
    for f, t in zip(found, toxic, strict=True):
        s = [max(marks.get(k, 0) for k in keys(w)) if t else 0 for w in f]
        want += [int(x > 0 and x >= 0.2 * max(s)) for x in s]
    assert got.tolist() == want and 20 < sum(want) < 60


# --- scoring ----------------------------------------------------------------------------------------


def ppm_brute(train, text, order):
    """Method C with exclusion, straight from its definition."""
    seen = {}
    pad = [ppm.BEFORE] * order
    for t in train:
        s = pad + list(t) + [ppm.END]
        for i in range(order, len(s)):
            for j in range(order + 1):
                node = seen.setdefault(tuple(s[i - j : i]), {})
                node[s[i]] = node.get(s[i], 0) + 1
    s, total = pad + list(text) + [ppm.END], 0.0
    for i in range(order, len(s)):
        gone = set()
        for j in range(order, -1, -1):
            node = {k: v for k, v in seen.get(tuple(s[i - j : i]), {}).items() if k not in gone}
            if not node:
                continue
            n, d = sum(node.values()), len(node)
            if s[i] in node:
                total += math.log10(node[s[i]] / (n + d))
                break
            total += math.log10(d / (n + d))
            gone |= set(node)
        else:
            total -= math.log10(ppm.SYMBOLS - len(gone))
    return total


@pytest.mark.parametrize("order", [1, 3, 5])
def test_scores_equal_brute_force(spark, order):
    r = random.Random(order)
    data = [(i, "".join(r.choice("abé \nAB") for _ in range(r.randint(0, 40)))) for i in range(60)]
    data += [(100, None), (None, "ab"), (2**60 + 1, "b"), (101, "zzz 天"), (7, "again under an id"), (7, "again under an id")]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("block", F.lit(1)).withColumn("learns", F.lit(0))
    got = ppm.score_texts(docs, order=order, block_bytes=700).collect()
    enc = lambda t: (t or "").encode()
    train = [enc(t) for k, t in data if held(k, 7) != 2]
    count = {}
    for t in train:
        for w in [*t.lower().split(), b""]:
            count[w] = count.get(w, 0) + 1
    n, v = sum(count.values()), len(count)
    want = []
    for k, t in data:
        words = [*enc(t).lower().split(), b""]
        base = sum(math.log10((count.get(w, 0) + 1) / (n + v + 1)) for w in words)
        want.append((k, held(k, 7) == 2, len(words), sum(w in count for w in words), n, base, ppm_brute(train, enc(t), order)))
    key = lambda x: (x[0] is None, x[0] or 0, x[2], x[6])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5]) and a[6] == pytest.approx(b[6])


def test_scoring_of_long_texts_and_without_any(spark):
    df = spark.createDataFrame([(0, "ab cd " * 100_000), (4, "ab ab")], "doc_id long, text string")
    got = {g["doc_id"]: g for g in ppm.score_texts(df).collect()}
    assert got[0]["n_tokens"] == 200_001 and got[0]["score"] > got[0]["base_score"] * 0.01
    assert ppm.score_texts(df.limit(0)).count() == 0
    lone = spark.createDataFrame([(next(i for i in range(99) if held(i, 7) == 2), "é")], "doc_id long, text string")
    g = ppm.score_texts(lone).first()
    assert g["train_tokens"] == 0 and g["score"] == pytest.approx(-3 * math.log10(256))
