"""n-gram counts, smoothing, look-ups, guesses, scoring and language detection."""

from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from charloom.operators import corpus, langid, ngrams, predict, scoring
from charloom.plans import modelling
from charloom.session import stage

TEXTS = ["abab", "a", "", "今天天气很好", "x😀y😀z", "the cat sat on the mat"]


def frame(spark, texts, name="text"):
    return spark.createDataFrame(list(enumerate(texts)), f"id bigint, {name} string")


def all_counts(spark, texts, n):
    return stage(ngrams.order_counts(ngrams.full_gram_counts(frame(spark, texts), n), n), "t")


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_ngram_counts(spark, n):
    got = {(r["ctx"], r["ch"]): r["cnt"] for r in ngrams.ngram_counts(frame(spark, TEXTS), n).collect()}
    want = Counter((t[i : i + n - 1], t[i + n - 1]) for t in TEXTS for i in range(len(t) - n + 1))
    assert got == dict(want)


@pytest.mark.parametrize("n", [1, 3, 5])
def test_full_grams_and_orders(spark, n):
    full = ngrams.full_gram_counts(frame(spark, TEXTS), n)
    want = Counter(t[max(0, i - n + 1) : i + 1] for t in TEXTS for i in range(len(t)))
    assert {r["g"]: r["cnt"] for r in full.collect()} == dict(want)
    orders = {r["g"]: r["cnt"] for r in ngrams.order_counts(full, n).collect()}
    want = Counter(t[i : i + k] for k in range(1, n + 1) for t in TEXTS for i in range(len(t) - k + 1))
    assert orders == dict(want)


def test_add_k(spark):
    counts = ngrams.ngram_counts(frame(spark, ["abab"]), 3)
    got = {(r["ctx"], r["ch"]): r["p"] for r in ngrams.add_k_probs(counts, 2).collect()}
    assert got == {("ab", "a"): pytest.approx(2 / 3), ("ba", "b"): pytest.approx(2 / 3)}


def plain_scores(texts, n, gram, method, v, lam=0.7, alpha=0.4, k=1.0):
    c = Counter(t[i : i + o] for o in range(1, n + 1) for t in texts for i in range(len(t) - o + 1))
    total = Counter()
    for g, x in c.items():
        total[(len(g), g[:-1])] += x
    p, s = 1 / v, 0.0
    for o in range(1, len(gram) + 1):
        g = gram[-o:]
        t = total[(o, g[:-1])]
        p = lam * c[g] / t + (1 - lam) * p if t else p
        s = c[g] / t if c[g] else alpha * s
    if method == "addk":
        return (c[gram] + k) / (total[(len(gram), gram[:-1])] + k * v)
    return p if method == "interp" else s


@pytest.mark.parametrize("method", ["addk", "interp", "backoff"])
@pytest.mark.parametrize("n", [2, 3, 4])
def test_smoothing(spark, method, n):
    counts = all_counts(spark, TEXTS, n)
    v = ngrams.vocabulary_size(counts)
    assert v == len(set("".join(TEXTS)))
    queries = ["the"[:n], "zzzz"[:n], "qthe"[-n:], "a", "t", "气很", "Q"]
    asked = spark.createDataFrame([(q,) for q in queries], "g string")
    got = {r["g"]: r["p"] for r in ngrams.ngram_probs(counts, n, v, method, asked).collect()}
    for q in queries:
        assert got[q] == pytest.approx(plain_scores(TEXTS, n, q, method, v)), q


@pytest.mark.parametrize("method", ["addk", "interp"])
def test_probabilities_sum_to_one(spark, method):
    counts = all_counts(spark, TEXTS, 3)
    v = ngrams.vocabulary_size(counts)
    letters = sorted(set("".join(TEXTS)))
    asked = spark.createDataFrame([(c + x,) for c in ("th", "at", "zz") for x in letters], "g string")
    probs = ngrams.ngram_probs(counts, 3, v, method, asked)
    sums = probs.groupBy(F.substring("g", 1, 2)).agg(F.sum("p").alias("p")).collect()
    assert [r["p"] for r in sums] == pytest.approx([1.0] * 3)


def test_perplexity(spark):
    rows = [("a", 0.25, 3), ("a", None, 9), ("b", math.exp(-50), 1), ("c", math.exp(-49.999), 1)]
    scored = spark.createDataFrame(rows, "k string, p double, cnt bigint")
    got = {r["k"]: r for r in ngrams.perplexity(ngrams.cross_entropy(scored, ["k"])).collect()}
    assert got["a"]["ppl"] == pytest.approx(4.0)
    assert got["a"]["n"] == 3
    assert got["b"]["ppl"] == math.inf
    assert math.isfinite(got["c"]["ppl"])


def test_other_loss(spark):
    scored = spark.createDataFrame([(0.5, 2)], "p double, cnt bigint")
    got = ngrams.cross_entropy(scored, loss=lambda p: 1 - p).first()
    assert got["loss"] == pytest.approx(0.5)


@pytest.mark.parametrize("n", [1, 2, 3, 5])
def test_backoff_lookup(spark, n):
    counts = all_counts(spark, TEXTS, n)
    topk = stage(ngrams.ngram_topk(counts), "t")
    keys = ["th"[: n - 1], "zt"[-(n - 1) :] if n > 1 else "", "", "天", "the "[-(n - 1) :] if n > 1 else ""]
    asked = spark.createDataFrame([(k,) for k in keys], "key string")
    got = {r["key"]: r["guesses"] for r in ngrams.ngram_backoff_lookup(asked, topk, n).collect()}
    c = Counter(t[i : i + o] for o in range(1, n + 1) for t in TEXTS for i in range(len(t) - o + 1))

    def best(ctx):
        found = [(-x, g[-1]) for g, x in c.items() if g[:-1] == ctx]
        return [ch for _, ch in sorted(found)[:3]]

    for key in set(keys):
        ranked = []
        for o in range(min(len(key), n - 1), -1, -1):
            ranked += [x for x in best(key[len(key) - o :]) if x not in ranked]
        assert got[key] == ranked[:3], key


def test_topk_ties_keep_the_first(spark):
    df = spark.createDataFrame([("r", "b", 1.0), ("r", "a", 1.0), ("r", "c", 2.0)], "r string, t string, s double")
    got = ngrams.topk_per_row(df, ["r"], "s", [F.col("t")], 2).orderBy("rank").collect()
    assert [x["t"] for x in got] == ["c", "a"]


def test_marginalise_first_char(spark):
    tokens = [(" the", 0.4), ("t", 0.1), (" a", 0.3), ("\n", 0.15), ("�", 0.05)]
    df = spark.createDataFrame([(1, t, math.log(p)) for t, p in tokens], "r int, token string, logprob double")
    got = {r["ch"]: r["logprob"] for r in ngrams.marginalise_first_char(df, ["r"]).collect()}
    assert got == {"t": pytest.approx(math.log(0.5)), "a": pytest.approx(math.log(0.3))}
    first = ngrams.marginalise_first_char(df, ["r"], top_k=1).collect()
    assert [(r["ch"], round(r["logprob"], 9)) for r in first] == [("t", round(math.log(0.4), 9))]


def test_fill_guesses(spark):
    df = spark.createDataFrame([(["天"],), (["气", "天"],), (["t", "a"],), ([],)], "top array<string>")
    got = [r[0] for r in df.select(predict.fill_guesses(F.col("top"), predict.TOKEN_FALLBACK)).collect()]
    assert got == ["天气快", "气天快", "ta天", "天气快"]
    byte = df.select(predict.fill_guesses(F.col("top"), predict.BYTE_FALLBACK)).collect()
    assert byte[2][0] == "ta "
    assert byte[3][0] == " .e"


def test_routing(spark):
    counts = all_counts(spark, ["the é the é then", "一 二三 一 二四"], 4)
    english, other = predict.byte_model(counts, 3), predict.token_model(counts, 3)
    rows = [(0, "", True), (1, " ", True), (2, "the", True), (3, "二", False), (4, "", False)]
    inputs = spark.createDataFrame(rows, "pos bigint, text string, is_english boolean")
    got = {r["pos"]: r["pred"] for r in predict.route_predict(inputs, english, other).collect()}
    assert got[0] == "eta" and got[4] == "天气快"
    assert got[1] != "eta"
    assert all(len(p) == 3 and len(set(p)) == 3 for p in got.values())
    assert all(c < "\x80" for c in got[2])
    assert " " not in got[3]
    assert got[3].startswith("三四")
    only = {r["pos"]: r["pred"] for r in predict.route_predict(inputs, english, None).collect()}
    assert only[4] == "eta" and all(p.isascii() for p in only.values())


def test_scoring(spark):
    gold = spark.createDataFrame([(0, "a"), (1, "d"), (2, ""), (3, "z")], "pos bigint, gold string")
    pred = spark.createDataFrame([(0, "xAy"), (1, "abcd"), (2, "abc"), (9, "zzz")], "pos bigint, pred string")
    scored = scoring.score_join(gold, pred)
    assert [r["hit"] for r in scored.orderBy("pos").collect()] == [True, False, True, False]
    assert scoring.success_rate(scored).first()["success_rate"] == 0.5
    firsts = spark.createDataFrame([(0, "abc"), (1, "xdy")], "pos bigint, pred string")
    top = scoring.top1_accuracy(scoring.score_join(gold.where("pos < 2"), firsts)).first()
    assert (top["n"], top["top1_hits"]) == (2, 1)


def test_long_answer_is_not_cut(spark):
    gold = spark.createDataFrame([(0, "abcd")], "pos bigint, gold string")
    pred = spark.createDataFrame([(0, "abcd")], "pos bigint, pred string")
    assert not scoring.score_join(gold, pred).first()["hit"]


def test_detector_on_known_lines(spark):
    train = [
        ("en", "hello world this is the way we say that there and then with the others in the world hello"),
        ("fr", "bonjour le monde nous sommes les enfants de la ville et les autres dans le monde bonjour"),
        ("es", "hola mundo nosotros somos los hijos de la ciudad y los otros en el mundo hola"),
        ("zh", "你好世界今天天气很好我们一起去公园你好世界"),
        ("ja", "こんにちは世界今日はとても良い天気ですねこんにちは"),
    ]
    labelled = spark.createDataFrame(train, "lang string, text string")
    profiles = langid.train_language_profiles(labelled, ["en", "fr", "es", "zh", "ja", "none"])
    cases = ["Hello world", "Bonjour le monde", "Hola mundo", "你好世界", "こんにちは世界", "a"]
    rows = frame(spark, cases)
    got = {r["text"]: r["detected"] for r in langid.with_detected_language(rows, profiles, "id").collect()}
    assert got == dict(zip(cases, ["en", "fr", "es", "zh", "ja", None], strict=True))


def test_utf8_audit(spark):
    df = spark.createDataFrame([("x", "aé今😀"), ("x", "")], "lang string, text string")
    broken = spark.sql("select 'x' as lang, cast(x'41FF' as string) as text")
    got = corpus.utf8_audit(df.unionByName(broken), "lang").first()
    assert (got["n_rows"], got["invalid_rows"]) == (3, 1)
    assert [got[f"chars_{i}"] for i in (1, 2, 3, 4)] == [2, 1, 2, 1]
    heads = [0x41, 0xC1, 0xC2, 0xE4, 0xF4, 0xF5, 0x80]
    df = spark.createDataFrame([(i, b) for i, b in enumerate(heads)], "i int, b int")
    classes = df.orderBy("i").select(corpus.utf8_lead_class(F.col("b"))).collect()
    assert [r[0] for r in classes] == [1, 0, 2, 3, 4, 0, 0]


def test_flatten_conversation(spark):
    turns = [(1, i, t) for i, t in enumerate([" Hi\nthere ", None, "  ", "ok"])] + [(2, 0, " ")]
    df = spark.createDataFrame(turns, "conv_id bigint, turn bigint, text string")
    assert corpus.flatten_conversation(df).collect() == [(1, "Hi there ok")]
    long = spark.range(500).select(
        F.lit(7).alias("conv_id"), F.col("id").alias("turn"), F.concat(F.lit("t"), "id").alias("text")
    )
    line = corpus.flatten_conversation(long, chunk_turns=9).first()["text"]
    assert line == " ".join(f"t{i}" for i in range(500))


def test_token_batch_stats(spark):
    df = spark.range(1000).select(F.lit("x").alias("k"), F.lit("é" * 40).alias("text"))
    got = corpus.token_batch_stats(df, "k", max_len=64).first()
    assert (got["tokens"], got["clipped_rows"], got["padding"], got["steps"]) == (80_000, 1000, 0, 31)
    for given, want in ((1024, 1024), (1000, 960), (10, 64)):
        assert corpus.token_batch_stats(df, "k", max_len=given).first()["aligned_limit"] == want
    assert corpus.token_batch_stats(df.limit(10), "k").first()["steps"] == 1


def test_dense_success_matches_a_plain_count(spark):
    words = ["alpha beta gamma delta", "the cat sat on the mat", "今天天气很好今天", "una casa de la playa"]
    docs = spark.createDataFrame(
        [(i, "en" if i % 2 else "xx", f"{words[i % 4]} {i % 7} {words[(i + 1) % 4]}") for i in range(60)],
        "doc_id bigint, lang string, text string",
    )
    lines = modelling.evaluation_lines(docs).collect()
    c = Counter()
    for r in lines:
        if r["split"] == "train":
            t = r["text"]
            c.update(t[i : i + o] for o in (1, 2, 3) for i in range(len(t) - o + 1))
    hits, n = Counter(), Counter()
    for r in lines:
        if r["split"] == "test":
            t = r["text"]
            for i, ch in enumerate(t):
                ranked = []
                for o in range(min(i, 2), -1, -1):
                    ctx = t[i - o : i]
                    found = sorted((-x, g[-1]) for g, x in c.items() if g[:-1] == ctx)
                    ranked += [x for _, x in found[:3] if x not in ranked]
                n[r["lang"]] += 1
                hits[r["lang"]] += ch in ranked[:3]
    got = {r["lang"]: (r["n"], r["hits"]) for r in modelling.dense_success(docs).collect()}
    assert got == {k: (n[k], hits[k]) for k in n}
