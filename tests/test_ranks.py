"""Rank cut-offs, quotas, slices and hold-outs."""

from __future__ import annotations

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from charloom.operators import corpus, holdout, quotas
from charloom.operators.positions import group_stats, keys_at_ranks, rank_window_filter, with_rank


def rows(spark, sizes, gap=1):
    data, pos = [], 0
    for lang, n in sizes:
        for _ in range(n):
            data.append((lang, pos, f"{lang} line {pos}"))
            pos += gap
    return spark.createDataFrame(data, "lang string, pos bigint, text string")


def count_by(df, *cols):
    return {tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]]: r["count"] for r in df.groupBy(*cols).count().collect()}


def test_keys_at_ranks_by_refinement(spark):
    """Keys far apart and a hot group: the intervals are narrowed several times."""
    df = spark.range(30_000).select(
        F.when(F.col("id") % 10 == 0, "b").otherwise("a").alias("g"),
        (F.col("id") * F.col("id") * 977 - 10**9).alias("k"),
    )
    by, key = F.col("g"), F.col("k")
    stats = group_stats(df, by, key)
    wanted = {"a": [1, 7, 13_333, 27_000, 27_001], "b": [1, 1500, 3000], "none": [1]}
    got = keys_at_ranks(df, by, key, wanted, stats, max_ranked=5)
    want = {}
    for g in ("a", "b"):
        keys = sorted(i * i * 977 - 10**9 for i in range(30_000) if (i % 10 == 0) == (g == "b"))
        want.update({(g, r): keys[r - 1] for r in wanted[g] if r <= len(keys)})
    assert got == want


def test_rank_window_filter(spark):
    df = rows(spark, [("a", 10), ("b", 3)], gap=7)
    stats = group_stats(df, F.col("lang"), F.col("pos"))
    spans = {"a": (2, 5), "b": (0, 99), "c": (0, 5)}
    got = rank_window_filter(df, F.col("lang"), F.col("pos"), spans, stats)
    assert count_by(got, "lang") == {"a": 3, "b": 3}
    none = rank_window_filter(df, F.col("lang"), F.col("pos"), {"a": (10, 20)}, stats)
    assert none.count() == 0


def test_quota_then_cut(spark):
    df = rows(spark, [("A", 9), ("B", 9), ("C", 9)])
    order = ["A", "B", "C"]
    assert count_by(quotas.language_quota(df, order, 10), "lang") == {"A": 4, "B": 4, "C": 4}
    fused = quotas.quota_and_cut(df, order, 10)
    assert count_by(fused, "lang") == {"A": 4, "B": 4, "C": 2}
    chained = quotas.global_cut(quotas.language_quota(df, order, 10), order, 10)
    assert sorted(chained.collect()) == sorted(fused.collect())


def test_quota_is_not_redistributed_and_counts_missing_languages(spark):
    df = rows(spark, [("A", 1), ("B", 9), ("C", 9)])
    assert count_by(quotas.quota_and_cut(df, ["A", "B", "C"], 10), "lang") == {"A": 1, "B": 4, "C": 4}
    assert count_by(quotas.quota_and_cut(df, ["A", "B", "C", "gone"], 12), "lang") == {"A": 1, "B": 3, "C": 3}
    assert quotas.quota_per_language(200_000, 20) == 10_000
    assert quotas.quota_per_language(2, 20) == 1
    assert count_by(quotas.quota_and_cut(df, ["A", "B", "C"], 2), "lang") == {"A": 1, "B": 1}


def test_early_stop_reads_on_until_the_quota_is_full(spark):
    """The rows of one language all lie far behind the first key bound."""
    df = rows(spark, [("A", 50)]).unionByName(
        rows(spark, [("B", 30)]).withColumn("pos", F.col("pos") + 10_000_000)
    )
    assert count_by(quotas.quota_and_cut(df, ["A", "B"], 40), "lang") == {"A": 20, "B": 20}


@pytest.mark.parametrize(
    ("en", "xx", "max_lines", "cap", "want_en", "want_xx"),
    [
        (10, 10, 0, 4, range(7, 11), range(7, 11)),
        (12, 6, 0, 4, range(3, 7), range(3, 7)),
        (12, 6, 0, 8, range(1, 9), range(1, 7)),
        (10, 10, 3, 8, range(8, 11), range(8, 11)),
    ],
)
def test_trim_from_top(spark, en, xx, max_lines, cap, want_en, want_xx):
    data = [("en-xx", "en", i) for i in range(en)] + [("en-xx", "xx", i) for i in range(xx)]
    df = spark.createDataFrame(data, "pair string, lang string, pos bigint")
    got = quotas.trim_from_top(df, max_lines, cap).collect()
    assert sorted(r["pos"] + 1 for r in got if r["lang"] == "en") == list(want_en)
    assert sorted(r["pos"] + 1 for r in got if r["lang"] == "xx") == list(want_xx)


def test_head_lines(spark):
    df = rows(spark, [("en", 5), ("hi", 5)])
    for n, want in ((3, {"en": 3}), (7, {"en": 5, "hi": 2}), (0, {"en": 5, "hi": 5})):
        assert count_by(quotas.head_lines(df, ["en", "hi"], n, file="lang"), "lang") == want


def test_slices(spark):
    data = list(enumerate(["a", "", "b", "c", "d"]))
    df = spark.createDataFrame(data, "pos bigint, text string")
    assert [r["text"] for r in quotas.slice_raw(df, 1, 3).orderBy("pos").collect()] == ["b", "c"]
    got = quotas.slice_non_blank(df, 1, 3).orderBy("pos").collect()
    assert [r["text"] for r in got] == ["b", "c", "d"]


def test_shard_budget(spark):
    data = [("x", 1, i, k) for i, k in enumerate("kdkdkk")] + [("x", 2, i, k) for i, k in enumerate("dkk")]
    df = spark.createDataFrame(data, "lang string, shard_rank int, pos bigint, kind string")
    got = quotas.shard_budget_quota(df, 4, 2, keep=F.col("kind") == "k")
    assert count_by(got, "shard_rank") == {1: 2, 2: 1}


def test_select_shards_ignores_blank_lines(spark):
    data = [("en", 0, " "), ("en", 1, "a"), ("en", 2, "b"), ("en", 3, "c"), ("fr", 0, "d")]
    df = spark.createDataFrame(data, "lang string, pos bigint, shard string")
    got = quotas.select_shards(df, 2).collect()
    assert sorted(r["shard"] for r in got) == ["a", "b", "d"]


def test_with_rank_splits_a_hot_group(spark):
    df = spark.range(5000).select(
        F.when(F.col("id") % 10 < 9, "hot").otherwise("cold").alias("g"),
        (F.lit(100_000) - F.col("id") * 3).alias("k"),
    )
    got = with_rank(df, ["g"], ["k"], partitions=7).collect()
    for g in ("hot", "cold"):
        part = sorted((r["k"], r["pos"]) for r in got if r["g"] == g)
        assert [p for _, p in part] == list(range(len(part)))
    whole = with_rank(df, [], ["k"], partitions=5).orderBy("k").collect()
    assert [r["pos"] for r in whole] == list(range(5000))


def test_head_holdout(spark):
    df = spark.createDataFrame(list(enumerate(["a", "", "b", "c", ""])), "pos bigint, text string")
    split = holdout.head_holdout(df, 2).where(F.trim("text") != "")
    assert count_by(split, "split") == {"eval": 1, "train": 2}
    assert count_by(holdout.head_holdout(df, 0).where(F.trim("text") != ""), "split") == {"train": 3}


@pytest.mark.parametrize(("n", "test"), [(19, 0), (100, 5), (101, 6)])
def test_random_holdout(spark, n, test):
    df = spark.range(n)
    got = holdout.random_holdout(df, "id").collect()
    order = sorted(range(n), key=lambda i: hashlib.md5(f"42:{i}".encode()).hexdigest())
    assert {r["id"] for r in got if r["split"] == "test"} == set(order[:test])
    assert len(got) == n


def test_random_holdout_without_floor(spark):
    got = holdout.random_holdout(spark.range(10), "id", min_rows=1).where("split = 'test'").count()
    assert got == math.ceil(0.5)


def test_mix_sources_keeps_its_share(spark):
    a, b = spark.range(10_000), spark.range(10_000, 20_000)
    got = count_by(holdout.mix_sources({"a": (a, 1.0), "b": (b, 0.25)}, "id"), "mix_source")
    assert got["a"] == 10_000
    assert 2200 < got["b"] < 2800


def test_line_counts(spark):
    df = spark.createDataFrame(list(enumerate(["a", "", "b", "c", ""])), "pos bigint, text string")
    df = df.withColumn("file", F.lit("f"))
    assert corpus.line_count_non_blank(df).first()["n"] == 3
    assert corpus.line_count_non_blank(df, skip_head=2).first()["n"] == 2


def test_align_pairs(spark):
    data = [("en-fr", "en", i * 2, f"e{i}") for i in range(5)] + [("en-fr", "fr", i, f"f{i}") for i in range(3)]
    df = spark.createDataFrame(data, "pair string, lang string, pos bigint, text string")
    got = corpus.align_pairs(df).orderBy("rank").collect()
    assert [(r["text_1"], r["text_2"]) for r in got] == [("e0", "f0"), ("e1", "f1"), ("e2", "f2")]
