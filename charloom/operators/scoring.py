"""Scoring guesses against an answer key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from charloom.functions.text import fold_guess


def score_join(gold: DataFrame, pred: DataFrame, key: str = "pos") -> DataFrame:
    """Answers with their guesses, both case-folded, plus ``hit``.

    A missing guess is empty and guesses without an answer are ignored. ``hit`` is "the guess contains
    the answer", so an empty answer always counts.
    """
    guesses = pred.select(key, fold_guess(F.col("pred")).alias("pred"))
    answers = gold.withColumn("gold", fold_guess(F.col("gold"), None))
    joined = answers.join(guesses, key, "left").withColumn("pred", F.coalesce("pred", F.lit("")))
    return joined.withColumn("hit", F.contains(F.col("pred"), F.col("gold")))


def success_rate(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows, hits and their ratio."""
    n, hits = F.count(F.lit(1)), F.count_if("hit")
    return scored.groupBy(*by).agg(
        n.alias("n"), hits.alias("hits"), (hits / n).alias("success_rate")
    )


def top1_accuracy(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose first guess is the answer."""
    n = F.count(F.lit(1))
    hits = F.count_if(F.substring("pred", 1, 1) == F.col("gold"))
    return scored.groupBy(*by).agg(
        n.alias("n"), hits.alias("top1_hits"), (hits / n).alias("top1_accuracy")
    )
