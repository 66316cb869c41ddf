"""Tokens of varying length: a vocabulary of frequent strings, texts cut by longest match, tokens counted per context.

The vocabulary becomes a prefix trie, and the trie one regular expression whose every choice is decided by the next
character, so that a text is cut inside the scan by a built-in function. A character that starts no token is one itself.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from charloom.operators.predict import NgramModel, rank_first_chars
from charloom.operators.runs import count_in_runs, tokens_in_context
from charloom.session import stage

VOCABULARY = 5000
_END = ""


def token_vocabulary(counts: DataFrame, size: int = VOCABULARY, max_len: int = 4) -> DataFrame:
    """``(token, cnt)``: the ``size`` most frequent strings of 2 to ``max_len`` characters; ties by the string.

    ``counts`` are those of character grams, ``(g, cnt)``, of all orders up to ``max_len`` at least. Single characters
    are tokens always and need no entry.
    """
    grams = counts.where(F.length("g").between(2, max_len)).select(F.col("g").alias("token"), "cnt")
    return grams.orderBy(F.col("cnt").desc(), "token").limit(size)


def trie(tokens: Sequence[str]) -> dict:
    """Nested dictionaries by character; an empty key marks the end of a token."""
    root: dict = {}
    for token in tokens:
        node = root
        for ch in token:
            node = node.setdefault(ch, {})
        node[_END] = {}
    return root


def _pattern(node: dict) -> str:
    """What may follow a node, longest first; at most one branch fits a character, so none is tried in vain."""
    branches = [re.escape(ch) + _pattern(below) for ch, below in sorted(node.items()) if ch != _END]
    if not branches:
        return ""
    body = "(?:" + "|".join(branches) + ")"
    return f"{body}?" if _END in node else body


def trie_pattern(tokens: Sequence[str]) -> str:
    """An expression that finds, from any place, the longest token there, or else one character."""
    body = _pattern(trie([t for t in tokens if t]))
    return f"{body}|(?s:.)" if body else "(?s:.)"


def longest_match(text: Column, tokens: Sequence[str]) -> Column:
    """The tokens of a text, each the longest of the vocabulary that starts where the one before ended.

    Joined they are the text again. Empty for NULL and empty texts.
    """
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(trie_pattern(tokens)), F.lit(0))


def token_counts(df: DataFrame, tokens: Sequence[str], n: int, text: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """``(by, ctx, token, cnt)``: each token of the texts after every context of 0 to ``n - 1`` characters that it has.

    The texts are cut as by :func:`longest_match`. Each token is counted once with all its context, which collapses before
    the shuffle, a run of texts at a time; shorter contexts are summed from those counts.
    """
    full = count_in_runs(df, F.col(text), by, ["_ctx", "token"], tokens_in_context(tokens, n))
    lengths = F.sequence(F.lit(0), F.length("_ctx"))
    return (
        full.select(*by, F.explode(F.transform(lengths, lambda k: F.right("_ctx", k))).alias("ctx"), "token", "cnt")
        .groupBy(*by, "ctx", "token")
        .agg(F.sum("cnt").alias("cnt"))
    )


def token_logprobs(counts: DataFrame, by: Sequence[str] = ("ctx",)) -> DataFrame:
    """``(by, token, logprob)`` of each token after its context, as counted."""
    totals = counts.groupBy(*by).agg(F.sum("cnt").alias("total"))
    joined = counts.join(totals, list(by))
    return joined.select(*by, "token", F.log(F.col("cnt") / F.col("total")).alias("logprob"))


def token_model(df: DataFrame, tokens: Sequence[str], n: int, k: int = 3, text: str = "text") -> NgramModel:
    """Model of the token path with tokens of varying length, summed by the first character that they show."""
    counts = stage(token_counts(df, tokens, n, text), "tokens")
    return NgramModel(rank_first_chars(token_logprobs(counts), k), n)
