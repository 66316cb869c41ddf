"""Guesses for input lines: fill rules, routing by language, joining model look-ups to inputs."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from charloom.functions.predicates import single_byte_candidate
from charloom.operators.ngrams import (
    context,
    last_char,
    marginalise_first_char,
    ngram_backoff_lookup,
    ngram_topk,
    topk_per_row,
)
from charloom.session import stage

# Fallback characters and the guesses for an empty line, per path.
TOKEN_FALLBACK = "天气快不错吗"
BYTE_FALLBACK = " .eta"
TOKEN_EMPTY_GUESS = "天气快"
BYTE_EMPTY_GUESS = "eta"

TOKEN_CHARS = 2


@dataclass(frozen=True)
class NgramModel:
    """Ranked next characters per context, ``(ctx, tops)``, for contexts up to ``n - 1`` long."""

    topk: DataFrame
    n: int


def fill_guesses(top: Column, fallback: str, k: int = 3) -> Column:
    """The ranked characters, then fallback characters not already there, ``k`` in all."""
    chars = F.array(*[F.lit(c) for c in fallback])
    return F.array_join(F.slice(F.array_distinct(F.concat(top, chars)), 1, k), "")


def empty_input_guess(text: Column, guess: Column, when_empty: str) -> Column:
    """A fixed guess for a line without any character; whitespace-only lines are ranked normally."""
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(when_empty)).otherwise(guess)


def byte_model(counts: DataFrame, n: int, k: int = 3) -> NgramModel:
    """Model of the byte path: only whole one-byte characters can be guessed; ``counts`` may have more orders."""
    ch = last_char(F.col("g"))
    ascii_only = counts.where(
        (F.length("g") <= n) & (F.octet_length(ch) == 1) & single_byte_candidate(F.ascii(ch))
    )
    return NgramModel(ngram_topk(ascii_only, k), n)


def token_model(counts: DataFrame, n: int, k: int = 3) -> NgramModel:
    """Model of the token path: two-character tokens, summed by the first character of the stripped token.

    So a word start counts as its first letter and whitespace is never guessed. ``counts`` has orders up to
    ``n + 1``. Sums are compared to nine digits, and equal ones go by character.
    """
    return NgramModel(rank_first_chars(token_candidates(counts.where(F.length("g") <= n + 1), TOKEN_CHARS), k), n)


def rank_first_chars(candidates: DataFrame, k: int = 3) -> DataFrame:
    """``(ctx, tops)`` from ``(ctx, token, logprob)``: the ``k`` best first characters of each context."""
    chars = marginalise_first_char(candidates, ["ctx"])
    best = topk_per_row(chars.withColumn("_score", F.round("logprob", 9)), ["ctx"], "_score", [F.col("ch")], k, "_rank")
    ranked = F.array_sort(F.collect_list(F.struct("_rank", "ch")))
    return best.groupBy("ctx").agg(F.transform(ranked, lambda e: e["ch"]).alias("tops"))


def _suffixes(inputs: DataFrame, length: int, text: str) -> DataFrame:
    """The inputs with their text cut down to what a model looks at, staged.

    Every later step reads these narrow rows; the text itself is read once.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    others = [c for c in inputs.columns if c != text]
    narrow = inputs.select(
        *others, F.right(value, F.lit(length)).alias("_key"), (value == "").alias("_empty")
    )
    return stage(narrow, "suffixes")


def _answer(narrow: DataFrame, model: NgramModel, fallback: str, when_empty: str) -> DataFrame:
    keyed = narrow.withColumn("key", F.right("_key", F.lit(model.n - 1)))
    found = ngram_backoff_lookup(keyed, model.topk, model.n)
    filled = fill_guesses(F.coalesce("guesses", F.array().cast("array<string>")), fallback)
    pred = F.when(F.col("_empty"), F.lit(when_empty)).otherwise(filled)
    return (
        keyed.join(found, "key", "left")
        .withColumn("pred", pred)
        .drop("key", "guesses", "_key", "_empty")
    )


def predict(
    inputs: DataFrame, model: NgramModel, fallback: str, when_empty: str, text: str = "text"
) -> DataFrame:
    """The inputs without their text, with ``pred``.

    The model is asked once per distinct suffix and joined back by suffix. The suffix of the inputs can be
    skewed; the other side has one row per suffix, so the join broadcasts it when small and the adaptive
    skew join splits the large side otherwise.
    """
    return _answer(_suffixes(inputs, model.n - 1, text), model, fallback, when_empty)


def route_predict(
    inputs: DataFrame,
    byte_path: NgramModel,
    token_path: NgramModel | None,
    is_english: str = "is_english",
    text: str = "text",
) -> DataFrame:
    """English lines take the byte path, others the token path; without one all take the byte path."""
    if token_path is None:
        return predict(inputs, byte_path, BYTE_FALLBACK, BYTE_EMPTY_GUESS, text)
    narrow = _suffixes(inputs, max(byte_path.n, token_path.n) - 1, text)
    english = F.coalesce(F.col(is_english), F.lit(True))
    return _answer(
        narrow.where(english), byte_path, BYTE_FALLBACK, BYTE_EMPTY_GUESS
    ).unionByName(_answer(narrow.where(~english), token_path, TOKEN_FALLBACK, TOKEN_EMPTY_GUESS))


def token_candidates(counts: DataFrame, token_len: int, ctx_len: int | None = None) -> DataFrame:
    """``(ctx, token, logprob)`` from counted grams: ``token_len`` characters after ``ctx_len`` ones, or after any.

    After any context of counts of all orders, the last character of a text is a token of its own.
    """
    length = F.length("g")
    grams = counts.where(length >= token_len if ctx_len is None else length == ctx_len + token_len)
    pairs = grams.select(
        F.substr(F.col("g"), F.lit(1), length - token_len).alias("ctx"),
        F.right(F.col("g"), F.lit(token_len)).alias("token"),
        "cnt",
    )
    if ctx_len is None and token_len == 2:
        pairs = pairs.unionByName(_ends(counts))
    totals = pairs.groupBy("ctx").agg(F.sum("cnt").alias("total"))
    return pairs.join(totals, "ctx").select(
        "ctx", "token", F.log(F.col("cnt") / F.col("total")).alias("logprob")
    )


def _ends(counts: DataFrame) -> DataFrame:
    """``(ctx, token, cnt)`` of characters that nothing follows: what a gram has beyond its continuations."""
    gram = F.col("g")
    after = counts.where(F.length(gram) > 1).groupBy(context(gram).alias("g")).agg(F.sum("cnt").alias("_on"))
    longest = counts.agg(F.max(F.length(gram))).scalar()
    left = counts.where(F.length(gram) < longest).join(after, "g", "left")
    rest = F.col("cnt") - F.coalesce("_on", F.lit(0))
    return left.select(context(gram).alias("ctx"), last_char(gram).alias("token"), rest.alias("cnt")).where("cnt > 0")
