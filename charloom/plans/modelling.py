"""Training, evaluation and prediction recipes over a corpus of text rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from charloom.functions.predicates import is_english, is_english_ascii, non_blank
from charloom.functions.text import collapse_ws, fold_guess
from charloom.operators import tokens
from charloom.operators.holdout import head_holdout, random_holdout
from charloom.operators.langid import train_language_profiles, with_detected_language
from charloom.operators.ngrams import (
    context,
    cross_entropy,
    full_gram_counts,
    gram_evidence,
    last_char,
    ngram_backoff_lookup,
    ngram_topk,
    nll,
    order_counts,
    perplexity,
    smoothed_score,
    vocabulary_size,
)
from charloom.operators.predict import (
    BYTE_FALLBACK,
    TOKEN_FALLBACK,
    NgramModel,
    byte_model,
    fill_guesses,
    predict,
    route_predict,
    token_model,
)
from charloom.operators.positions import with_rank
from charloom.operators.scoring import score_join
from charloom.session import stage
from charloom.sinks.committed import write_predictions
from charloom.sources.files import read_lines

FALLBACK = " .eta"


def evaluation_lines(docs: DataFrame, key: str = "doc_id", eval_size: int | None = None) -> DataFrame:
    """All documents with text, collapsed, with their held-out flag.

    Blank ones are dropped in one scan that stages the keys; the hold-out is then counted on the keys alone.
    With ``eval_size`` the head of the corpus by key is held out instead of a random part.
    """
    rows = docs.select(key, "lang", "text").where(non_blank(F.col("text")))
    if eval_size is None:
        split = random_holdout(rows, key, keys=stage(rows.select(key), "keys"))
    else:
        head = head_holdout(rows, eval_size, key)
        split = head.withColumn("split", F.when(F.col("split") == "eval", "test").otherwise("train"))
    return split.withColumn("text", collapse_ws(F.col("text")))


def cut_length(key: Column, text: Column) -> Column:
    """A deterministic prefix length from 5 characters to all but the last; less for shorter texts, 0 for one."""
    least = F.greatest(F.least(F.lit(5), F.length(text) - 1), F.lit(0))
    return least + F.pmod(key * F.lit(7919), F.greatest(F.length(text) - least, F.lit(1))).cast("int")


def prompts(lines: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(pos, lang, text, gold)``: each line cut at its prefix length, with the character after it."""
    cut = cut_length(F.col(key), F.col("text"))
    return lines.select(
        F.col(key).alias("pos"),
        "lang",
        F.substr(F.col("text"), F.lit(1), cut).alias("text"),
        F.substr(F.col("text"), cut + 1, F.lit(1)).alias("gold"),
    )


def train_counts(lines: DataFrame, n: int, by: Sequence[str] = ()) -> DataFrame:
    """Staged counts of all orders up to ``n``. One pass over the text; the table is read many times."""
    return stage(order_counts(full_gram_counts(lines, n, by=by), n, by), "grams")


def heldout_success(docs: DataFrame, n: int = 3, key: str = "doc_id") -> DataFrame:
    """How often the true next character is among three guesses, per language, one cut per document."""
    lines = evaluation_lines(docs, key)
    counts = train_counts(lines.where(F.col("split") == "train"), n)
    inputs = prompts(lines.where(F.col("split") == "test"), key)
    preds = predict(inputs, NgramModel(ngram_topk(counts), n), FALLBACK, "eta")
    scored = score_join(inputs.select("pos", "lang", "gold"), preds.select("pos", "pred"))
    return scored.groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("hit").alias("hits"),
        F.count_if(F.substring("pred", 1, 1) == F.col("gold")).alias("top1_hits"),
    )


def heldout_grams(lines: DataFrame, n: int) -> DataFrame:
    """``(lang, g, cnt)`` of every held-out position, aggregated before any join."""
    return full_gram_counts(lines, n, by=["lang"])


def dense_success(docs: DataFrame, n: int = 3, key: str = "doc_id") -> DataFrame:
    """The same over every held-out position. Positions are aggregated to grams first, so the look-up
    joins grams and not text positions. Guesses are filled and folded as the scorer does."""
    lines = evaluation_lines(docs, key)
    counts = train_counts(lines.where(F.col("split") == "train"), n)
    held = stage(heldout_grams(lines.where(F.col("split") == "test"), n), "heldout")
    pairs = held.select("lang", "cnt", context(F.col("g")).alias("key"), last_char(F.col("g")).alias("gold"))
    found = ngram_backoff_lookup(pairs, ngram_topk(counts), n)
    scored = pairs.join(found, "key", "left")
    ranked = F.coalesce("guesses", F.array().cast("array<string>"))
    pred, gold = fold_guess(fill_guesses(ranked, FALLBACK)), F.lower("gold")
    return scored.groupBy("lang").agg(
        F.sum("cnt").alias("n"),
        F.sum(F.when(F.contains(pred, gold), F.col("cnt")).otherwise(0)).alias("hits"),
        F.sum(F.when(F.substring(pred, 1, 1) == gold, F.col("cnt")).otherwise(0)).alias("top1_hits"),
    )


def token_path(train: DataFrame, n: int, size: int, max_len: int = 4) -> NgramModel:
    """The token path with a vocabulary of the ``size`` most frequent strings of the same lines."""
    chosen = tokens.token_vocabulary(train_counts(train, max_len), size, max_len)
    return tokens.token_model(train, [r["token"] for r in chosen.collect()], n)


def dense_routed_success(
    docs: DataFrame, n: int = 3, vocabulary: int = tokens.VOCABULARY, key: str = "doc_id"
) -> DataFrame:
    """Hits over every position of the held-out lines along the routed path, per language and path.

    English lines, by the ASCII share, take the byte model and the others a token model with tokens of varying
    length, each trained on the training lines of its side. Positions are aggregated to grams before any join.
    """
    lines = evaluation_lines(docs, key).withColumn("is_english", is_english_ascii(F.col("text")))
    train = lines.where(F.col("split") == "train")
    test = lines.where(F.col("split") == "test")
    held = stage(full_gram_counts(test, n, by=["lang", "is_english"]), "heldout")
    pairs = held.select(
        "lang", "is_english", "cnt", context(F.col("g")).alias("key"), last_char(F.col("g")).alias("gold")
    )
    english = byte_model(train_counts(train.where(F.col("lang") == "en"), n), n)
    others = token_path(train.where(F.col("lang") != "en"), n, vocabulary)
    sides = []
    for side, model, fallback in ((True, english, BYTE_FALLBACK), (False, others, TOKEN_FALLBACK)):
        mine = pairs.where(F.col("is_english") == side)
        found = ngram_backoff_lookup(mine, model.topk, n)
        ranked = F.coalesce("guesses", F.array().cast("array<string>"))
        sides.append(mine.join(found, "key", "left").withColumn("pred", fold_guess(fill_guesses(ranked, fallback))))
    pred, gold = F.col("pred"), F.lower("gold")
    return sides[0].unionByName(sides[1]).groupBy("lang", "is_english").agg(
        F.sum("cnt").alias("n"),
        F.sum(F.when(F.contains(pred, gold), F.col("cnt")).otherwise(0)).alias("hits"),
        F.sum(F.when(F.substring(pred, 1, 1) == gold, F.col("cnt")).otherwise(0)).alias("top1_hits"),
    )


def job_train_eval(
    docs: DataFrame,
    n: int = 3,
    method: str = "addk",
    key: str = "doc_id",
    eval_size: int | None = None,
    loss: Callable[[Column], Column] = nll,
    **params: float,
) -> DataFrame:
    """Corpus, hold-out, counts, smoothed probabilities; loss, perplexity and strict accuracy per language.

    Accuracy is the share of held-out positions whose first guess is the very character. ``eval_size`` holds out the
    head (``holdout.EVAL_SIZE`` lines by default there), ``loss`` replaces the log loss.
    """
    if method == "backoff":
        raise ValueError("back-off scores are not probabilities and have no perplexity")
    lines = evaluation_lines(docs, key, eval_size)
    counts = train_counts(lines.where(F.col("split") == "train"), n)
    held = stage(heldout_grams(lines.where(F.col("split") == "test"), n), "heldout")
    evidence = gram_evidence(held.select("g").distinct(), counts, n)
    p = smoothed_score(F.col("evidence"), vocabulary_size(counts), method, **params)
    scored = held.join(evidence.select("g", p.alias("p")), "g", "left")
    losses = perplexity(cross_entropy(scored, ["lang"], loss))
    asked = held.select("lang", "cnt", context(F.col("g")).alias("key"), last_char(F.col("g")).alias("gold"))
    first = asked.join(ngram_backoff_lookup(asked, ngram_topk(counts, 1), n, k=1), "key", "left")
    right = F.sum(F.when(F.col("guesses")[0] == F.col("gold"), F.col("cnt")).otherwise(0))
    return losses.join(first.groupBy("lang").agg((right / F.sum("cnt")).alias("accuracy")), "lang")


def job_predict_grade(
    docs: DataFrame, langs: Sequence[str], path: str, n: int = 5, key: str = "doc_id"
) -> DataFrame:
    """``(pos, lang, is_english, gold, pred, hit)`` for every held-out document.

    English prompts, by the detector, take the byte model and the others the token model, each trained on
    the training lines of its side; the detector too learns from training lines alone. The guesses are
    written to ``path``, one line per prompt, and graded as read back. Grade the rows with ``success_rate``.
    """
    lines = evaluation_lines(docs, key)
    train = lines.where(F.col("split") == "train")
    profiles = train_language_profiles(train, langs)
    sides = train_counts(
        train.withColumn("english", F.col("lang") == "en"), n + 1, by=["english"]
    )
    english = sides.where("english").drop("english")
    others = sides.where("not english").drop("english")
    inputs = prompts(lines.where(F.col("split") == "test"), key)
    routed = with_detected_language(inputs, profiles, "pos").withColumn(
        "is_english", is_english(F.col("text"), F.col("detected"))
    )
    routed = stage(routed.drop("detected"), "prompts")
    preds = route_predict(routed, byte_model(english, n), token_model(others, n))
    write_predictions(routed, preds, path)
    gold = with_rank(routed.select("pos", "lang", "is_english", "gold"), [], ["pos"], name="line")
    lines = read_lines(docs.sparkSession, path).select(F.col("pos").alias("line"), F.col("text").alias("pred"))
    return score_join(gold, lines, "line").drop("line")
