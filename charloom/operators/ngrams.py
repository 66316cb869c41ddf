"""Character n-gram counting, smoothing, look-up and perplexity.

One pass over the text counts *full grams*: for each character, the character with up to ``n - 1``
characters before it. Every lower order is a suffix of a full gram, so lower orders are aggregated from
the counted table and not from the text again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from charloom.functions.predicates import printable_candidate
from charloom.functions.text import strip_ws
from charloom.operators.runs import count_in_runs, grams

LOSS_LIMIT = 50.0
BACKOFF = 0.4
INTERPOLATION = 0.7


def char_windows(
    df: DataFrame, n: int, text: Column, keep: Sequence[str] = (), heads: bool = False
) -> DataFrame:
    """One row per run of ``n`` characters, as columns ``c0 .. c{n-1}``.

    The text is split into characters once; shifted slices of that array, zipped, give the runs without
    scanning the text again per position. ``heads`` pads the front with empty strings, so that the first
    characters also end a run, with the shorter context they have.
    """
    # An empty text splits into one empty string. Testing that, and not the text, keeps the optimiser from
    # moving a copy of a costly text expression down into a filter.
    rows = df.select(*keep, F.split(text, "").alias("_chars"))
    runs = F.when(F.col("_chars")[0] != "", F.size("_chars")).otherwise(0)
    if heads:
        padded = F.concat(F.array(*[F.lit("")] * (n - 1)), "_chars") if n > 1 else F.col("_chars")
    else:
        padded, runs = F.col("_chars"), F.greatest(F.lit(0), runs - F.lit(n - 1))
    rows = rows.select(*keep, padded.alias("_chars"), runs.alias("_runs"))
    shifted = [F.slice("_chars", i + 1, F.col("_runs")).alias(f"c{i}") for i in range(n)]
    return rows.select(*keep, F.inline(F.arrays_zip(*shifted)))


def joined(first: int, last: int) -> Column:
    """Columns ``c{first} .. c{last - 1}`` as one string."""
    return F.concat(*[F.col(f"c{i}") for i in range(first, last)]) if last > first else F.lit("")


def next_char_pairs(df: DataFrame, n: int, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """Training pairs ``(ctx, ch)``: ``n - 1`` characters and the one after them, a row per position."""
    runs = char_windows(df, n, F.col(text), keep)
    return runs.select(*keep, joined(0, n - 1).alias("ctx"), F.col(f"c{n - 1}").alias("ch"))


def ngram_counts(df: DataFrame, n: int, text: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """``(by, ctx, ch, cnt)``. Frequent grams collapse before the shuffle, a run of texts at a time."""
    counts = count_in_runs(df, F.col(text), by, ["g"], grams(n, heads=False))
    return counts.select(*by, context(F.col("g")).alias("ctx"), last_char(F.col("g")).alias("ch"), "cnt")


def full_gram_counts(df: DataFrame, n: int, text: str = "text", by: Sequence[str] = ()) -> DataFrame:
    """``(by, g, cnt)``: each position once, with as much context as it has, up to ``n - 1``."""
    return count_in_runs(df, F.col(text), by, ["g"], grams(n, heads=True))


def order_counts(full: DataFrame, n: int, by: Sequence[str] = ()) -> DataFrame:
    """``(by, g, cnt)`` for the grams of all orders ``1..n`` from full-gram counts."""
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.length("g"), F.lit(n))),
        lambda k: F.substr(F.col("g"), -k, k),
    )
    return (
        full.select(*by, F.explode(suffixes).alias("g"), "cnt")
        .groupBy(*by, "g")
        .agg(F.sum("cnt").alias("cnt"))
    )


def context(gram: Column) -> Column:
    """All but the last character."""
    return F.substr(gram, F.lit(1), F.length(gram) - 1)


def last_char(gram: Column) -> Column:
    return F.right(gram, F.lit(1))


def context_totals(counts: DataFrame) -> DataFrame:
    """``(ctx, total)`` from ``(g, cnt)`` of one or more orders."""
    return counts.groupBy(context(F.col("g")).alias("ctx")).agg(F.sum("cnt").alias("total"))


def add_k_probs(counts: DataFrame, vocabulary: int, k: float = 1.0) -> DataFrame:
    """P(ch | ctx) = (c + k) / (C + kV) for ``(ctx, ch, cnt)``."""
    totals = counts.groupBy("ctx").agg(F.sum("cnt").alias("total"))
    p = (F.col("cnt") + k) / (F.col("total") + k * vocabulary)
    return counts.join(totals, "ctx").select("ctx", "ch", "cnt", p.alias("p"))


def vocabulary_size(counts: DataFrame) -> int:
    """Distinct characters of ``(g, cnt)`` counts of all orders: the unigrams."""
    return counts.where(F.length("g") == 1).count()


def gram_evidence(queries: DataFrame, counts: DataFrame, n: int) -> DataFrame:
    """For each query gram, an array over orders 1..n of ``(o, c, total)``: its count and its context's.

    ``queries`` holds distinct grams in ``g`` and ``counts`` all orders (stage it: it is read several
    times). Each gram goes out once per suffix, at most ``n`` rows, and is folded back. Tables keyed by a
    single character are broadcast: Unicode bounds them, and their keys are the hot ones. Longer keys
    meet in equi-joins of aggregated tables.
    """

    def suffixes(low: int, high: int) -> DataFrame:
        top = F.least(F.length("g"), F.lit(high))
        return (
            queries.where(F.length("g") >= low)
            .select("g", F.explode(F.sequence(F.lit(low), top)).alias("o"))
            .select("g", "o", F.substr(F.col("g"), -F.col("o"), F.col("o")).alias("s"))
            .withColumn("ctx", context(F.col("s")))
        )

    seen = counts.select(F.col("g").alias("s"), F.col("cnt").alias("c"))
    unigrams = seen.where(F.length("s") == 1)
    everything = unigrams.agg(F.sum("c")).scalar()
    totals = context_totals(counts.where(F.length("g") >= 2))
    after_one = totals.where(F.length("ctx") == 1)
    found = [
        suffixes(1, 1)
        .join(F.broadcast(unigrams), "s", "left")
        .select("g", "o", "c", everything.alias("total"))
    ]
    if n >= 2:
        found.append(
            suffixes(2, 2)
            .join(seen.where(F.length("s") == 2), "s", "left")
            .join(F.broadcast(after_one), "ctx", "left")
            .select("g", "o", "c", "total")
        )
    if n >= 3:
        found.append(
            suffixes(3, n)
            .join(seen.where(F.length("s") >= 3), "s", "left")
            .join(totals.where(F.length("ctx") >= 2), "ctx", "left")
            .select("g", "o", "c", "total")
        )
    entry = F.struct(
        "o", F.coalesce("c", F.lit(0)).alias("c"), F.coalesce("total", F.lit(0)).alias("total")
    )
    return (
        reduce(lambda a, b: a.unionByName(b), found)
        .groupBy("g")
        .agg(F.array_sort(F.collect_list(entry)).alias("evidence"))
    )


def smoothed_score(
    evidence: Column,
    vocabulary: int,
    method: str = "addk",
    k: float = 1.0,
    lam: float = INTERPOLATION,
    alpha: float = BACKOFF,
) -> Column:
    """Score of a gram from its evidence array.

    ``addk``: (c + k) / (C + kV) at the highest order. ``interp``: p_o = lam * c/C + (1 - lam) * p_(o-1)
    over a uniform base, p_o = p_(o-1) for an unseen context; sums to one per context. ``backoff``:
    c/C of the longest seen gram times ``alpha`` per order given up; a ranking score, not a probability.
    """
    if method == "addk":
        top = F.element_at(evidence, -1)
        return (top["c"] + F.lit(k)) / (top["total"] + F.lit(k * vocabulary))
    if method == "interp":
        return F.aggregate(
            evidence,
            F.lit(1.0 / vocabulary),
            lambda p, e: F.when(
                e["total"] > 0, F.lit(lam) * e["c"] / e["total"] + F.lit(1.0 - lam) * p
            ).otherwise(p),
        )
    if method == "backoff":
        return F.aggregate(
            evidence,
            F.lit(0.0),
            lambda s, e: F.when(e["c"] > 0, e["c"] / e["total"]).otherwise(F.lit(alpha) * s),
        )
    raise ValueError(f"unknown smoothing method {method!r}")


def ngram_probs(
    counts: DataFrame,
    n: int,
    vocabulary: int,
    method: str = "addk",
    queries: DataFrame | None = None,
    **params: float,
) -> DataFrame:
    """``(g, p)`` for the distinct query grams; by default every gram of order ``n`` that was counted."""
    if queries is None:
        queries = counts.where(F.length("g") == n).select("g")
    else:
        queries = queries.select("g").distinct()
    found = gram_evidence(queries, counts, n)
    return found.select(
        "g", smoothed_score(F.col("evidence"), vocabulary, method, **params).alias("p")
    )


def nll(p: Column) -> Column:
    """Default loss of one prediction."""
    return -F.log(p)


def cross_entropy(
    scored: DataFrame,
    by: Sequence[str] = (),
    loss: Callable[[Column], Column] = nll,
    p: str = "p",
    cnt: str = "cnt",
) -> DataFrame:
    """Mean loss over ``cnt`` predictions per row; a NULL ``p`` is an ignored label."""
    used = F.col(p).isNotNull()
    total = F.sum(F.when(used, loss(F.col(p)) * F.col(cnt)))
    n = F.sum(F.when(used, F.col(cnt)))
    return scored.groupBy(*by).agg(n.alias("n"), (total / n).alias("loss"))


def perplexity(losses: DataFrame) -> DataFrame:
    """exp(loss) below the limit, infinity from there on."""
    return losses.withColumn(
        "ppl", F.when(F.col("loss") < LOSS_LIMIT, F.exp("loss")).otherwise(F.lit(float("inf")))
    )


def topk_per_row(
    df: DataFrame, by: Sequence[str], score: str, tie: Sequence[Column], k: int, rank: str = "rank"
) -> DataFrame:
    """The ``k`` best candidates of each row; ties keep the candidate that sorts first by ``tie``.

    A row's candidates are bounded by the vocabulary, and the group limit drops most before the shuffle.
    """
    w = Window.partitionBy(*by).orderBy(F.col(score).desc(), *tie)
    return df.withColumn(rank, F.row_number().over(w)).where(F.col(rank) <= k)


def ngram_topk(counts: DataFrame, k: int = 3) -> DataFrame:
    """``(ctx, tops)``: the ``k`` most frequent next characters of each context, best first."""
    pairs = counts.select(
        context(F.col("g")).alias("ctx"), last_char(F.col("g")).alias("ch"), "cnt"
    )
    best = topk_per_row(pairs, ["ctx"], "cnt", [F.col("ch")], k)
    return best.groupBy("ctx").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "ch"))), lambda e: e["ch"]
        ).alias("tops")
    )


def ngram_backoff_lookup(
    keys: DataFrame, topk: DataFrame, max_n: int, key: str = "key", k: int = 3
) -> DataFrame:
    """``(key, guesses)``: candidates of the longest known suffix first, then of shorter ones.

    The keys, suffixes of at most ``max_n - 1`` characters, are made distinct, so frequent text does not
    make a hot key. Each key goes out once per suffix of two or more characters and meets the table in one
    equi-join without a hint: the runtime size of the table decides between broadcast and shuffle.
    Contexts of one character are the hot ones and are bounded by Unicode, so they are broadcast; the
    empty context, which every key shares, is one row and comes in as a scalar.
    """
    none = F.array().cast("array<string>")
    found = keys.select(key).distinct().withColumn("longer", none)
    if max_n > 2:
        lengths = F.sequence(F.lit(2), F.greatest(F.lit(2), F.least(F.length(key), F.lit(max_n - 1))))
        long = topk.where(F.length("ctx").between(2, max_n - 1))
        parts = found.select(key, F.explode(lengths).alias("o")).withColumn(
            "ctx", F.substr(F.col(key), -F.col("o"), F.col("o"))
        )
        tops = F.collect_list(
            F.when(F.col("tops").isNotNull(), F.struct((-F.col("o")).alias("o"), "tops"))
        )
        found = (
            parts.join(long, "ctx", "left")
            .groupBy(key)
            .agg(F.flatten(F.transform(F.array_sort(tops), lambda e: e["tops"])).alias("longer"))
        )
    base = F.coalesce(topk.where(F.col("ctx") == "").select("tops").limit(1).scalar(), none)
    if max_n > 1:
        short = topk.where(F.length("ctx") == 1).select(F.col("ctx").alias("last"), "tops")
        found = found.withColumn("last", F.right(F.col(key), F.lit(1))).join(
            F.broadcast(short), "last", "left"
        )
        base = F.concat(F.coalesce("tops", none), base)
    guesses = F.slice(F.array_distinct(F.concat("longer", base)), 1, k)
    return found.select(key, guesses.alias("guesses"))


def marginalise_first_char(
    cands: DataFrame, by: Sequence[str], token: str = "token", logprob: str = "logprob", top_k: int = 5000
) -> DataFrame:
    """``(by, ch, logprob)``: log-sum-exp of the best ``top_k`` tokens that start with ``ch``.

    Two aggregates around the maximum keep the sum stable. Ranking and grouping share the partitioning
    by row, so this is one shuffle.
    """
    best = topk_per_row(cands, by, logprob, [F.col(token)], top_k).where(
        printable_candidate(F.col(token))
    )
    chars = best.withColumn("ch", F.substring(strip_ws(F.col(token)), 1, 1))
    peak = F.max(logprob).over(Window.partitionBy(*by, "ch"))
    return (
        chars.withColumn("_m", peak)
        .groupBy(*by, "ch")
        .agg(
            (F.max("_m") + F.log(F.sum(F.exp(F.col(logprob) - F.col("_m"))))).alias("logprob"),
            F.min("rank").alias("first_rank"),
        )
    )
