"""Smoothing with learnt parameters: modified Kneser-Ney, and deleted interpolation by expectation-maximisation.

Both work on counts of all orders ``(g, cnt)`` as ``ngrams.order_counts`` gives them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from charloom.operators.ngrams import context, gram_evidence, vocabulary_size
from charloom.session import stage

# --- modified Kneser-Ney ---------------------------------------------------------------------------


def continuation_counts(counts: DataFrame, n: int) -> DataFrame:
    """``(g, a)``: what each gram counts for. Grams of order ``n`` count as often as they occur.

    Shorter ones count their distinct left neighbours; the front of a text is a neighbour of its own. One aggregate
    of the longer grams by their suffix and one join.
    """
    longer = counts.where(F.length("g") > 1).select(F.expr("substring(g, 2)").alias("_s"), F.col("cnt").alias("_c"))
    around = longer.groupBy("_s").agg(F.count(F.lit(1)).alias("_lefts"), F.sum("_c").alias("_inside"))
    front = (F.col("cnt") > F.coalesce("_inside", F.lit(0))).cast("bigint")
    lower = counts.where(F.length("g") < n).join(around, F.col("g") == F.col("_s"), "left")
    return (
        lower.select("g", (F.coalesce("_lefts", F.lit(0)) + front).alias("a"))
        .unionByName(counts.where(F.length("g") == n).select("g", F.col("cnt").alias("a")))
    )


def discounts(times: Mapping[int, int]) -> tuple[float, float, float]:
    """What is taken from grams that count once, twice, and more often, from how many grams count 1, 2, 3 and 4.

    Where a ratio of these has no value, the single discount of all stands in, a half if there is none either; a discount is
    never below 0 or above the count it is taken from.
    """
    t = [times.get(j, 0) for j in range(5)]
    base = t[1] / (t[1] + 2 * t[2]) if t[1] else 0.5
    found = [j - (j + 1) * base * t[j + 1] / t[j] if t[j] else base for j in (1, 2, 3)]
    return tuple(min(max(d, 0.0), float(j)) for j, d in enumerate(found, 1))


@dataclass(frozen=True)
class KneserNey:
    """``grams``: ``(g, own)``, a gram's share of its context after the discount. ``contexts``: ``(ctx, back)``, the
    share that is handed down to the shorter context. ``discounts``: three numbers per order."""

    grams: DataFrame
    contexts: DataFrame
    vocabulary: int
    n: int
    discounts: dict[int, tuple[float, float, float]]


def kneser_ney(counts: DataFrame, n: int) -> KneserNey:
    """The interpolated model of order ``n`` with three discounts per order.

    Only the numbers of grams that count one to four times reach the driver, four per order.
    """
    adjusted = stage(continuation_counts(counts, n), "continuations")
    rows = adjusted.where(F.col("a") <= 4).groupBy(F.length("g").alias("o"), "a").count().collect()
    found = {o: discounts({r["a"]: r["count"] for r in rows if r["o"] == o}) for o in range(1, n + 1)}

    def taken(order: int) -> Column:
        one, two, more = (F.lit(d) for d in found[order])
        return F.when(F.col("a") == 1, one).when(F.col("a") == 2, two).otherwise(more)

    each = reduce(lambda c, o: c.when(F.length("g") == o, taken(o)), range(2, n + 1), F.when(F.length("g") == 1, taken(1)))
    shares = adjusted.select("g", "a", context(F.col("g")).alias("ctx"), each.alias("d"))
    contexts = stage(
        shares.groupBy("ctx").agg(F.sum("a").alias("total"), (F.sum("d") / F.sum("a")).alias("back")), "contexts"
    )
    grams = shares.join(contexts, "ctx").select("g", ((F.col("a") - F.col("d")) / F.col("total")).alias("own"))
    return KneserNey(stage(grams, "own"), contexts.select("ctx", "back"), vocabulary_size(counts), n, found)


def kneser_ney_probs(model: KneserNey, queries: DataFrame) -> DataFrame:
    """``(g, p)`` for the distinct query grams of up to ``n`` characters.

    p = own + back * p of the gram without its first character, over a uniform base; an unseen context hands all
    down. Sums to one per context over the vocabulary. Tables keyed by at most one character are bounded by Unicode
    and broadcast; longer keys meet in equi-joins of aggregated tables.
    """
    asked = queries.select("g").distinct()

    def parts(low: int, high: int) -> DataFrame:
        orders = F.sequence(F.lit(low), F.least(F.length("g"), F.lit(high)))
        return (
            asked.where(F.length("g") >= low)
            .select("g", F.explode(orders).alias("o"))
            .select("g", "o", F.substr(F.col("g"), -F.col("o"), F.col("o")).alias("s"))
            .withColumn("ctx", context(F.col("s")))
        )

    own, back = model.grams.withColumnRenamed("g", "s"), model.contexts
    short = own.where(F.length("s") == 1)
    found = [parts(1, 1).join(F.broadcast(short), "s", "left").join(F.broadcast(back.where("ctx = ''")), "ctx", "left")]
    if model.n >= 2:
        one = F.broadcast(back.where(F.length("ctx") == 1))
        found.append(parts(2, 2).join(own.where(F.length("s") == 2), "s", "left").join(one, "ctx", "left"))
    if model.n >= 3:
        long = own.where(F.length("s") >= 3)
        found.append(parts(3, model.n).join(long, "s", "left").join(back.where(F.length("ctx") >= 2), "ctx", "left"))
    entry = F.struct("o", F.coalesce("own", F.lit(0.0)).alias("own"), F.coalesce("back", F.lit(1.0)).alias("back"))
    rows = reduce(lambda a, b: a.unionByName(b), [f.select("g", "o", "own", "back") for f in found])
    folded = rows.groupBy("g").agg(F.array_sort(F.collect_list(entry)).alias("evidence"))
    base = F.lit(1.0 / max(1, model.vocabulary))
    return folded.select("g", F.aggregate("evidence", base, lambda p, e: e["own"] + e["back"] * p).alias("p"))


# --- deleted interpolation --------------------------------------------------------------------------


def components(evidence: Column, n: int, vocabulary: int) -> Column:
    """Probability of a gram by a uniform base and by each order alone; an order whose context is unseen, or longer than
    the gram, says what the one below says, so that each component sums to one per context."""
    start = F.array(F.lit(1.0 / max(1, vocabulary)))

    def step(found: Column, e: Column) -> Column:
        p = F.when(e["total"] > 0, e["c"] / e["total"]).otherwise(F.element_at(found, -1))
        return F.concat(found, F.array(p))

    known = F.aggregate(evidence, start, step)
    return F.concat(known, F.array_repeat(F.element_at(known, -1), F.lit(n + 1) - F.size(known)))


def evidence_bucket(evidence: Column, n: int) -> Column:
    """How much is known about a gram's context: the decimal digits of its count at order ``n``; 0 where it is unseen or
    the gram is shorter."""
    top = F.element_at(evidence, -1)
    seen = (F.size(evidence) == n) & (top["total"] > 0)
    return F.when(seen, F.length(top["total"].cast("string"))).otherwise(0)


@dataclass(frozen=True)
class Interpolation:
    """``weights``: per bucket, one weight for the uniform base and one per order. ``likelihoods``: the log-likelihood of
    the held-out grams before each round and after the last."""

    weights: dict[int, tuple[float, ...]]
    likelihoods: tuple[float, ...]


def mixture(parts: Column, bucket: Column, weights: Mapping[int, Sequence[float]]) -> Column:
    """Weighted sum of the components; a bucket without weights of its own takes equal ones."""
    n = len(next(iter(weights.values()))) if weights else 1
    entries = [x for b, w in weights.items() for x in (F.lit(b), F.array(*[F.lit(float(v)) for v in w]))]
    table = F.create_map(*entries) if entries else F.create_map().cast("map<int,array<double>>")
    own = F.coalesce(F.try_element_at(table, bucket), F.array(*[F.lit(1.0 / n)] * n))
    return F.aggregate(F.zip_with(parts, own, lambda p, w: p * w), F.lit(0.0), lambda s, x: s + x)


def deleted_interpolation(
    held: DataFrame, counts: DataFrame, n: int, rounds: int = 50, tolerance: float = 1e-7
) -> Interpolation:
    """Weights of the orders that make held-out grams ``(g, cnt)`` likeliest, per bucket of evidence.

    Expectation-maximisation: each round is one aggregate of a staged table of aggregated grams, in which every gram
    deals its count out to the components by their shares of its probability; only ``n + 1`` sums per bucket, which are at
    most 20, reach the driver. Ends after ``rounds`` or when a round gains less than ``tolerance`` per held-out position.
    Likelihood never falls. An empty table gives no weights.
    """
    held = held.groupBy("g").agg(F.sum("cnt").alias("cnt"))
    found = gram_evidence(held.select("g"), counts, n)
    size = vocabulary_size(counts)
    table = stage(
        held.join(found, "g").select(
            "cnt", components(F.col("evidence"), n, size).alias("parts"), evidence_bucket(F.col("evidence"), n).alias("bucket")
        ),
        "components",
    )
    grams = {r["bucket"]: r["n"] for r in table.groupBy("bucket").agg(F.sum("cnt").alias("n")).collect()}
    weights = {b: (1.0 / (n + 1),) * (n + 1) for b in grams}
    likelihoods: list[float] = []
    while grams:
        p = mixture(F.col("parts"), F.col("bucket"), weights)
        scored = table.withColumn("p", p).where("p > 0")
        own = F.create_map(*[x for b, w in weights.items() for x in (F.lit(b), F.array(*[F.lit(v) for v in w]))])
        share = [F.sum(F.col("cnt") * F.col("parts")[o] * own[F.col("bucket")][o] / F.col("p")).alias(f"w{o}") for o in range(n + 1)]
        rows = scored.groupBy("bucket").agg(F.sum(F.col("cnt") * F.log("p")).alias("ll"), F.sum("cnt").alias("n"), *share).collect()
        likelihoods.append(math.fsum(r["ll"] for r in rows))
        gained = math.inf if len(likelihoods) < 2 else likelihoods[-1] - likelihoods[-2]
        if len(likelihoods) > rounds or gained < tolerance * sum(grams.values()):
            break
        weights |= {r["bucket"]: tuple(r[f"w{o}"] / r["n"] for o in range(n + 1)) for r in rows}
    return Interpolation(weights, tuple(likelihoods))


def interpolated_probs(counts: DataFrame, n: int, learnt: Interpolation, queries: DataFrame) -> DataFrame:
    """``(g, p)`` of the distinct query grams under learnt weights; ``counts`` are those that the weights were learnt with."""
    found = gram_evidence(queries.select("g").distinct(), counts, n)
    parts = components(F.col("evidence"), n, vocabulary_size(counts))
    return found.select("g", mixture(parts, evidence_bucket(F.col("evidence"), n), learnt.weights).alias("p"))
