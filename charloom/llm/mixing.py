"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from charloom.llm.common import shield, unshield, word_count
from charloom.operators.positions import with_rank
from charloom.session import stage

#: Ranges of the sampling key per source; only the range that holds the cut is sorted row by row.
KEY_RANGES = 4096


def text_quality(text: Column, size: Column) -> Column:
    """A weight in (0, 1] without a model: 1 for running prose, less for tables, junk and fragments.

    Texts of at least 20 words of 2 to 12 characters on average weigh 1; a missing one of both halves the
    weight. NULL weighs 0.25.
    """
    mean = F.length(text) / F.greatest(size, F.lit(1))
    return F.when(size >= 20, 1.0).otherwise(0.5) * F.when((mean >= 3) & (mean <= 13), 1.0).otherwise(0.5)


def exponential_key(key: Column, weight: Column, seed: str) -> Column:
    """``-ln(u) / weight`` with ``u`` from the MD5 of seed and key: the smallest keys are sampled first."""
    digest = F.md5(F.concat(F.lit(seed), F.lit(":"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"))
    u = (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)
    return -F.log(u) / weight


def source_targets(sizes: DataFrame, total: int, weights: list[float], max_epochs: int) -> DataFrame:
    """Targets of sources ``(source, source_size)`` that sum to ``total`` and keep below ``max_epochs`` passes.

    Weights repeat over the sources in code point order, NULL last. A source that would pass its limit stops
    there and the excess is shared again by weight until none is above. Each round is one aggregate of the
    source table; only three numbers reach the driver.
    """
    ranked = with_rank(sizes.withColumn("_null", F.col("source").isNull()), [], ["_null", "source"], "_rank")
    n = len(weights)
    cycle = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_rank") % n + 1).cast("int"))
    sources = stage(
        ranked.select("source", "source_size", cycle.alias("_weight")).withColumn(
            "_limit", F.col("source_size") * float(max_epochs)
        ),
        "sources",
    )
    share, capped = 0.0, -1
    while True:
        # The first round shares by weight alone; later ones leave out the sources that are at their limit.
        full = F.col("_weight") * F.lit(share) > F.col("_limit") if capped >= 0 else F.lit(False)
        r = sources.agg(
            F.coalesce(F.sum(F.when(full, F.col("_limit"))), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~full, F.col("_weight"))), F.lit(0.0)),
            F.count(F.when(full, 1)),
        ).first()
        if r[2] == capped:
            break
        capped = r[2]
        if not r[1]:
            break
        share = (total - r[0]) / r[1]
    return sources.withColumn("target", F.least(F.col("_weight") * F.lit(share), F.col("_limit")))


def mix(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    quality: Column | None = None,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    max_epochs: int = 3,
    seed: str = "mix",
) -> DataFrame:
    """How many words of each document the mix takes.

    Returns the columns of ``docs`` with ``_size``, ``_source_size``, ``_target`` and ``_taken`` appended. A
    source whose target is ``k`` passes and a rest gives every document ``k`` times and fills the rest with
    whole documents in the order of their sampling keys; the document at the cut comes in where that brings
    the source nearer to its target. The text is not shuffled: sizes are summed per source and per range of
    keys, only the range with the cut is ordered, and the documents meet one row per source.

    NULL and empty texts have size 0 and take 0. NULL sources form one source, ordered last. Rows that
    repeat a key share its draw and come in or stay out together. A NULL key draws as the empty text. An
    empty table gives an empty result. Other columns pass through.
    """
    inner = {"_draw", "_of", "_passes", "_cut_slot", "_last"}
    docs, moved = shield(docs, inner, {"_size", "_source_size", "_target", "_taken"})
    size = word_count(F.col(text))
    weight = quality if quality is not None else text_quality(F.col(text), size)
    weight = F.coalesce(weight, F.lit(0.25))
    draw = exponential_key(F.col(key), weight, seed)
    slot = F.floor(F.lit(float(KEY_RANGES)) * (1 - F.exp(-F.col("_draw")))).cast("int")
    narrow = stage(
        docs.select(F.col(source).alias("source"), size.alias("size"), draw.alias("_draw"))
        .groupBy("source", "_draw")  # rows that repeat a key count as one
        .agg(F.sum("size").alias("size"))
        .withColumn("_slot", slot),
        "mix",
    )
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    total = narrow.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = (
        source_targets(sizes, total, list(weights), max_epochs)
        .withColumn("_passes", passes.cast("long"))
        .withColumn("_rest", F.col("target") - F.col("_passes") * F.col("source_size"))
        .select("source", "source_size", "target", "_passes", "_rest")
    )
    targets = stage(targets, "targets")

    same = narrow["source"].eqNullSafe(targets["source"])
    by_slot = Window.partitionBy("source").orderBy("_slot")
    slots = (
        narrow.groupBy("source", "_slot")
        .agg(F.sum("size").alias("_in"))
        .withColumn("_before", F.sum("_in").over(by_slot) - F.col("_in"))
    )
    cut_slot = (
        slots.join(targets, slots["source"].eqNullSafe(targets["source"]))
        .where((F.col("_before") < F.col("_rest")) & (F.col("_before") + F.col("_in") >= F.col("_rest")))
        .groupBy(slots["source"].alias("_src"))
        .agg(F.min(F.struct("_slot", "_before", "_rest")).alias("_cut"))
    )
    inside = narrow.join(
        cut_slot, narrow["source"].eqNullSafe(cut_slot["_src"]) & (narrow["_slot"] == F.col("_cut._slot"))
    )
    in_order = Window.partitionBy("_src").orderBy("_draw")
    upto = F.col("_cut._before") + F.sum("size").over(in_order)
    # A document that crosses the rest comes in if at least half of it still fits.
    fits = inside.select("_src", "_draw", "size", upto.alias("_upto"), F.col("_cut._rest").alias("_rest")).where(
        F.col("_upto") - F.col("size") / 2 <= F.col("_rest")
    )
    last = fits.groupBy("_src").agg(F.max("_draw").alias("_last"))
    slot_end = cut_slot.select("_src", F.col("_cut._slot").alias("_cut_slot"))
    plan = (
        targets.join(slot_end, targets["source"].eqNullSafe(slot_end["_src"]), "left")
        .drop("_src")
        .join(last, targets["source"].eqNullSafe(last["_src"]), "left")
        .select(
            targets["source"].alias("_of"),
            F.col("source_size").alias("_source_size"),
            F.col("target").alias("_target"),
            "_passes",
            "_cut_slot",
            "_last",
        )
    )
    plan = stage(plan, "plan")
    drawn = docs.withColumn("_size", size).withColumn("_draw", draw)
    below = (slot < F.col("_cut_slot")) | ((slot == F.col("_cut_slot")) & (F.col("_draw") <= F.col("_last")))
    extra = F.when(F.coalesce(below, F.lit(False)), F.col("_size")).otherwise(0)
    out = (
        drawn.join(plan, drawn[source].eqNullSafe(plan["_of"]))
        .withColumn("_taken", F.col("_passes") * F.col("_size") + extra)
        .select(*docs.columns, "_size", "_source_size", "_target", "_taken")
    )
    return unshield(out, moved)
