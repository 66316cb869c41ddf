"""Joining, flattening, counting and auditing of corpora."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from charloom.functions.predicates import NON_ASCII, has_keyword, is_english_ascii, non_blank
from charloom.functions.text import collapse_ws, strip_ws, words
from charloom.operators.positions import with_rank


def union_sources(dfs: Sequence[DataFrame]) -> DataFrame:
    """Bag union in the given order; nothing is deduplicated."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def concat_corpora(dfs: Sequence[DataFrame | None], text: str = "text") -> DataFrame | None:
    """Lines of several corpora tagged with ``source_rank``; None when any corpus is missing.

    Blank lines go, the others stay as they are, surrounding whitespace included.
    """
    if not dfs or any(df is None for df in dfs):
        return None
    return union_sources(
        [
            df.where(non_blank(F.col(text))).withColumn("source_rank", F.lit(i))
            for i, df in enumerate(dfs)
        ]
    )


def flatten_conversation(
    df: DataFrame,
    by: str = "conv_id",
    order: str = "turn",
    text: str = "text",
    chunk_turns: int = 1024,
) -> DataFrame:
    """One line per conversation from one row per turn; conversations without text are dropped.

    Turns are first joined in runs of ``chunk_turns``, so a very long conversation is put together
    from few strings by many tasks and its turns never meet in one buffer.
    """
    clean = df.where(non_blank(F.col(text))).select(
        by,
        F.expr(f"{order} div {chunk_turns}").alias("_run"),
        F.struct(F.col(order).alias("o"), collapse_ws(F.col(text)).alias("t")).alias("_turn"),
    )
    runs = clean.groupBy(by, "_run").agg(F.array_sort(F.collect_list("_turn")).alias("turns"))
    lines = runs.select(
        by,
        F.struct(F.col("_run").alias("o"), F.array_join("turns.t", " ").alias("t")).alias("_line"),
    )
    joined = lines.groupBy(by).agg(F.array_sort(F.collect_list("_line")).alias("runs"))
    return joined.select(by, F.array_join("runs.t", " ").alias("text"))


def flatten_turns(turns: Column) -> Column:
    """The same for an array of ``{from, value}`` turns held in one row."""
    values = F.filter(F.transform(turns, lambda t: t["value"]), lambda v: non_blank(v))
    return collapse_ws(F.array_join(F.transform(values, strip_ws), " "))


def align_pairs(df: DataFrame, pair: str = "pair", lang: str = "lang", pos: str = "pos") -> DataFrame:
    """Lines of the two sides of each pair that have the same rank on their side.

    Ranks above the shorter side have no partner. The join key is unique per side, so one large pair
    spreads over all partitions.
    """
    ranked = with_rank(df.select(pair, lang, pos), [pair, lang], [pos], name="rank")
    first, second = F.split(F.col(pair), "-")[0], F.split(F.col(pair), "-")[1]
    left = ranked.where(F.col(lang) == first).select(pair, "rank", F.col(pos).alias("pos_1"))
    right = ranked.where(F.col(lang) == second).select(pair, "rank", F.col(pos).alias("pos_2"))
    aligned = left.join(right, [pair, "rank"])
    # Only the lines that have a partner meet their texts.
    for i, side in (("1", first), ("2", second)):
        texts = df.where(F.col(lang) == side).select(pair, F.col(pos).alias(f"pos_{i}"), F.col("text").alias(f"text_{i}"))
        aligned = aligned.join(texts, [pair, f"pos_{i}"])
    return aligned


def split_counts(
    df: DataFrame, english: Callable[[Column], Column] = is_english_ascii, text: str = "text"
) -> DataFrame:
    """Non-blank rows per English / non-English; ``english`` is any ``Column -> Column`` detector."""
    return (
        df.where(non_blank(F.col(text)))
        .groupBy(english(F.col(text)).alias("is_english"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def line_count_non_blank(
    df: DataFrame, by: str = "file", pos: str = "pos", skip_head: int = 0, text: str = "text"
) -> DataFrame:
    """Non-blank lines per file after ``skip_head`` physical lines."""
    counted = (F.col(pos) >= skip_head) & non_blank(F.col(text))
    return df.groupBy(by).agg(F.count_if(counted).alias("n"))


def token_batch_stats(
    df: DataFrame, by: str, max_len: int = 1024, multiple: int = 64, batch: int = 32, text: str = "text"
) -> DataFrame:
    """Token totals, clipped rows, padding waste and step count per group for byte tokens."""
    limit = max(multiple, max_len // multiple * multiple)
    n = F.octet_length(F.col(text)).cast("bigint")
    kept = F.least(n, F.lit(limit))
    padded = F.ceil(kept / multiple) * multiple
    rows = F.count(F.lit(1))
    return df.groupBy(by).agg(
        rows.alias("n_rows"),
        F.sum(n).alias("tokens"),
        F.count_if(n > limit).alias("clipped_rows"),
        F.lit(limit).cast("bigint").alias("aligned_limit"),
        F.sum(padded - kept).cast("bigint").alias("padding"),
        F.greatest(F.lit(1), F.floor(rows / batch)).cast("bigint").alias("steps"),
    )


def utf8_audit(df: DataFrame, by: str, text: str = "text") -> DataFrame:
    """Characters per UTF-8 length class and rows that are not valid UTF-8, per group."""
    valid = F.is_valid_utf8(F.col(text))
    t = F.make_valid_utf8(F.col(text))
    two = F.regexp_count(t, F.lit(r"[\x{80}-\x{7ff}]"))
    three = F.regexp_count(t, F.lit(r"[\x{800}-\x{ffff}]"))
    four = F.regexp_count(t, F.lit(r"[\x{10000}-\x{10ffff}]"))
    other = F.regexp_count(t, F.lit(NON_ASCII))
    return (
        df.select(
            by,
            valid.alias("valid"),
            (F.length(t) - other).cast("bigint").alias("one"),
            two.alias("two"),
            three.alias("three"),
            four.alias("four"),
        )
        .groupBy(by)
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(~F.col("valid")).alias("invalid_rows"),
            F.sum("one").alias("chars_1"),
            F.sum("two").cast("bigint").alias("chars_2"),
            F.sum("three").cast("bigint").alias("chars_3"),
            F.sum("four").cast("bigint").alias("chars_4"),
        )
    )


def utf8_lead_class(byte: Column) -> Column:
    """Length of the character a lead byte starts, 0 for bytes that cannot start one."""
    return (
        F.when(byte < 0x80, 1)
        .when(byte.between(0xC2, 0xDF), 2)
        .when(byte.between(0xE0, 0xEF), 3)
        .when(byte.between(0xF0, 0xF4), 4)
        .otherwise(0)
    )


def _keyword_hits(df: DataFrame, keywords: DataFrame, key: str, text: str) -> DataFrame:
    terms = keywords.select(F.lower(F.col("word")).alias("_w")).distinct()
    found = df.select(key, F.explode(F.array_distinct(words(F.col(text)))).alias("_w"))
    return found.join(terms, "_w").select(key).distinct()


def domain_semi(df: DataFrame, keywords: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Rows with a word of the keyword table. For word lists too long for ``has_keyword``.

    Neither join is hinted: the optimiser broadcasts the word list while its measured size allows.
    """
    return df.join(_keyword_hits(df, keywords, key, text), key, "left_semi")


def domain_anti(df: DataFrame, keywords: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Rows without any word of the keyword table."""
    return df.join(_keyword_hits(df, keywords, key, text), key, "left_anti")


def domain_filter(
    df: DataFrame,
    keywords: Sequence[str],
    mode: str = "drop",
    weight: float = 0.5,
    text: str = "text",
) -> DataFrame:
    """Down-weight or drop rows that hold a keyword, or keep only those: drop, keep or weight."""
    hit = F.coalesce(has_keyword(F.col(text), keywords), F.lit(False))
    if mode == "drop":
        return df.where(~hit)
    if mode == "keep":
        return df.where(hit)
    return df.withColumn("weight", F.when(hit, F.lit(weight)).otherwise(F.lit(1.0)))
