"""Train / held-out splits and source mixing, as flags and filters without a shuffle of the text."""

from __future__ import annotations

import math
from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from charloom.operators.positions import GroupStats, keys_at_ranks

EVAL_SIZE = 50_000
SHUFFLE_BITS = 60
PREFIX_BITS = 16


def head_holdout(df: DataFrame, eval_size: int = EVAL_SIZE, pos: str = "pos") -> DataFrame:
    """``split`` = eval for the first ``eval_size`` physical lines, train for the rest.

    Blank lines use up eval slots; drop them after the split.
    """
    return df.withColumn(
        "split", F.when(F.col(pos) < eval_size, F.lit("eval")).otherwise(F.lit("train"))
    )


def shuffle_key(key: Column, seed: int) -> Column:
    """``SHUFFLE_BITS`` bits of the MD5 of ``seed:key``; the order by this value is the seeded shuffle.

    Distinct keys: rows that share a value fall on the same side of a cut. A NULL key counts as empty text.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def holdout_size(rows: int, ratio: float, min_rows: int) -> int:
    """Rows of the test part; none below ``min_rows`` or without a ratio."""
    return math.ceil(rows * ratio) if rows >= min_rows and ratio > 0 else 0


def holdout_cut(
    keys: DataFrame, key: str, ratio: float = 0.05, seed: int = 42, min_rows: int = 20
) -> int | None:
    """The largest shuffle key of the test part, None for an empty test part.

    The first pass counts the rows of each 16-bit prefix of the shuffle key, which gives the row count and
    the prefix that holds the cut; the second looks at that prefix alone.
    """
    h = shuffle_key(F.col(key), seed)
    hashed = keys.select(h.alias("h"))
    low_bits = SHUFFLE_BITS - PREFIX_BITS
    counts = {
        r["p"]: r["n"]
        for r in hashed.groupBy(F.shiftright("h", low_bits).alias("p"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()  # at most 2 ** PREFIX_BITS rows
    }
    left = holdout_size(sum(counts.values()), ratio, min_rows)
    if left == 0:
        return None
    for prefix in sorted(counts):
        if left <= counts[prefix]:
            break
        left -= counts[prefix]
    low = prefix << low_bits
    stats = {0: GroupStats(counts[prefix], low, low + (1 << low_bits) - 1)}
    return keys_at_ranks(hashed, F.lit(0), F.col("h"), {0: [left]}, stats)[(0, left)]


def random_holdout(
    df: DataFrame,
    key: str,
    ratio: float = 0.05,
    seed: int = 42,
    min_rows: int = 20,
    keys: DataFrame | None = None,
) -> DataFrame:
    """``split`` = test for the first ``ceil(rows * ratio)`` rows of the seeded shuffle.

    The shuffle order is a hash of the key, so the test part is "hash up to a cut-off": the cut-off
    comes from counts over the key column, and the split is a map-side flag. ``keys`` may give the keys of
    ``df`` as a table of their own where ``df`` is costly to scan.
    """
    cut = holdout_cut(df if keys is None else keys, key, ratio, seed, min_rows)
    if cut is None:
        return df.withColumn("split", F.lit("train"))
    test = shuffle_key(F.col(key), seed) <= cut
    return df.withColumn("split", F.when(test, F.lit("test")).otherwise(F.lit("train")))


def mix_sources(sources: Mapping[str, tuple[DataFrame, float]], key: str) -> DataFrame:
    """Union of sources, each thinned to its weight by a hash of the key."""

    def part(name: str, df: DataFrame, weight: float) -> DataFrame:
        tagged = df.withColumn("mix_source", F.lit(name))
        if weight >= 1:
            return tagged
        limit = f"{max(0, int(weight * 2**32)):08x}"  # fixed-width hex sorts like the number
        return tagged.where(F.substring(F.md5(F.col(key).cast("string")), 1, 8) < limit)

    parts = [part(name, df, weight) for name, (df, weight) in sources.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
