"""Positions and rank cut-offs without a global or per-group sort in one task.

Rank rules ("the first k rows of each language") are answered with *cut-offs*: the key value at a given
rank is found from counts, and the rows are then kept by comparing their key with it. The text itself
is never shuffled and a group may be as large as the whole table. Only operators that must output the
rank itself use :func:`with_rank`.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from charloom.session import stage

FANOUT = 65_536
MAX_RANKED_KEYS = 1_000_000


@dataclass(frozen=True)
class GroupStats:
    rows: int
    low: int
    high: int


def group_stats(df: DataFrame, by: Column, key: Column) -> dict[object, GroupStats]:
    """Rows and key range per group. For grouping columns with few values (languages, sources, sides)."""
    rows = (
        df.groupBy(by.alias("g"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi"))
        .collect()
    )
    return {r["g"]: GroupStats(r["n"], r["lo"], r["hi"]) for r in rows}


def keys_at_ranks(
    df: DataFrame,
    by: Column,
    key: Column,
    wanted: Mapping[object, Iterable[int]],
    stats: Mapping[object, GroupStats],
    max_ranked: int = MAX_RANKED_KEYS,
) -> dict[tuple[object, int], int]:
    """The key at each wanted 1-based rank of its group, ``{(group, rank): key}``.

    ``key`` is an integer that is unique in its group. Each round counts the rows of ``FANOUT``
    equal slices of every open interval and keeps the slice that holds the rank; once an interval
    holds at most ``max_ranked`` rows its bare keys are ranked. Ranks outside a group are left out.
    """
    spark = df.sparkSession
    slim = df.select(by.alias("g"), key.cast("bigint").alias("k"))
    targets = []  # (id, group, low, high, rank inside the interval, rows in the interval)
    names = []
    for group, ranks in wanted.items():
        for rank in sorted(set(ranks)):
            s = stats.get(group)
            if s is not None and 1 <= rank <= s.rows:
                targets.append((len(names), group, s.low, s.high, rank, s.rows))
                names.append((group, rank))
    if not targets:
        return {}
    group_type = slim.schema["g"].dataType.simpleString()

    def open_rows(ts: list) -> DataFrame:
        # One row per wanted rank: as small as the argument, so the broadcast is bounded.
        bounds = spark.createDataFrame(
            [(t[0], t[1], t[2], t[3], (t[3] - t[2]) // FANOUT + 1, t[4]) for t in ts],
            f"t int, g {group_type}, lo bigint, hi bigint, width bigint, want bigint",
        )
        low, high = min(t[2] for t in ts), max(t[3] for t in ts)
        return (
            slim.where(F.col("k").between(low, high))
            .join(F.broadcast(bounds), slim["g"].eqNullSafe(bounds["g"]))
            .drop(bounds["g"])
            .where(F.col("k").between(F.col("lo"), F.col("hi")))
        )

    while any(t[5] > max_ranked and t[3] > t[2] for t in targets):
        closed = [t for t in targets if t[5] <= max_ranked or t[3] == t[2]]
        wide = [t for t in targets if t[5] > max_ranked and t[3] > t[2]]
        counts = (
            open_rows(wide)
            .groupBy("t", "want", "width", "lo", F.expr("(k - lo) div width").alias("slice"))
            .agg(F.count(F.lit(1)).alias("n"))
        )
        # At most FANOUT slices per wanted rank reach this window.
        upto = F.sum("n").over(Window.partitionBy("t").orderBy("slice"))
        hits = (
            counts.withColumn("upto", upto)
            .where((F.col("upto") >= F.col("want")) & (F.col("upto") - F.col("n") < F.col("want")))
            .collect()
        )
        by_id = {t[0]: t for t in wide}
        targets = closed
        for h in hits:
            old = by_id[h["t"]]
            low = old[2] + h["slice"] * h["width"]
            high = min(old[3], low + h["width"] - 1)
            targets.append((old[0], old[1], low, high, h["want"] - (h["upto"] - h["n"]), h["n"]))

    ranked = open_rows(targets).withColumn(
        "r", F.row_number().over(Window.partitionBy("t").orderBy("k"))
    )
    found = ranked.where(F.col("r") == F.col("want")).select("t", "k").collect()
    return {names[row["t"]]: row["k"] for row in found}


def rank_window_filter(
    df: DataFrame,
    by: Column,
    key: Column,
    spans: Mapping[object, tuple[int, int]],
    stats: Mapping[object, GroupStats],
) -> DataFrame:
    """Keep the rows of ``df`` whose rank in their group lies in ``(after, upto]``.

    ``spans`` maps a group to ``(after, upto)``; groups without a span are dropped. The result is a
    plain filter with literal bounds, which the scan can use to skip files and row groups.
    """
    wanted: dict[object, set[int]] = {}
    for group, (after, upto) in spans.items():
        s = stats.get(group)
        if s is None or upto <= after or after >= s.rows:
            continue
        wanted[group] = {after + 1, min(upto, s.rows)}
    edges = {}
    search: dict[object, set[int]] = {}
    for group, ranks in wanted.items():
        s = stats[group]
        for rank in ranks:  # the ends of a group are known without a search
            if rank == 1:
                edges[(group, rank)] = s.low
            elif rank == s.rows:
                edges[(group, rank)] = s.high
            else:
                search.setdefault(group, set()).add(rank)
    edges.update(keys_at_ranks(df, by, key, search, stats))
    bounds = []
    for group, ranks in wanted.items():
        found = [edges[(group, r)] for r in ranks]
        bounds.append((group, min(found), max(found)))
    if not bounds:
        return df.where(F.lit(False))
    keep = reduce(
        lambda a, b: a | b, [(by.eqNullSafe(g)) & key.between(lo, hi) for g, lo, hi in bounds]
    )
    low, high = min(b[1] for b in bounds), max(b[2] for b in bounds)
    return df.where(key.between(low, high)).where(keep)


def head_of_groups(
    df: DataFrame, by: Column, key: Column, groups: list, k: int, growth: int = 64
) -> tuple[DataFrame, dict[object, GroupStats]]:
    """A leading part of ``df`` that holds the first ``k`` rows of every group, and its stats.

    Early stop for capped recipes: counts rows below a key bound and widens the bound until each
    group has ``k`` rows or the input ends, so only the head of a large corpus is read. Keys are
    row positions (at least 0).
    """
    members = df.where(by.isin(groups))
    bound = max(1024, 8 * k * max(1, len(groups)))
    while True:
        head = members.where(key < bound)
        stats = group_stats(head, by, key)
        full = all(g in stats and stats[g].rows >= k for g in groups)
        if full or members.where(key >= bound).select(F.lit(1)).limit(1).isEmpty():
            return head, stats
        bound *= growth


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    """Equality of the named columns, where NULL is a value like any other."""
    return reduce(lambda a, b: a & b, [left[c].eqNullSafe(right[c]) for c in names])


def with_rank(
    df: DataFrame,
    by: list[str],
    keys: list[str],
    name: str = "pos",
    partitions: int | None = None,
) -> DataFrame:
    """Add the 0-based dense rank of each row in its group, ordered by ``keys`` (unique per group).

    The rows are range-partitioned by ``(by, keys)``, sorted and staged with their partition number
    and their place in it, so both are stored data and not evaluated twice. A large group spreads over
    many partitions; the rank is the place plus the group's rows in earlier partitions. Hand in keys alone and
    join wide rows to their rank, so that no text is staged. A NULL group is a group.
    """
    order = [*by, *keys]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = stage(
        ranged.sortWithinPartitions(*order).select(
            "*",
            F.spark_partition_id().alias("_part"),
            F.monotonically_increasing_id().alias("_place"),
        ),
        "rank",
    )
    runs = placed.groupBy(*by, "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first")
    )
    # One row per (group, partition the group touches).
    earlier = Window.orderBy("_part") if not by else Window.partitionBy(*by).orderBy("_part")
    before = F.sum("_n").over(earlier) - F.col("_n")
    offsets = runs.select(*by, "_part", "_first", before.alias("_before"))
    return (
        placed.join(offsets, _same(placed, offsets, [*by, "_part"])).drop(*[offsets[c] for c in [*by, "_part"]])
        .withColumn(name, F.col("_before") + F.col("_place") - F.col("_first"))
        .drop("_part", "_place", "_first", "_before")
    )
