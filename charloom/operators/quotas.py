"""Caps: per-language quotas, the global cut, shard budgets, slices, tail trims and head limits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from charloom.functions.predicates import is_conversational, non_blank
from charloom.operators.positions import group_stats, head_of_groups, rank_window_filter

ALL = "all"
PAIR_CAP = 5_000_000


def quota_per_language(max_total: int, languages: int) -> int:
    """Ceiling share. Every requested language counts, also one that has no rows."""
    return max(1, -(-max_total // max(1, languages)))


def take_in_order(available: Mapping[object, int], order: Sequence, max_total: int) -> dict:
    """Rows each group may still give when groups are consumed in ``order`` up to ``max_total``."""
    takes, left = {}, max_total
    for group in order:
        takes[group] = max(0, min(available.get(group, 0), left))
        left -= takes[group]
    return takes


def language_quota(
    df: DataFrame, lang_order: Sequence[str], max_total: int, lang: str = "lang", pos: str = "pos"
) -> DataFrame:
    """The first ``ceil(max_total / languages)`` rows of each language by position."""
    q = quota_per_language(max_total, len(lang_order))
    by, key = F.col(lang), F.col(pos)
    head, stats = head_of_groups(df, by, key, list(lang_order), q)
    return rank_window_filter(head, by, key, {g: (0, q) for g in lang_order}, stats)


def global_cut(
    df: DataFrame, lang_order: Sequence[str], max_total: int, lang: str = "lang", pos: str = "pos"
) -> DataFrame:
    """The first ``max_total`` rows in (language order, position): the last languages lose rows."""
    by, key = F.col(lang), F.col(pos)
    members = df.where(by.isin(list(lang_order)))
    stats = group_stats(members, by, key)
    takes = take_in_order({g: s.rows for g, s in stats.items()}, lang_order, max_total)
    return rank_window_filter(members, by, key, {g: (0, k) for g, k in takes.items()}, stats)


def quota_and_cut(
    df: DataFrame, lang_order: Sequence[str], max_total: int, lang: str = "lang", pos: str = "pos"
) -> DataFrame:
    """``global_cut(language_quota(df))`` from one set of counts; reads only the head it needs."""
    q = quota_per_language(max_total, len(lang_order))
    by, key = F.col(lang), F.col(pos)
    head, stats = head_of_groups(df, by, key, list(lang_order), q)
    takes = take_in_order(
        {g: min(q, s.rows) for g, s in stats.items()}, lang_order, max_total
    )
    return rank_window_filter(head, by, key, {g: (0, k) for g, k in takes.items()}, stats)


def select_shards(
    manifest: DataFrame, k: int = 2, lang: str = "lang", pos: str = "pos", shard: str = "shard"
) -> DataFrame:
    """The first ``k`` shards of each language; blank manifest lines do not count.

    A manifest is a list of file names, so ranking it per language is small.
    """
    rank = F.row_number().over(Window.partitionBy(lang).orderBy(pos))
    return (
        manifest.where(non_blank(F.col(shard)))
        .withColumn("shard_rank", rank)
        .where(F.col("shard_rank") <= k)
    )


def shard_budget_quota(
    df: DataFrame,
    quota: int,
    shards: int,
    keep: Column | None = None,
    lang: str = "lang",
    shard_rank: str = "shard_rank",
    pos: str = "pos",
) -> DataFrame:
    """Kept rows per language under a budget of parsed rows.

    Shard ``s`` may contribute only its first ``R`` parsed rows, ``R`` being the quota left by the
    earlier shards, and ``keep`` filters after that cut. The loop runs over the few shards chosen per
    language; each step handles all languages at once and touches only that shard's rows.
    """
    keep = is_conversational(F.col("register")) if keep is None else keep
    by, key = F.col(lang), F.col(pos)
    taken: dict[object, int] = {}
    parts = []
    for s in range(1, shards + 1):
        rows = df.where(F.col(shard_rank) == s)
        stats = group_stats(rows, by, key)
        spans = {g: (0, quota - taken.get(g, 0)) for g in stats}
        kept = rank_window_filter(rows, by, key, spans, stats).where(keep)
        parts.append(kept)
        if s < shards:
            for r in kept.groupBy(by.alias("g")).count().collect():
                taken[r["g"]] = taken.get(r["g"], 0) + r["count"]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def slice_raw(df: DataFrame, offset: int, n: int, pos: str = "pos") -> DataFrame:
    """Raw rows ``[offset, offset + n)`` by dense position, any blank ones dropped afterwards."""
    return df.where((F.col(pos) >= offset) & (F.col(pos) < offset + n)).where(
        non_blank(F.col("text"))
    )


def slice_non_blank(df: DataFrame, offset: int, n: int, pos: str = "pos") -> DataFrame:
    """Skip ``offset`` raw rows, then the first ``n`` rows with text."""
    rows = df.where((F.col(pos) >= offset) & non_blank(F.col("text")))
    rows = rows.withColumn("_all", F.lit(ALL))
    by, key = F.col("_all"), F.col(pos)
    head, stats = head_of_groups(rows, by, key, [ALL], n)
    return rank_window_filter(head, by, key, {ALL: (0, n)}, stats).drop("_all")


def head_lines(
    df: DataFrame, file_order: Sequence, max_lines: int, file: str = "file", pos: str = "pos"
) -> DataFrame:
    """The first ``max_lines`` lines of files consumed one after the other; 0 keeps all."""
    if max_lines <= 0:
        return df.where(F.col(file).isin(list(file_order)))
    by, key = F.col(file), F.col(pos)
    head, stats = head_of_groups(df, by, key, list(file_order)[:1], max_lines)
    first = file_order[0] if file_order else None
    if first in stats and stats[first].rows >= max_lines:
        return rank_window_filter(head, by, key, {first: (0, max_lines)}, stats)
    return global_cut(df, file_order, max_lines, lang=file, pos=pos)


def pair_min_count(df: DataFrame, pair: str = "pair", lang: str = "lang") -> DataFrame:
    """Rows of the shorter side of each pair."""
    sides = df.groupBy(pair, lang).agg(F.count(F.lit(1)).alias("n"))
    return sides.groupBy(pair).agg(F.min("n").alias("min_count"))


def trim_from_top(
    df: DataFrame,
    max_lines: int = 0,
    cap: int = PAIR_CAP,
    pair: str = "pair",
    lang: str = "lang",
    pos: str = "pos",
) -> DataFrame:
    """Skip the top of an over-long pair so that the end of the common range survives.

    Both sides keep ranks ``(skip, skip + eff]`` with ``skip = max(0, shorter side - eff)``.
    """
    eff = cap if max_lines == 0 else min(max_lines, cap)
    side = F.concat_ws("\x1f", F.col(pair), F.col(lang))
    key = F.col(pos)
    stats = group_stats(df, side, key)
    shorter: dict[str, int] = {}
    for name, s in stats.items():
        p = name.rsplit("\x1f", 1)[0]
        shorter[p] = min(s.rows, shorter.get(p, s.rows))
    spans = {}
    for name in stats:
        skip = max(0, shorter[name.rsplit("\x1f", 1)[0]] - eff)
        spans[name] = (skip, skip + eff)
    return rank_window_filter(df, side, key, spans, stats)
