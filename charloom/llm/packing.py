"""Packing token pieces into sequences by bin completion (operator 2)."""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from charloom.session import stage

CAPACITY = 2048
#: Fillings tried around the largest piece, steps of one enumeration, and bins set in the whole search.
FILLINGS, FILL_STEPS, SEARCH_NODES = 6, 1500, 12_000
#: Rows of one length that one task ranks.
RANK_ROWS = 200_000

Pattern = tuple[tuple[int, ...], int]  # lengths in a sequence, and how many sequences are filled so

# --- the search, over counts per length -------------------------------------------------------------


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Fewest sequences possible: the waste bound of Martello and Toth over all thresholds."""
    n = np.zeros(capacity + 1, np.int64)
    for length, count in counts.items():
        n[length] = count
    mass = n * np.arange(capacity + 1)
    above, weight = np.cumsum(n[::-1])[::-1], np.cumsum(mass)
    best = -(-int(mass.sum()) // capacity)
    half = capacity // 2
    for k in range(1, half + 1):
        alone = int(above[capacity - k + 1]) if k else 0
        large = int(above[half + 1]) - alone
        room = large * capacity - int(weight[capacity - k] - weight[half])
        small = int(weight[half] - weight[k - 1])
        best = max(best, alone + large + max(0, -(-(small - room) // capacity)))
    return best


def _covers(a: tuple[int, ...], b: tuple[int, ...]) -> bool:
    """Whether the pieces of ``b`` fit into those of ``a`` as bins: then ``a`` is as good a filling."""
    room = list(a)
    for x in b:
        at = min((i for i, r in enumerate(room) if r >= x), key=room.__getitem__, default=-1)
        if at < 0:
            return False
        room[at] -= x
    return True


def fillings(counts: dict[int, int], lengths: list[int], room: int) -> list[tuple[int, ...]]:
    """Undominated fillings of ``room``, least waste first. ``lengths``: those left, ascending."""
    found: list[tuple[int, ...]] = []
    steps = 0

    def used(chosen: list[int], x: int) -> bool:
        return counts[x] > chosen.count(x)

    def walk(chosen: list[int], room: int, top: int) -> None:
        nonlocal steps
        steps += 1
        if room <= top and counts.get(room, 0) and used(chosen, room):
            found.append((*chosen, room))  # a perfect end dominates every other one from here
            return
        fits, i = False, bisect_left(lengths, min(room, top) + 1) - 1
        while i >= 0 and steps < FILL_STEPS and len(found) < 4 * FILLINGS:
            x = lengths[i]
            if counts[x] and used(chosen, x):
                fits = True
                chosen.append(x)
                walk(chosen, room - x, x)
                chosen.pop()
            i -= 1
        if not fits:
            found.append(tuple(chosen))

    if room and lengths:
        walk([], room, room)
    else:
        found.append(())
    kept: list[tuple[int, ...]] = []
    for f in sorted(found, key=lambda f: (room - sum(f), len(f), [-x for x in f])):
        if not any(_covers(k, f) for k in kept):
            kept.append(f)
        if len(kept) == FILLINGS:
            break
    return kept


def complete_bins(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = SEARCH_NODES) -> list[Pattern]:
    """Patterns that pack all pieces: branch and bound over the fillings around the largest piece.

    A node fills the sequences of the largest length left with one filling, as often as the counts allow, so
    a node uses up a length and a descent has at most about ``capacity`` nodes. A branch ends when its waste
    leaves no way to beat the incumbent. The first descent, always the filling with the least waste, is the
    first (best-fit) incumbent; the search stops at the lower bound or after ``nodes`` nodes.
    """
    left = {k: v for k, v in counts.items() if v}
    total = sum(k * v for k, v in left.items())
    bound = lower_bound(left, capacity)
    best: list[Pattern] | None = None
    best_bins = len(left) and sum(left.values()) + 1
    path: list[Pattern] = []
    lengths = sorted(left)
    stack: list[Iterator[tuple[int, ...]]] = []
    bins = waste = 0

    def undo() -> None:
        nonlocal bins, waste
        pattern, times = path.pop()
        for x in pattern:
            left[x] += times
        bins -= times
        waste -= times * (capacity - sum(pattern))

    def options() -> Iterator[tuple[int, ...]]:
        while lengths and not left[lengths[-1]]:
            lengths.pop()
        top = lengths[-1]
        left[top] -= 1
        found = [(top, *f) for f in fillings(left, lengths, capacity - top)]
        left[top] += 1
        return iter(found)

    if not left:
        return []
    stack.append(options())
    while stack and nodes > 0:
        pattern = next(stack[-1], None)
        if pattern is None:
            stack.pop()
            if path:
                undo()
                lengths = sorted(k for k, v in left.items() if v)
            continue
        nodes -= 1
        times = min(left[x] // pattern.count(x) for x in set(pattern))
        for x in pattern:
            left[x] -= times
        path.append((pattern, times))
        bins += times
        waste += times * (capacity - sum(pattern))
        if best is not None and waste > (best_bins - 1) * capacity - total:
            undo()
            lengths = sorted(k for k, v in left.items() if v)
            continue
        if not any(left[x] for x in lengths):
            if bins < best_bins:
                best, best_bins = list(path), bins
            if best_bins <= bound:
                break
            undo()
            lengths = sorted(k for k, v in left.items() if v)
            continue
        stack.append(options())
    if best is None:  # the budget ended inside the first descent: finish it by best fit alone
        return path + [(f, t) for f, t in _finish({k: v for k, v in left.items() if v}, capacity)]
    return best


def _finish(left: dict[int, int], capacity: int) -> list[Pattern]:
    out: list[Pattern] = []
    while left:
        top = max(left)
        pattern, room = [top], capacity - top
        for x in sorted(left, reverse=True):
            while x <= room and left[x] > pattern.count(x):
                pattern.append(x)
                room -= x
        times = min(left[x] // pattern.count(x) for x in set(pattern))
        for x in pattern:
            left[x] -= times
        left = {k: v for k, v in left.items() if v}
        out.append((tuple(pattern), times))
    return out


# --- on Spark ---------------------------------------------------------------------------------------


def encoder(name: str):
    """Text to ids of the public vocabulary ``name``, equal to those of its JSON file in ``tokenizers``.

    The ranks of the same vocabulary encode three times as fast; a text that spells a special token goes
    through ``tokenizers`` itself.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole = Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))
    special = [t.content for t in whole.get_added_tokens_decoder().values()]

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            return whole.encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def token_pieces(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    capacity: int = CAPACITY,
    vocabulary: str = "byte_bpe_50k",
    with_ids: bool = True,
) -> DataFrame:
    """Token ids of each text and a closing id 0, cut into pieces of ``capacity``; the first may be shorter.

    Returns ``(key, piece, start, length, ids_crc32[, ids])``. NULL and empty texts give one piece with the id 0.
    A NULL key passes through. Each row is encoded by itself, whatever its key.
    """
    kind = docs.schema[key].dataType
    fields = [
        T.StructField(key, T.StringType()),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        *([T.StructField("ids", T.ArrayType(T.IntegerType()))] if with_ids else []),
    ]
    names = [f.name for f in fields]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(vocabulary)
        for batch in batches:
            rows = []
            for k, t in zip(batch[names[0]], batch["_text"], strict=True):
                ids = np.array([*(encode(t) if t else ()), 0], dtype="<u4")
                cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
                for i, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    part = ids[a:b]
                    row = (k, i, a, b - a, zlib.crc32(part.tobytes()))
                    rows.append((*row, part.astype(np.int32)) if with_ids else row)
                if len(rows) >= 20_000:
                    yield _frame(rows, names)
                    rows = []
            yield _frame(rows, names)

    # The key travels as text, for pandas turns whole numbers beside NULLs into floating ones.
    narrow = docs.select(F.col(key).cast("string").alias(key), F.col(text).alias("_text"))
    return narrow.mapInPandas(run, T.StructType(fields)).withColumn(key, F.col(key).cast(kind))


def _frame(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names, dtype=object)
    return out.astype({c: "int64" for c in names[1:5]}) if len(out) else out


def _slots(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Where the ranked pieces of each length go: runs of ranks, each one slot of one pattern."""
    used: dict[int, int] = {}
    rows = []
    sequence = 0
    for pattern, times in patterns:
        offset = 0
        for x in pattern:
            rank = used.get(x, 0)
            rows.append((x, rank, sequence, offset))
            used[x] = rank + times
            offset += x
        sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 4)
    return {c: table[:, i] for i, c in enumerate(("length", "rank", "sequence", "offset"))}


def pack(pieces: DataFrame, *, length: str = "length", order: list[str], capacity: int = CAPACITY) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to pieces so that sequences of ``capacity`` hold all of them.

    Which lengths share a sequence depends on the counts per length alone, at most ``capacity`` numbers: the
    driver searches over those, and the answer is a list of patterns with the number of sequences of each, of
    bounded size too. The pieces themselves are then ranked within their length, split over salts by a count
    known beforehand, and look up their slot, so no length is one task however many pieces have it.

    Pieces longer than ``capacity`` or shorter than 1 have no place and raise an error. Pieces that agree in all
    of ``order`` and the length are interchangeable. An empty table gives an empty result.
    """
    spark = pieces.sparkSession
    counts = {r[0]: r[1] for r in pieces.groupBy(length).count().where(F.col(length).isNotNull()).collect()}
    if any(not 1 <= x <= capacity for x in counts):
        raise ValueError(f"pieces must have 1 to {capacity} tokens")
    slots = _slots(complete_bins(counts, capacity))

    salted = {x: -(-n // RANK_ROWS) for x, n in counts.items() if n > RANK_ROWS}
    salts = F.lit(1)
    if salted:
        pairs = [F.lit(v) for kv in salted.items() for v in kv]
        salts = F.coalesce(F.element_at(F.create_map(*pairs), F.col(length).cast("int")), F.lit(1))
    salt = F.pmod(F.xxhash64(*order), salts).cast("int")
    dealt = pieces.withColumn("_salt", salt)
    sums = dealt.groupBy(length, "_salt").agg(F.count(F.lit(1)).alias("_n"))
    ahead = F.sum("_n").over(Window.partitionBy(length).orderBy("_salt")) - F.col("_n")
    starts = sums.select(length, "_salt", ahead.alias("_ahead"))
    place = F.row_number().over(Window.partitionBy(length, "_salt").orderBy(*order))
    ranked = (
        dealt.join(starts, [length, "_salt"])
        .withColumn("_rank", F.col("_ahead") + place - 1)
        .drop("_salt", "_ahead")
    )
    shared = spark.sparkContext.broadcast(slots)

    @F.pandas_udf("sequence_id long, offset long")
    def slot(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        s = shared.value
        size = int(s["rank"].max()) + 1 if len(s["rank"]) else 1
        at = np.searchsorted(s["length"] * size + s["rank"], length * size + np.minimum(rank, size - 1), "right") - 1
        extra = rank.to_numpy() - s["rank"][at]
        return pd.DataFrame({"sequence_id": s["sequence"][at] + extra, "offset": s["offset"][at]})

    return (
        ranked.withColumn("_slot", slot(F.col(length).cast("long"), F.col("_rank").cast("long")))
        .select(*pieces.columns, "_slot.sequence_id", "_slot.offset")
    )


def pack_documents(docs: DataFrame, *, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY, **options) -> DataFrame:
    """Encode, cut and pack texts: the pieces of ``token_pieces`` with their sequence and place in it."""
    pieces = stage(token_pieces(docs, key=key, text=text, capacity=capacity, **options), "pieces")
    return pack(pieces, order=[key, "piece", "start", "ids_crc32"], capacity=capacity)


def sequences(packed: DataFrame) -> DataFrame:
    """Whole sequences ``(sequence_id, ids)`` of packed pieces that carry their ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(parts, lambda p: p["ids"])).alias("ids"))
