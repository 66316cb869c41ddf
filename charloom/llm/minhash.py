"""Near-duplicate texts by MinHash with sequential Bayesian verification (operator 7)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from charloom.llm.common import block_pairs, components
from charloom.session import stage

#: Bands of rows: a pair at 0.8 shares no band with probability 3e-6.
BANDS, ROWS = 42, 6
HASHES = BANDS * ROWS
#: Signature hashes that are compared before each decision.
BATCH = 36
#: A pair is pruned when the posterior that it reaches the threshold falls below this.
MISS = 1e-3
#: Shingles of one block of a bucket, and the least that a member counts for.
BLOCK_SHINGLES, LEAST_SHINGLES = 1 << 20, 256
#: Shingle hashes that are processed at a time.
CHUNK = 1 << 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def with_shingles(df: DataFrame, text: str, words: int) -> DataFrame:
    """Replace a text by ``set``, the distinct hashed shingles of the whole text; NULL if it has no word.

    The whole sequence is the one shingle of a shorter text. The words are a column of their own, so that they are
    not split again for each shingle.
    """
    split = F.split(F.translate(F.col(text), UPPER, LOWER), "[\\x20\\x09-\\x0D]+")
    cut = df.withColumn("_words", F.filter(split, lambda x: x != ""))
    at = F.sequence(F.lit(1), F.greatest(F.size("_words") - words + 1, F.lit(1)))
    made = F.array_distinct(F.transform(at, lambda i: F.xxhash64(F.slice("_words", i, words))))
    return cut.withColumn("set", F.when(F.size("_words") > 0, made)).drop(text, "_words")


def _constants() -> tuple[np.ndarray, np.ndarray]:
    r = np.random.default_rng(20_240_229)
    return r.integers(0, 1 << 32, HASHES, dtype=np.uint32), r.integers(0, 1 << 31, HASHES, dtype=np.uint32) * 2 + 1


def signatures(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """MinHash signatures (rows x ``HASHES``) of non-empty sets laid end to end.

    The low 16 bits of each minimum are kept: different minima look equal once in 65,536, far below what the
    decisions depend on, and a signature has half the size.
    """
    mask, odd = _constants()
    v = (values.view(np.uint64) >> np.uint64(32)).astype(np.uint32)
    out = np.zeros((len(starts), HASHES), np.uint16)
    ends = np.append(starts[1:], len(v))
    row = 0
    while row < len(starts):
        last = max(row, int(np.searchsorted(ends, starts[row] + CHUNK, "right")) - 1)
        part, at = v[starts[row] : ends[last]], starts[row : last + 1] - starts[row]
        x = np.empty_like(part)
        y = np.empty_like(part)
        for k in range(HASHES):
            np.bitwise_xor(part, mask[k], out=x)
            np.multiply(x, odd[k], out=x)
            np.right_shift(x, 15, out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, np.uint32(0x9E3779B1), out=x)
            out[row : last + 1, k] = np.minimum.reduceat(x, at).astype(np.uint16)
        row = last + 1
    return out


def sketch(sets: DataFrame) -> DataFrame:
    """``(_key, _text, set)`` to ``(_key, _text, n_shingles, node, signature)``; NULL sets have no node.

    ``node`` is a digest of the whole set: texts with equal sets are one node. A batch of sets is one flat
    array, so nothing is done per word in Python.
    """
    key = sets.schema["_key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("set")
            at = column.offsets.to_numpy().astype(np.int64)
            values = column.values.to_numpy(zero_copy_only=False)
            sizes = np.where(column.is_null().to_numpy(zero_copy_only=False), 0, np.diff(at))
            full = np.flatnonzero(sizes)
            n = batch.num_rows
            node, sig = [None] * n, [None] * n
            if len(full):
                s = sizes[full]
                flat = np.concatenate([values[at[i] : at[i] + k] for i, k in zip(full, s, strict=True)])
                starts = np.cumsum(s) - s
                made = signatures(flat, starts)
                for j, i in enumerate(full):
                    own = np.sort(flat[starts[j] : starts[j] + s[j]])
                    node[i] = hashlib.blake2b(own.tobytes(), digest_size=16).digest()
                    sig[i] = made[j].tobytes()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_key"),
                    batch.column("_text"),
                    pa.array(sizes, pa.int64()),
                    pa.array(node, pa.binary()),
                    pa.array(sig, pa.binary()),
                ],
                names=["_key", "_text", "n_shingles", "node", "signature"],
            )

    kinds = f"_key {key}, _text long, n_shingles long, node binary, signature binary"
    return sets.mapInArrow(run, kinds)


def fewest_matches(threshold: float, miss: float = MISS) -> list[tuple[int, int]]:
    """``(n, m)``: after ``n`` hashes a pair with fewer than ``m`` equal ones is pruned.

    With a uniform prior the similarity given ``m`` of ``n`` is Beta(m + 1, n - m + 1); the pair goes if less
    than ``miss`` of that lies at or above the threshold.
    """
    grid = (np.arange(20_000) + 0.5) / 20_000
    yes, no, above = np.log(grid), np.log1p(-grid), grid >= threshold

    def part(m: int, n: int) -> float:
        density = m * yes + (n - m) * no
        density = np.exp(density - density.max())
        return density[above].sum() / density.sum()

    # One density at a time: those of all ``m`` together would take 100 MB of the driver.
    return [(n, next((m for m in range(n + 1) if part(m, n) >= miss), 0)) for n in range(BATCH, HASHES + 1, BATCH)]


def similar(left: np.ndarray, right: np.ndarray, limits: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Rows of two signature arrays that survive, and their equal hashes: batches go on until a bound prunes."""
    alive, equal, seen = np.arange(len(right)), np.zeros(len(right), np.int64), 0
    for n, m in limits:
        if not len(alive):
            break
        one = left[:, seen:n] if len(left) == 1 else left[alive, seen:n]
        equal[alive] += (one == right[alive, seen:n]).sum(1)
        alive = alive[equal[alive] >= m]
        seen = n
    return alive, equal[alive]


def _unpack(column: pd.Series | list) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint16).reshape(-1, HASHES)


def _surviving(pairs: DataFrame, sketches: DataFrame, threshold: float) -> DataFrame:
    """Pairs ``(a, b)`` of nodes whose signatures do not rule them out."""
    limits = fewest_matches(threshold)

    @F.pandas_udf("boolean")
    def survives(x: pd.Series, y: pd.Series) -> pd.Series:
        kept = np.zeros(len(x), bool)
        if len(x):
            kept[similar(_unpack(x), _unpack(y), limits)[0]] = True
        return pd.Series(kept)

    left = sketches.select(F.col("node").alias("a"), F.col("signature").alias("_x"))
    right = sketches.select(F.col("node").alias("b"), F.col("signature").alias("_y"))
    return pairs.join(left, "a").join(right, "b").where(survives("_x", "_y")).select("a", "b")


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Pairs whose full sets reach the threshold, counted inside the JVM."""
    left = sets.select(F.col("node").alias("a"), F.col("set").alias("_x"))
    right = sets.select(F.col("node").alias("b"), F.col("set").alias("_y"))
    both = pairs.join(left, "a").join(right, "b")
    shared = F.size(F.array_intersect("_x", "_y")).cast("long")
    union = F.size("_x") + F.size("_y") - shared
    percent = round(threshold * 100)
    return both.where(shared * 100 >= union * percent).select("a", "b")


def _open_rows(members: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows ``(band, h, node, size, part)`` of the buckets whose members are not yet all in one component of ``groups``."""
    # In a bucket of two the centre has met the other one.
    labelled = members.where("n > 2").join(groups, "node", "left")
    labelled = labelled.select("band", "h", "node", "size", F.coalesce("component", "node").alias("part"))
    mixed = (
        labelled.groupBy("band", "h")
        .agg(F.min("part").alias("_low"), F.max("part").alias("_high"))
        .where("_low <> _high")
        .select("band", "h")
    )
    return stage(labelled.join(mixed, ["band", "h"]), "open")


def _met(t: pa.Table, limits: list[tuple[int, int]]) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of a block pair the other rows that it has to be held against.

    Those are in another component, survive their signatures, and share no earlier band: a pair that shares several
    buckets is looked at in the first one alone.
    """
    x, right = _unpack(t.column("signature").to_pylist()), t.column("_right").to_numpy()
    parts, band = t.column("part").to_pylist(), t.column("band")[0].as_py()
    code = {p: i for i, p in enumerate(dict.fromkeys(parts))}
    part = np.array([code[p] for p in parts])
    same = t.column("_a")[0].as_py() == t.column("_b")[0].as_py()
    for i in range(len(part)):
        other = part != part[i]
        ask = np.flatnonzero(other[i + 1 :] if same else other[i + 1 :] & (right[i + 1 :] != right[i])) + i + 1
        found = ask[similar(x[i : i + 1], x[ask], limits)[0]]
        if len(found) and band:
            shared = (x[found, : band * ROWS] == x[i, : band * ROWS]).reshape(len(found), band, ROWS).all(2)
            found = found[~shared.any(1)]
        if len(found):
            yield i, found


def _block_links(rest: DataFrame, sketches: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Parts ``(a, b)`` that a link between members of open buckets joins, confirmed on the members' full sets.

    Block meets block, so no task has a whole large bucket. A first pass has signatures only and lets out the members
    that have someone to meet; a second pass has their sets, counts, and lets out a link when it joins two parts of
    its block. So neither pass lets out more rows than it gets, however similar a bucket is.
    """
    limits, percent = fewest_matches(threshold), round(threshold * 100)
    key = ["band", "h", "_a", "_b"]
    dealt = block_pairs(rest, ["band", "h"], "node", BLOCK_SHINGLES, "size")
    dealt = dealt.select(*key, (F.col("_mine") == F.col("_b")).alias("_right"), "node", "part")
    signed = dealt.join(sketches.select("node", "signature"), "node")
    names = [*key, "_right", "node", "part"]

    def meeting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs(batches, key):
            some = np.zeros(t.num_rows, bool)
            for i, found in _met(t, limits):
                some[i] = True
                some[found] = True
            yield from t.filter(pa.array(some)).select(names).to_batches()

    def linking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _runs(batches, key):
            parts = t.column("part").to_pylist()
            held = t.column("set").combine_chunks()
            at, values = held.offsets.to_numpy(), held.values.to_numpy(zero_copy_only=False)
            sorted_sets = [np.sort(values[a:b]) for a, b in zip(at, at[1:], strict=False)]
            root = {p: p for p in parts}

            def find(p: bytes, root: dict[bytes, bytes] = root) -> bytes:
                while root[p] != p:
                    p = root[p]
                return p

            links = []
            for i, found in _met(t, limits):
                for j in found:
                    a, b = find(parts[i]), find(parts[j])
                    if a == b:
                        continue
                    x, y = sorted_sets[i], sorted_sets[j]
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if both * 100 >= percent * (len(x) + len(y) - both):
                        links.append((parts[i], parts[j]))
                        root[a] = b
            if links:
                a, b = zip(*links, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])

    def by_block(df: DataFrame) -> DataFrame:
        return df.repartition(*key).sortWithinPartitions(*key)

    kinds = "band int, h long, _a int, _b int, _right boolean, node binary, part binary"
    some = stage(by_block(signed).mapInArrow(meeting, kinds), "meeting")
    whole = some.join(sketches.select("node", "signature"), "node").join(sets, "node")
    return by_block(whole).mapInArrow(linking, "a binary, b binary")


def _runs(batches: Iterator[pa.RecordBatch], key: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, of batches that are sorted by it; a run may go on in the next batch."""
    kept: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        t = pa.Table.from_batches([batch])
        t = (pa.concat_tables([kept, t]) if kept is not None else t).combine_chunks()
        columns = [t.column(k).to_numpy() for k in key]
        new = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
        at = [0, *(np.flatnonzero(new) + 1)]
        for a, b in zip(at, at[1:], strict=False):
            yield t.slice(a, b - a)
        kept = t.slice(at[-1])
    if kept is not None:
        yield kept


def near_duplicates(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    words: int = 5,
    threshold: float = 0.8,
) -> DataFrame:
    """Groups of texts with a shingle similarity of ``threshold`` (a whole percentage) or more.

    Returns ``(key, _text, n_shingles, component_id, kept)`` per row; ``_text`` is the hash of the text.

    1. *Sets.* Whole texts become sets of hashed shingles inside the JVM; Arrow batches turn them into signatures.
       Texts with equal sets are one node from here on, so thousands of copies cost one.
    2. *Bands.* Nodes that share a band are candidates. First each node meets one centre of its bucket, a
       minimum with map-side combine. Then the members of a bucket that are not yet in one component meet, block
       against block, and a block lets out only links that join what was apart. So a large group gives few rows,
       and still no two members of a bucket stay both unlinked and unchecked.
    3. *Bayes.* Signatures are compared in batches, and a pair is dropped when the posterior that it reaches the
       threshold is below ``MISS``.
    4. *Exact.* Survivors are confirmed on their full sets.

    NULL, empty and blank texts have no shingles and link with nothing. Rows with a NULL key take part; a group's
    component is its smallest key that is not NULL, and a row is kept if its key is that. Rows that repeat key and
    text get the same answer. An empty table gives an empty result; other columns do not matter.
    """
    texts = docs.select(F.col(key).alias("_key"), F.xxhash64(F.col(text)).alias("_text"), F.col(text).alias("text"))
    rows = stage(sketch(with_shingles(texts, "text", words)), "sketches")
    # One row of each node carries it, that with the least key and text; ties are equal in all that matters.
    nodes = rows.where(F.col("node").isNotNull())
    carried = F.min(F.struct("_key", "_text", "n_shingles", "signature")).alias("_first")
    sketches = stage(nodes.groupBy("node").agg(carried).select("node", "_first.*"), "nodes")
    width = 2 * ROWS
    bands = F.array(*[F.xxhash64(F.substring("signature", 1 + i * width, width)) for i in range(BANDS)])
    size = F.greatest("n_shingles", F.lit(LEAST_SHINGLES)).alias("size")
    banded = sketches.select("node", size, F.posexplode(bands).alias("band", "h"))
    buckets = banded.groupBy("band", "h").agg(F.min("node").alias("centre"), F.count(F.lit(1)).alias("n"))
    buckets = buckets.where("n > 1")
    members = stage(banded.join(buckets, ["band", "h"]), "buckets")

    # Only nodes that share a bucket are ever compared: their texts are read again, once, for their full sets.
    wanted = sketches.join(members.select("node").distinct(), "node").select("_key", "_text", "node")
    same = texts["_key"].eqNullSafe(wanted["_key"]) & (texts["_text"] == wanted["_text"])
    shared = texts.join(wanted, same).select("node", "text")
    sets = stage(with_shingles(shared, "text", words).dropDuplicates(["node"]), "sets")

    tried = members.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    tried = stage(_surviving(tried, sketches, threshold), "tried")
    linked = stage(_verified(tried, sets, threshold), "linked")
    groups = components(linked).select(F.col("id").alias("node"), "component")
    lowest = nodes.groupBy("node").agg(F.min("_key").alias("low")).join(groups, "node", "left")
    lowest = lowest.withColumn("component", F.coalesce("component", "node"))
    rest = _open_rows(members, groups)
    if not rest.isEmpty():
        # What is in one component already is one node of this smaller graph.
        joined = components(_block_links(rest, sketches, sets, threshold))
        whole = joined.select(F.col("id").alias("component"), F.col("component").alias("_whole"))
        lowest = lowest.join(whole, "component", "left")
        lowest = lowest.withColumn("component", F.coalesce("_whole", "component")).drop("_whole")
    by_group = lowest.groupBy("component").agg(F.min("low").alias("component_id"))
    answer = lowest.join(by_group, "component").select("node", "component_id")
    own = F.when(F.col("node").isNull(), F.col("_key")).otherwise(F.col("component_id"))
    return (
        rows.select("_key", "_text", "n_shingles", "node")
        .join(answer, "node", "left")
        .select(F.col("_key").alias(key), "_text", "n_shingles", own.alias("component_id"))
        .withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
    )
