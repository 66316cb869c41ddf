"""Scoring texts by prediction by partial matching over bytes (operator 9)."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from charloom.llm.common import discard, fold
from charloom.session import stage

#: Bytes of context; a context and its symbol fit into one integer.
ORDER = 5
#: Text bytes of one block of documents, which is what a task holds at a time.
BLOCK_BYTES = 6 << 20
#: Blocks of text per part of the table.
BLOCKS_PER_PART = 2
#: UTF-8 has neither byte: the context before a text, and the symbol after it.
BEFORE, END, SYMBOLS = 0xFE, 0xFF, 256


def windows(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Each symbol of each text with its ``order`` bytes of context as one integer, and where texts start.

    A text has its bytes and the end as symbols.
    """
    pad = np.full(order, BEFORE, np.uint8)
    parts = []
    for t in texts:
        b = np.concatenate([pad, np.frombuffer(t, np.uint8), np.array([END], np.uint8)]).astype(np.int64)
        n = len(b) - order
        w = b[:n].copy()
        for j in range(1, order + 1):
            w <<= 8
            w |= b[j : j + n]
        parts.append(w)
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.concatenate(parts), np.cumsum(sizes) - sizes


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and how often each occurs."""
    s = np.sort(values)
    at = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    return s[at], np.diff(np.append(at, len(s)))


def placed(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order, and the place of each value among them."""
    order = np.argsort(values, kind="stable")
    s = values[order]
    fresh = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
    place = np.empty(len(s), np.int64)
    place[order] = np.cumsum(fresh) - 1
    return s[fresh], place


def tokens(text: bytes) -> list[bytes]:
    """Words without ASCII white space, A-Z lower-cased, and the end as the empty word."""
    return [*text.lower().split(), b""]


def _bytes(texts: pd.Series) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") if isinstance(t, str) else b"" for t in texts]


# --- packed tables ----------------------------------------------------------------------------------


def pack_grams(grams: np.ndarray, counts: np.ndarray) -> bytes:
    """Sorted windows and their counts; the planes of sorted bytes compress to about a third."""
    planes = grams.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()
    return zstandard.compress(planes + counts.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def unpack_grams(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(12, -1)
    grams = np.ascontiguousarray(planes[:8].T).view(">u8").ravel().astype(np.int64)
    return grams, np.ascontiguousarray(planes[8:].T).view("<u4").ravel().astype(np.int64)


def pack_words(words: list[bytes], counts: list[int]) -> bytes:
    return zstandard.compress(np.array(counts, "<u4").tobytes() + b" ".join(words), 1)


def unpack_words(data: bytes, n: int) -> tuple[list[bytes], np.ndarray]:
    raw = zstandard.decompress(data)
    return raw[4 * n :].split(b" ") if n else [], np.frombuffer(raw[: 4 * n], "<u4").astype(np.int64)


def pack_numbers(values: np.ndarray) -> bytes:
    """Numbers as byte planes. Code lengths come in four bytes, 24 bits of them: a relative error below 1e-7."""
    return zstandard.compress(values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes(), 1)


def unpack_numbers(data: bytes, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def parts_of_words(words: set[bytes], parts: int) -> list[list[bytes]]:
    """Distinct words by the part of the table that has them, in order."""
    out: list[list[bytes]] = [[] for _ in range(parts)]
    for w in sorted(words):
        out[zlib.crc32(w) % parts].append(w)
    return out


def parts_of_grams(grams: np.ndarray, parts: int) -> np.ndarray:
    """The part of a window: by the two bytes before its symbol, so that contexts from order 2 on are whole in it."""
    return (((grams >> 8) & 0xFFFF) * 40_503 >> 4) % parts


def gather(blocks: DataFrame, order: int, parts: int) -> DataFrame:
    """``(block, part, n_grams, grams, n_words, words)``: what each block has, counted in its training texts.

    Windows and words come once a block, packed by the part of the table that they belong to. Part -1 has the counts
    of single bytes and pairs, at most 65,536, which the lowest orders are made of.
    """

    def run(block: pd.DataFrame) -> pd.DataFrame:
        number = block["block"].iloc[0]
        learns = block["learns"].to_numpy()
        texts = _bytes(block["text"])
        block = None
        found, taught = [], [t for t, k in zip(texts, learns, strict=True) if k]
        held = [t for t, k in zip(texts, learns, strict=True) if not k]
        grams, n = counted(windows(taught, order)[0]) if taught else (np.zeros(0, np.int64), np.zeros(0, np.int64))
        low = np.unique(grams & 0xFFFF, return_inverse=True)
        found.append((number, -1, len(low[0]), pack_grams(low[0], np.bincount(low[1], n, len(low[0])).astype(np.int64)), 0, b""))
        if held:
            more = np.setdiff1d(counted(windows(held, order)[0])[0], grams, assume_unique=True)
            both = np.concatenate([grams, more])
            by = np.argsort(both, kind="stable")
            grams, n = both[by], np.concatenate([n, np.zeros(len(more), np.int64)])[by]
        words: Counter[bytes] = Counter()
        for t in taught:
            words.update(tokens(t))
        for t in held:
            for w in set(tokens(t)):
                words.setdefault(w, 0)
        of = parts_of_grams(grams, parts)
        named = parts_of_words(set(words), parts)
        for p in range(parts):
            mine = of == p
            w = named[p]
            found.append(
                (number, p, int(mine.sum()), pack_grams(grams[mine], n[mine]), len(w), pack_words(w, [words[x] for x in w]))
            )
        return pd.DataFrame(found, columns=["block", "part", "n_grams", "grams", "n_words", "words"])

    kinds = "block int, part int, n_grams long, grams binary, n_words long, words binary"
    return blocks.groupBy("block").applyInPandas(run, kinds)


# --- the model --------------------------------------------------------------------------------------


class Level:
    """One order of the byte-context trie: counts of windows, and per context what exclusion needs.

    A context has the number of symbols seen after it, of distinct ones, and the sum of the counts that these
    symbols have one order lower: what exclusion takes away when the context is escaped from.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray, below: Level | None, order: int):
        self.grams, self.counts, self.order = grams, counts, order
        ctx = grams >> 8
        first = np.flatnonzero(np.concatenate([[True], ctx[1:] != ctx[:-1]])) if len(ctx) else np.zeros(0, np.int64)
        self.ctx = ctx[first]
        low = below.count(grams & ((1 << (8 * order)) - 1)) if below is not None else np.zeros(len(grams), np.int64)
        add = (lambda x: np.add.reduceat(x, first)) if len(first) else (lambda x: np.zeros(0, np.int64))
        self.n, self.x = add(counts), add(low)
        self.d = np.diff(np.append(first, len(ctx)))

    def count(self, grams: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.grams, grams), max(0, len(self.grams) - 1))
        return np.where(self.grams[at] == grams, self.counts[at], 0) if len(self.grams) else np.zeros(len(grams), np.int64)


def levels(grams: np.ndarray, counts: np.ndarray, order: int, low: tuple[np.ndarray, np.ndarray]) -> list[Level]:
    """All orders from the windows of one part; orders 0 and 1 from the pairs of the whole corpus (``low``)."""

    def shorter(g: np.ndarray, c: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        u, at = np.unique(g & ((1 << (8 * size)) - 1), return_inverse=True)
        return u, np.bincount(at, c, len(u)).astype(np.int64)

    seen = counts > 0
    tables = [(grams[seen], counts[seen])]
    for j in range(order - 1, 1, -1):
        tables.insert(0, shorter(*tables[0], j + 1))
    tables = [shorter(*low, 1), low, *tables] if order > 1 else [shorter(*low, 1), low][: order + 1]
    out: list[Level] = []
    for j, (g, c) in enumerate(tables):
        out.append(Level(g, c, out[-1] if out else None, j))
    return out


def code_lengths(grams: np.ndarray, trie: list[Level]) -> np.ndarray:
    """log10 probability of each window's symbol given its context.

    From the longest context down: a symbol seen there is coded with ``c / (n + d)``, another one escapes with
    ``d / (n + d)`` (method C), and symbols of the longer context no longer count in the shorter one (exclusion).
    """
    out = np.zeros(len(grams))
    left = np.arange(len(grams))
    px, pd_ = np.zeros(len(grams), np.int64), np.zeros(len(grams), np.int64)
    for level in reversed(trie):
        if not len(left) or not len(level.grams):
            continue
        g = grams[left] & ((1 << (8 * (level.order + 1))) - 1)
        at = np.minimum(np.searchsorted(level.ctx, g >> 8), len(level.ctx) - 1)
        known = level.ctx[at] == g >> 8
        n, d = level.n[at] - px[left], level.d[at] - pd_[left]
        c = level.count(g)
        use = known & (d > 0)
        out[left[use]] += np.log10(np.where(c > 0, c, d)[use] / (n + d)[use])
        px[left[known]], pd_[left[known]] = level.x[at[known]], level.d[at[known]]
        left = left[c == 0]
    out[left] -= np.log10(SYMBOLS - pd_[left])
    return out


def look_up(found: DataFrame, order: int, low: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``(block, part, lengths, counts, total, distinct)``: what each block asked for, in the order it asked.

    A part of the table sums what all blocks have of it, makes its piece of the trie, and answers each block. ``total``
    and ``distinct`` are the training tokens of the part, on the row of one of its blocks.
    """

    def run(part: pd.DataFrame) -> pd.DataFrame:
        packed = [unpack_grams(g) for g in part["grams"]]
        grams, at = np.unique(np.concatenate([g for g, _ in packed]), return_inverse=True)
        counts = np.bincount(at, np.concatenate([n for _, n in packed]), len(grams)).astype(np.int64)
        lengths = code_lengths(grams, levels(grams, counts, order, low))
        words: Counter[bytes] = Counter()
        listed = []
        for data, n in zip(part["words"], part["n_words"], strict=True):
            names, k = unpack_words(data, n)
            listed.append(names)
            for w, c in zip(names, k.tolist(), strict=True):
                words[w] += c
        rows, start = [], 0
        for b, p, (g, _), names in zip(part["block"], part["part"], packed, listed, strict=True):
            lp = lengths[at[start : start + len(g)]]
            start += len(g)
            total, distinct = (sum(words.values()), sum(c > 0 for c in words.values())) if not rows else (0, 0)
            counts = np.array([words[w] for w in names], "<i8")
            rows.append((b, p, pack_numbers(lp.astype("<f4")), pack_numbers(counts), total, distinct))
        return pd.DataFrame(rows, columns=["block", "part", "lengths", "counts", "total", "distinct"])

    kinds = "block int, part int, lengths binary, counts binary, total long, distinct long"
    return found.groupBy("part").applyInPandas(run, kinds)


def score_texts(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    folds: int = 7,
    held_out: int = 2,
    order: int = ORDER,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """log10 probability of each whole text under a byte model that is pretrained on the texts not held out.

    Returns ``(key, held_out, n_tokens, n_known, train_tokens, base_score, score)``; ``base_score`` is that of
    words counted alone with one added to each count. Rows whose ``crc32`` of the key modulo ``folds`` is
    ``held_out`` teach nothing (a NULL key counts as the empty text). NULL and empty texts have the end only.

    Texts are dealt into blocks of about ``block_bytes`` by a hash. Each block hands in its distinct windows and
    words with their training counts, packed into parts: windows by the two bytes before their symbol, words by a
    hash. A part then holds all counts of its contexts from order 2 on; the pairs of bytes below that, at most 65,536,
    are what every part is given. Each part makes its piece of the trie, works out the code length of each of its windows once,
    and answers the blocks; each block then sums over its whole texts. The number of parts grows with the input, and no
    task holds more than a block or a part. Rows that repeat are dealt together and scored alike; other columns do not
    matter; an empty table gives an empty result.
    """
    size = docs.agg(F.coalesce(F.sum(F.octet_length(F.col(text)) + 64), F.lit(0))).first()[0]
    count = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64(F.col(key), F.col(text)), F.lit(count)).cast("int")
    blocks = docs.select(
        block.alias("block"),
        # As text, for pandas turns whole numbers beside NULLs into floating ones.
        F.col(key).cast("string").alias(key),
        (fold(F.col(key), folds) != held_out).alias("learns"),
        F.col(text).alias("text"),
    )
    parts = max(4, -(-count // BLOCKS_PER_PART))
    found = stage(gather(blocks, order, parts), "found")
    low = _pairs(found.where("part = -1"))
    values = stage(look_up(found.where("part >= 0"), order, low), "values")
    discard(found)
    total, distinct = values.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()

    def run(block: pd.DataFrame, table: pd.DataFrame) -> pd.DataFrame:
        texts = _bytes(block["text"])
        seen, starts = windows(texts, order)
        grams, place = placed(seen)
        of, lp = parts_of_grams(grams, parts), np.zeros(len(grams))
        split = [tokens(t) for t in texts]
        named = parts_of_words(set().union(*split), parts)
        counts: dict[bytes, int] = {}
        for p, lengths, numbers in zip(table["part"], table["lengths"], table["counts"], strict=True):
            lp[of == p] = unpack_numbers(lengths, "<f4")
            counts.update(zip(named[p], unpack_numbers(numbers, "<i8").tolist(), strict=True))
        n = np.array([len(x) for x in split])
        c = np.fromiter((counts[w] for x in split for w in x), np.float64, n.sum())
        # Each text has its end as a word and as a symbol, so no run below is empty.
        first = np.cumsum(n) - n
        k = np.add.reduceat(c > 0, first, dtype=np.int64)
        base = np.add.reduceat(np.log10((c + 1) / (total + distinct + 1)), first)
        score = np.add.reduceat(lp[place], starts)
        return pd.DataFrame(
            {
                key: block[key],
                "held_out": ~block["learns"].to_numpy(),
                "n_tokens": n,
                "n_known": k,
                "train_tokens": total,
                "base_score": base,
                "score": score,
            }
        )

    fields = [T.StructField(key, T.StringType()), T.StructField("held_out", T.BooleanType())]
    fields += [T.StructField(c, T.LongType()) for c in ("n_tokens", "n_known", "train_tokens")]
    fields += [T.StructField(c, T.DoubleType()) for c in ("base_score", "score")]
    scored = blocks.groupBy("block").cogroup(values.groupBy("block")).applyInPandas(run, T.StructType(fields))
    return scored.withColumn(key, F.col(key).cast(docs.schema[key].dataType))


def _pairs(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all pairs of bytes in the corpus, from those of the blocks; bounded by the alphabet."""

    def unpacked(part: pd.DataFrame) -> pd.DataFrame:
        dense = np.zeros(1 << 16, np.int64)
        for data in part["grams"]:
            g, n = unpack_grams(data)
            dense[g] += n
        g = np.flatnonzero(dense)
        return pd.DataFrame({"g": g, "c": dense[g]})

    def batches(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return map(unpacked, parts)

    sums = rows.mapInPandas(batches, "g long, c long").groupBy("g").agg(F.sum("c").alias("c")).toPandas()
    sums = sums.sort_values("g")
    return sums["g"].to_numpy(np.int64), sums["c"].to_numpy(np.int64)
