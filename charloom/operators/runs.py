"""The map side of the gram and token aggregates: a run of texts is counted at a time, in arrays of code points.

Spark deals the texts out and sums what the runs counted; a run holds about ``RUN_CHARS`` characters, however large the
table, its batches or its groups are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

RUN_CHARS = 1 << 19
#: Rows of a batch that become Python strings at a time.
SLICE_ROWS = 256
#: Cells of a trie's table; a larger trie keeps its edges alone.
TABLE_CELLS = 1 << 22
#: Places from which the trie's table is walked at a time, so that they stay in a processor's cache.
WALK = 1 << 13
#: Stands between two texts of a run; no text holds a surrogate.
GAP = 0xD800

#: Columns of strings and their counts, of one run of texts.
Counted = tuple[list[list[str]], np.ndarray]


def count_in_runs(
    df: DataFrame, text: Column, by: Sequence[str], names: Sequence[str], count: Callable[[list[str]], Iterator[Counted]]
) -> DataFrame:
    """``(by, names, cnt)``: what ``count`` finds in the texts of each group, summed. NULL and empty texts hold nothing."""
    rows = df.select(*by, F.make_valid_utf8(text).alias("_text"))
    kinds = [StructField(b, rows.schema[i].dataType) for i, b in enumerate(by)]
    found = StructType([*kinds, *[StructField(c, StringType()) for c in names], StructField("_n", LongType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, list[str]] = {}
        size, types = 0, []

        def counted() -> Iterator[pa.RecordBatch]:
            for key, texts in held.items():
                for strings, n in count(texts):
                    own = [pa.array([k] * len(n), t) for k, t in zip(key, types, strict=True)]
                    columns = [*own, *[pa.array(s, pa.string()) for s in strings], pa.array(n, pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, names=found.names)

        for batch in batches:
            types = [f.type for f in batch.schema][: len(by)]
            for start in range(0, batch.num_rows, SLICE_ROWS):
                *keys, texts = (c.to_pylist() for c in batch.slice(start, SLICE_ROWS).columns)
                for *key, t in zip(*keys, texts, strict=True):
                    if t:
                        held.setdefault(tuple(key), []).append(t)
                        size += len(t)
                    if size >= RUN_CHARS:
                        yield from counted()
                        held.clear()
                        size = 0
        yield from counted()

    return rows.mapInArrow(work, found).groupBy(*by, *names).agg(F.sum("_n").alias("cnt"))


def _points(texts: list[str], gap: int) -> np.ndarray:
    """The code points of the texts with ``gap`` gaps before, between and after them."""
    between = chr(GAP) * gap
    return np.frombuffer((between + between.join(texts) + between).encode("utf-32-le", "surrogatepass"), "<u4")


def _numbered(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The characters of a run numbered from 1, gaps 0, and the character of each number."""
    number = np.zeros(int(points.max()) + 1, np.int32)
    number[points] = 1
    if len(number) > GAP:
        number[GAP] = 0
    alphabet = np.flatnonzero(number)
    number[alphabet] = np.arange(1, len(alphabet) + 1)
    return number[points], np.concatenate([[GAP], alphabet]).astype("<u4")


def _distinct(columns: list[np.ndarray], base: int, keep: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows of the columns, whose values are below ``base``, and how often each is there."""
    code, top = columns[0].astype(np.int64), base
    folded = {}
    for i, column in enumerate(columns[1:], 1):
        if top > (1 << 62) // base:
            folded[i], code = np.unique(code, return_inverse=True)
            top = len(folded[i])
        code *= base
        code += column
        top *= base
    code, cnt = np.unique(code if keep is None else code[keep], return_counts=True)
    rows = np.empty((len(code), len(columns)), np.int64)
    for i in range(len(columns) - 1, 0, -1):
        code, rows[:, i] = np.divmod(code, base)
        if i in folded:
            code = folded[i][code]
    rows[:, 0] = code
    return rows, cnt


def _strings(windows: np.ndarray) -> list[str]:
    """Each row of code points as a string, without its gaps."""
    real = windows != GAP
    text = windows[real].tobytes().decode("utf-32-le")
    ends = np.cumsum(real.sum(axis=1)).tolist()
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def _shares(places: int) -> Iterator[tuple[int, int]]:
    """The places of a run, which one long text may make much longer than others, in shares."""
    return ((a, min(a + RUN_CHARS, places)) for a in range(0, places, RUN_CHARS))


def grams(n: int, heads: bool) -> Callable[[list[str]], Iterator[Counted]]:
    """Counts the runs of ``n`` characters; with ``heads`` the first characters also end one, with the context they have."""

    def count(texts: list[str]) -> Iterator[Counted]:
        ids, alphabet = _numbered(_points(texts, n - 1))
        for a, b in _shares(len(ids) - n + 1):
            columns = [ids[a + i : b + i] for i in range(n)]
            keep = columns[-1] > 0 if heads else (columns[-1] > 0) & (columns[0] > 0)
            rows, cnt = _distinct(columns, len(alphabet), keep)
            yield [_strings(alphabet[rows])], cnt

    return count


class Cutter:
    """Cuts texts into the longest tokens of a vocabulary; a character that starts none is a token itself."""

    def __init__(self, vocabulary: Sequence[str]):
        words = {t for t in vocabulary if t}
        self.longest = max(map(len, words), default=1)
        self.chars = sorted({ord(c) for t in words for c in t})
        number = {c: i for i, c in enumerate(self.chars, 1)}
        self.base = len(self.chars) + 1
        # The trie: nodes that something follows come first, the root before all.
        inner = sorted({""} | {t[:k] for t in words for k in range(len(t))}, key=len)
        nodes = {p: i for i, p in enumerate([*inner, *sorted(words - set(inner))])}
        edges = sorted((nodes[p[:-1]] * self.base + number[ord(p[-1])], node) for p, node in nodes.items() if p)
        self.inner = len(inner)
        self.ends = np.array([p in words for p in nodes])
        self.edges, self.below = (np.array([e[i] for e in edges], np.int64) for i in range(2))
        self.table = None
        if self.inner * self.base <= TABLE_CELLS:
            # Per node and character the next node, doubled, plus one if a token ends there; behind the last nothing follows.
            self.table = np.full((self.inner + 1) * self.base, 2 * self.inner, np.int64)
            self.table[self.edges] = 2 * np.minimum(self.below, self.inner) + self.ends[self.below]

    def _lengths(self, ids: np.ndarray) -> np.ndarray:
        """The length of the longest token from each place, 1 where none starts."""
        length = np.ones(len(ids), np.int64)
        if self.table is not None:
            ahead = np.concatenate([ids, np.zeros(self.longest, np.int64)])
            for start in range(0, len(ids), WALK):
                own = length[start : start + WALK]
                node = np.zeros(len(own), np.int64)
                for depth in range(self.longest):
                    node *= self.base
                    node += ahead[start + depth : start + depth + len(own)]
                    node = self.table[node]
                    np.maximum(own, (node & 1) * (depth + 1), out=own)
                    node >>= 1
            return length
        at = np.flatnonzero(ids)
        node = np.zeros(len(at), np.int64)
        for depth in range(self.longest):
            wanted = node * self.base + ids[at + depth]
            edge = np.minimum(np.searchsorted(self.edges, wanted), len(self.edges) - 1)
            hit = self.edges[edge] == wanted
            at, below = at[hit], self.below[edge[hit]]
            length[at[self.ends[below]]] = depth + 1
            on = below < self.inner
            at, node = at[on], below[on]
        return length

    def starts(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the tokens start, and how long they are. Behind the last text are as many gaps as a token is long."""
        number = np.zeros(max(int(points.max()), *self.chars, 0) + 1, np.int64)
        number[self.chars] = np.arange(1, self.base)
        length = self._lengths(number[points])
        steps, here, i = length.tolist(), bytearray(len(points)), 0
        while i < len(here):
            here[i] = 1
            i += steps[i]
        places = np.flatnonzero((np.frombuffer(here, np.uint8) > 0) & (points != GAP))
        return places, length[places]


def tokens_in_context(vocabulary: Sequence[str], n: int) -> Callable[[list[str]], Iterator[Counted]]:
    """Counts the tokens of texts cut by longest match, each after the up to ``n - 1`` characters before it."""
    cutter = Cutter(vocabulary)

    def count(texts: list[str]) -> Iterator[Counted]:
        points = _points(texts, max(n - 1, cutter.longest))
        ids, alphabet = _numbered(points)
        places, lengths = cutter.starts(points)
        for a, b in _shares(len(places)):
            at, length = places[a:b], lengths[a:b]
            before = [ids[at - i] for i in range(n - 1, 0, -1)]
            own = [np.where(length > i, ids[at + i], 0) for i in range(cutter.longest)]
            rows, cnt = _distinct([*before, *own], len(alphabet))
            yield [_strings(alphabet[rows[:, : n - 1]]), _strings(alphabet[rows[:, n - 1 :]])], cnt

    return count
