"""Aligning the tokens of two tokenizers over the same bytes (operator 12)."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from charloom.llm.common import discard
from charloom.llm.packing import encoder
from charloom.session import stage

#: Characters of one block of documents, and windows whose alignments a worker remembers from block to block.
BLOCK_CHARS, MEMO_WINDOWS = 4 << 20, 100_000
BYTE_LEVEL, PIECES = "byte_bpe_50k", "piece_bpe_32k.model"
_SPACE = "▁"


def byte_level_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [b for b in range(256) if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF]
    moved = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(moved)}


class Vocabulary:
    """Lengths in bytes, a leading space or none, and the bytes themselves of every token id."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.length = np.array([len(t) for t in tokens], np.int64)
        self.marked = np.array([t[:1] == b" " for t in tokens], bool)

    def spells(self, ids: list[int], raw: bytes) -> bool:
        return b"".join(map(self.tokens.__getitem__, ids)) == raw


class Tokenizers:
    """Both tokenizers of the public files: ``(ids of A, ids of B)``, or None where they do not spell the text."""

    def __init__(self, byte_level: str = BYTE_LEVEL, pieces: str = PIECES):
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer

        self.encode_a = encoder(byte_level)
        whole = Tokenizer.from_file(public_tokenizers.path(f"{byte_level}.json"))
        # Strings of special tokens in a text are plain text.
        self.special = [t.content for t in whole.get_added_tokens_decoder().values()]
        whole.encode_special_tokens = True
        self.whole = whole
        to_byte = byte_level_alphabet()
        names = [whole.id_to_token(i) for i in range(whole.get_vocab_size())]
        self.a = Vocabulary([bytes(to_byte[c] for c in n) if n not in self.special else n.encode() for n in names])
        self.pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces))
        p = self.pieces
        self.b = Vocabulary(
            [
                bytes([int(p.id_to_piece(i)[3:5], 16)]) if p.is_byte(i) else p.id_to_piece(i).replace(_SPACE, " ").encode()
                for i in range(p.get_piece_size())
            ]
        )

    def __call__(self, text: str | None) -> tuple[list[int], list[int]] | None:
        if not text:
            return None
        spaced = f" {text}"
        if any(s in text for s in self.special):
            a = self.whole.encode(spaced, add_special_tokens=False).ids
        else:
            a = self.encode_a(spaced)
        b = self.pieces.encode(text)
        raw = spaced.encode("utf-8", "surrogatepass")
        return (a, b) if self.b.spells(b, raw) and self.a.spells(a, raw) else None


class _Numbers(dict):
    """Numbers for keys as they come; ``fresh`` has the keys that got one since it was last emptied."""

    def __init__(self) -> None:
        self.fresh: list = []

    def __missing__(self, key):
        n = self[key] = len(self)
        self.fresh.append(key)
        return n


def _ends(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which of the ascending offsets ``a`` are in ``b``."""
    return b[np.minimum(np.searchsorted(b, a), len(b) - 1)] == a


def _counted(group: np.ndarray, ids: np.ndarray, size: int, groups: int) -> tuple[np.ndarray, ...]:
    """Distinct ids of each group with how often it has them, and where each group's begin."""
    both, n = np.unique(group * size + ids, return_counts=True)
    of = both // size
    return of, both % size, n, np.searchsorted(of, np.arange(groups + 1))


def _spans(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The numbers from each ``start`` on, ``n`` of them, one span after the other."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(n.sum())


@dataclass
class Windows:
    """Alignments of windows: groups spelt out, numbers of groups and links, and linked pairs with how often each is.

    ``cuts`` has where each window's pairs begin.
    """

    spelt: list[str]
    groups: np.ndarray
    links: np.ndarray
    cuts: np.ndarray
    pairs: np.ndarray
    times: np.ndarray

    def __add__(self, other: Windows) -> Windows:
        cuts = np.concatenate([self.cuts, self.cuts[-1] + other.cuts[1:]])
        both = (np.concatenate([getattr(self, c), getattr(other, c)]) for c in ("groups", "links"))
        return Windows(
            self.spelt + other.spelt, *both, cuts, np.concatenate([self.pairs, other.pairs]), np.concatenate([self.times, other.times])
        )


def no_windows() -> Windows:
    none = np.zeros(0, np.int64)
    return Windows([], none, none, np.zeros(1, np.int64), none, none)


class Aligner:
    """Windows between anchors, each aligned once and remembered by its two tuples of ids.

    An anchor is an offset where tokens of both sides start with a space. Both sides end a token before it, so the
    groups of a text are those of its windows one after the other. The new windows of a block are aligned side by side.
    """

    def __init__(self, tokenizers: Tokenizers):
        self.t = tokenizers
        a, b = tokenizers.a.tokens, tokenizers.b.tokens
        # An id as it is spelt before another one of its side, and at the end of its side of a group.
        self.names = [f"{i}{end}" for n, ends in ((len(a), ",|"), (len(b), ",;")) for end in ends for i in range(n)]
        self.width = np.array([len(n) for n in self.names], np.int64)
        self.forget()

    def forget(self) -> None:
        self.memo = _Numbers()
        self.windows = no_windows()

    def align(self, keys: list[bytes]) -> Windows:
        """Alignments of windows, given as the ids of side A and then those of side B, which count on from A's."""
        if not keys:
            return no_windows()
        size_a, size_b = len(self.t.a.tokens), len(self.t.b.tokens)
        ids = np.frombuffer(b"".join(keys), np.int32).astype(np.int64)
        side_b = ids >= size_a
        window = np.repeat(np.arange(len(keys)), [len(k) >> 2 for k in keys])
        a, b, window = ids[~side_b], ids[side_b] - size_a, window[~side_b]
        end_a, end_b = np.cumsum(self.t.a.length[a]), np.cumsum(self.t.b.length[b])
        # A group ends where both sides do; the end of a window is such a place.
        last_a, last_b = _ends(end_a, end_b), _ends(end_b, end_a)
        of_a, of_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        groups = int(last_a.sum())
        window = window[last_a]
        n_a, n_b = np.bincount(of_a, minlength=groups), np.bincount(of_b, minlength=groups)
        # Ids in the order in which they are spelt: side A of a group, then side B.
        name = np.empty(len(a) + len(b), np.int64)
        name[np.arange(len(a)) + (np.cumsum(n_b) - n_b)[of_a]] = a + size_a * last_a
        name[np.arange(len(b)) + np.cumsum(n_a)[of_b]] = 2 * size_a + b + size_b * last_b
        spelt = "".join(map(self.names.__getitem__, name.tolist()))
        tokens = np.bincount(window, n_a + n_b, len(keys)).astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(self.width[name])])[np.concatenate([[0], np.cumsum(tokens)])].tolist()
        # Distinct ids first, so that a long group of few ids gives few pairs.
        group, x, k, _ = _counted(of_a, a, size_a, groups)
        _, y, m, starts = _counted(of_b, b, size_b, groups)
        n = (starts[1:] - starts[:-1])[group]
        other = _spans(starts[group], n)
        sizes = np.bincount(window[group], n, len(keys)).astype(np.int64)
        return Windows(
            [spelt[i : j - 1] for i, j in zip(upto, upto[1:], strict=False)],
            np.bincount(window, minlength=len(keys)),
            np.bincount(window, n_a * n_b, len(keys)).astype(np.int64),
            np.concatenate([[0], np.cumsum(sizes)]),
            np.repeat(x, n) << 32 | y[other],
            np.repeat(k, n) * m[other],
        )

    def cut(self, text: str | None) -> tuple[int, int, list[int]]:
        """Tokens of either side, and the numbers of the windows of a text."""
        found = self.t(text)
        if found is None:
            return 0, 0, []
        a, b = np.array(found[0], np.int32), np.array(found[1], np.int32)
        start_a, start_b = (np.cumsum(v.length[x]) - v.length[x] for v, x in ((self.t.a, a), (self.t.b, b)))
        at_a, at_b = np.flatnonzero(self.t.a.marked[a]), np.flatnonzero(self.t.b.marked[b])
        shared_a, shared_b = _ends(start_a[at_a], start_b[at_b]), _ends(start_b[at_b], start_a[at_a])
        # The first token of either side starts with the space before the text, so the first anchor is 0.
        from_a, from_b = (np.append(at[shared], size) for at, shared, size in ((at_a, shared_a, len(a)), (at_b, shared_b, len(b))))
        ids = np.empty(len(a) + len(b), np.int32)
        ids[np.arange(len(a)) + np.repeat(from_b[:-1], np.diff(from_a))] = a
        ids[np.arange(len(b)) + np.repeat(from_a[1:], np.diff(from_b))] = b + len(self.t.a.tokens)
        raw, cuts = ids.tobytes(), (4 * (from_a + from_b)).tolist()
        keys = [raw[i:j] for i, j in zip(cuts, cuts[1:], strict=False)]
        return len(a), len(b), list(map(self.memo.__getitem__, keys))

    def __call__(self, texts: list[str | None]) -> tuple[list[tuple], np.ndarray, np.ndarray]:
        """``(n_a, n_b, n_groups, n_links, sha256, at, times)`` of each text of a block, its distinct pairs, and how many
        texts hold each; ``at`` are places in that list."""
        if len(self.memo) > MEMO_WINDOWS:
            self.forget()
        found = [self.cut(t) for t in texts]
        self.windows += self.align(self.memo.fresh)
        self.memo.fresh = []
        w = self.windows
        numbers = np.array([n for f in found for n in f[2]], np.int64)
        text = np.repeat(np.arange(len(texts)), [len(f[2]) for f in found])
        groups, links = (np.bincount(text, c[numbers], len(texts)).astype(np.int64).tolist() for c in (w.groups, w.links))
        listed, place = np.unique(w.pairs, return_inverse=True)
        n = (w.cuts[1:] - w.cuts[:-1])[numbers]
        entry = _spans(w.cuts[numbers], n)
        own, at = np.unique(np.repeat(text, n) * len(listed) + place[entry], return_inverse=True)
        times = np.bincount(at, w.times[entry], len(own)).astype(np.int64)
        of, pair = np.divmod(own, max(1, len(listed)))
        used, pair = np.unique(pair, return_inverse=True)
        cuts = np.searchsorted(of, np.arange(len(texts) + 1)).tolist()
        rows = []
        for (a, b, windows), g, k, i, j in zip(found, groups, links, cuts, cuts[1:], strict=False):
            digest = hashlib.sha256(";".join(map(w.spelt.__getitem__, windows)).encode()).hexdigest() if windows else ""
            rows.append((a, b, g, k, digest, pair[i:j].astype(np.int32), times[i:j]))
        return rows, listed[used], np.bincount(pair, minlength=len(used))


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def aligned_blocks(docs: DataFrame, key: str, text: str, block_chars: int, tokenizers: dict) -> DataFrame:
    """Rows of documents and of their blocks.

    A document has its digest, and its pairs as places in its block's list (``at``, ``times``). The row of a block,
    without a digest, has that list and how many of the block's documents hold each pair (``pairs``, ``holding``).
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, size = TaskContext.get().partitionId(), 0, 0
        align, keys, texts = Aligner(Tokenizers(**tokenizers)), [], []

        def frame() -> pd.DataFrame:
            name = f"{part}-{number}"
            found, listed, holding = align(texts)
            rows = [(name, k, *f, None, None) for k, f in zip(keys, found, strict=True)]
            rows.append((name, None, 0, 0, 0, 0, None, None, None, listed, holding))
            return pd.DataFrame(rows, columns=names)

        for batch in batches:
            for k, body in zip(batch[key], batch["_text"], strict=True):
                keys.append(k)
                texts.append(body)
                size += len(body or "") + 64
                if size >= block_chars:
                    yield frame()
                    keys, texts, size, number = [], [], 0, number + 1
        if keys:
            yield frame()

    names = ["block", key, *_COUNTS, "groups_sha256", "at", "times", "pairs", "holding"]
    fields = [T.StructField("block", T.StringType()), T.StructField(key, T.StringType())]
    fields += [T.StructField(c, T.LongType()) for c in _COUNTS] + [T.StructField("groups_sha256", T.StringType())]
    fields += [T.StructField("at", T.ArrayType(T.IntegerType()))]
    fields += [T.StructField(c, T.ArrayType(T.LongType())) for c in ("times", "pairs", "holding")]
    # The key travels as text, for pandas turns whole numbers beside NULLs into floating ones.
    narrow = docs.select(F.col(key).cast("string").alias(key), F.col(text).alias("_text"))
    return narrow.mapInPandas(run, T.StructType(fields))


def align_tokens(
    docs: DataFrame, *, key: str = "doc_id", text: str = "text", block_chars: int = BLOCK_CHARS, **tokenizers: str
) -> DataFrame:
    """How the tokens of a byte-level vocabulary (A) and of a piece vocabulary (B) cover each whole text.

    Returns ``(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`` per row. Offsets where tokens of
    both sides end cut a text into groups; tokens of a group are linked. A pair's count is the number of rows that
    hold it linked; ``count_sum`` is its sum over the links, ``n_best`` the links whose count is the highest of their A id.

    * *Anchors.* Both tokenizers encode the whole text. Offsets at which both have a token that starts with a space cut
      it into windows of ids, which are aligned once and remembered by their two tuples of ids; memory is given back
      between blocks. A text without such offsets is one window.
    * *Counts.* Texts stay where they lie. A block of them hands in its distinct pairs, a row each; these are summed,
      compared within their A id (at most as many as B has ids), and joined back to the blocks that have them.

    A row whose text is NULL or empty, or whose tokens of either side do not spell a space and the text, has zeros and an
    empty digest. Rows count one by one, repeated keys and texts too; a NULL key passes through; other columns do not
    matter. An empty table gives an empty result.
    """
    kind = docs.schema[key].dataType
    blocks = stage(aligned_blocks(docs, key, text, block_chars, tokenizers), "aligned")
    held = blocks.where(F.col("groups_sha256").isNull()).select(
        "block", F.posexplode(F.arrays_zip("pairs", "holding")).alias("place", "p")
    )
    held = held.select("block", "place", F.col("p.pairs").alias("pair"), F.col("p.holding").alias("holding"))
    sums = held.groupBy("pair").agg(F.sum("holding").alias("n"))
    top = F.max("n").over(Window.partitionBy(F.shiftright("pair", 32)))
    counts = sums.select("pair", "n", (F.col("n") == top).alias("best"))
    told = held.join(counts, "pair").select("block", "place", "n", "best")

    def run(rows: pd.DataFrame, told: pd.DataFrame) -> pd.DataFrame:
        n, best = np.zeros(len(told), np.int64), np.zeros(len(told), np.int64)
        n[told["place"].to_numpy()], best[told["place"].to_numpy()] = told["n"], told["best"]
        found = [
            (int(best[at] @ times), int(n[at] @ times)) if len(at) else (0, 0)
            for at, times in zip(rows["at"], rows["times"], strict=True)
        ]
        out = rows[[key, *_COUNTS, "groups_sha256"]].copy()
        out["n_best"], out["count_sum"] = zip(*found, strict=True) if found else ([], [])
        return out

    fields = [T.StructField(key, T.StringType())]
    fields += [T.StructField(c, T.LongType()) for c in [*_COUNTS, "n_best", "count_sum"]]
    fields += [T.StructField("groups_sha256", T.StringType())]
    own = blocks.where(F.col("groups_sha256").isNotNull()).select("block", key, *_COUNTS, "groups_sha256", "at", "times")
    told = told.toDF(*told.columns)
    out = stage(own.groupBy("block").cogroup(told.groupBy("block")).applyInPandas(run, T.StructType(fields)), "links")
    discard(blocks)
    return out.withColumn(key, F.col(key).cast(kind))
