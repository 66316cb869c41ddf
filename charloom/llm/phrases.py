"""Phrase mining with weighted acyclic automata (operator 13)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from charloom.llm.automata import Transducer, distinct, union
from charloom.llm.common import discard
from charloom.operators.positions import with_rank
from charloom.session import stage

#: Text bytes of one shard, and words of the corpus per prefix range.
SHARD_BYTES, RANGE_WORDS = 12 << 20, 1 << 20
#: Rows of a language that one task ranks for the report.
TOP_SALTS = 64
_PRIME = (1 << 31) - 1
_MIX = (1_000_003, 786_433, 611_953)
_BREAKS = bytes(0x0A if c in b".,;:!?\n\x0b\x0c\r" else c for c in range(256))


class Shard:
    """Word numbers of the texts of one language; 0 ends a piece."""

    def __init__(self) -> None:
        self.words: dict[bytes, int] = _Numbers()
        self.run: list[int] = []

    def add(self, text: str | None) -> int:
        raw = text.encode("utf-8", "surrogatepass") if text else b""
        number = self.words.__getitem__
        # ``bytes`` knows ASCII only: A-Z alone is lowered, and what is left of its white space is space and tab.
        for piece in raw.lower().translate(_BREAKS).split(b"\n"):
            words = piece.split()
            if words:
                self.run.extend(map(number, words))
                self.run.append(0)
        return len(raw)

    def row(self, name: str, lang: str) -> tuple:
        run = np.array(self.run, np.int32)
        counts = np.bincount(run, minlength=len(self.words) + 1)[1:]
        return name, lang, _packed(run), [w.decode("utf-8", "replace") for w in self.words], counts


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self) + 1
        return n


def _packed(numbers: np.ndarray) -> bytes:
    return zstandard.compress(numbers.astype("<i4").view(np.uint8).reshape(-1, 4).T.tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


def shards(docs: DataFrame, text: str, lang: str, shard_bytes: int) -> DataFrame:
    """``(shard, lang, run, words, counts)``: the texts as they lie, in pieces of ``shard_bytes``, as word numbers.

    A shard has a row for each of its languages; no text is shuffled.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        part, number, size = TaskContext.get().partitionId(), 0, 0
        held: dict[str, Shard] = {}

        def frame() -> pd.DataFrame:
            rows = [s.row(f"{part}-{number}", name) for name, s in held.items()]
            return pd.DataFrame(rows, columns=["shard", "lang", "run", "words", "counts"])

        for batch in batches:
            for name, body in zip(batch["lang"], batch["text"], strict=True):
                if name not in held:
                    held[name] = Shard()
                size += held[name].add(body)
                if size >= shard_bytes:
                    yield frame()
                    held, size, number = {}, 0, number + 1
        yield frame()

    narrow = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    return narrow.mapInPandas(run, "shard string, lang string, run binary, words array<string>, counts array<bigint>")


def _spread(words: list, ranges: int):
    """The range of an n-gram's prefix: its place among equal ranges of a mixed value. For arrays and for columns alike."""
    total = sum((w * m for w, m in zip(words[1:], _MIX[1:], strict=False)), words[0] * _MIX[0])
    spread = (total % _PRIME) * ranges
    return (spread - spread % _PRIME) / _PRIME


def range_of(grams: np.ndarray, prefix: int, ranges: int) -> np.ndarray:
    return _spread([grams[:, j].astype(np.int64) for j in range(prefix)], ranges).astype(np.int64)


def range_column(ids: Column, prefix: int, ranges: int) -> Column:
    return _spread([F.get(ids, F.lit(j)).cast("bigint") for j in range(prefix)], ranges).cast("int")


def _cells(shard: str, lang: str, grams: np.ndarray, prefix: int, ranges: int) -> list[tuple]:
    """Count transducers of a shard's n-grams, one for each range of prefixes."""
    if not len(grams):
        return []
    rows, counts, _ = distinct(grams, np.ones(len(grams), np.int64))
    of = range_of(rows, prefix, ranges)
    order = np.argsort(of, kind="stable")
    rows, counts, of = rows[order], counts[order], of[order]
    cuts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1]]))
    return [
        (shard, lang, int(of[a]), Transducer.build(rows[a:b], counts[a:b]).pack())
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(of)], strict=True)
    ]


_CELL = "shard string, lang string, range int, data binary"
#: In the place of a range: the row with a shard's own word numbers.
_RUN = -1


def pair_cells(cut: DataFrame, known: DataFrame, ranges: int) -> DataFrame:
    """Transducers of neighbouring frequent words, and each shard's run in corpus-wide word numbers (0: not frequent)."""

    def run(shard: pd.DataFrame, words: pd.DataFrame) -> pd.DataFrame:
        if not len(shard):
            return pd.DataFrame([], columns=["shard", "lang", "range", "data"])
        name, lang, data = shard.iloc[0][["shard", "lang", "run"]]
        local = _unpacked(data)
        to = np.zeros(int(local.max(initial=0)) + 1, np.int32)
        to[words["at"].to_numpy(np.int64)] = words["id"].to_numpy(np.int64)
        ids = to[local]
        both = (ids[:-1] > 0) & (ids[1:] > 0)
        rows = _cells(name, lang, np.column_stack([ids[:-1][both], ids[1:][both]]), 2, ranges)
        rows.append((name, lang, _RUN, _packed(ids)))
        return pd.DataFrame(rows, columns=["shard", "lang", "range", "data"])

    by = ["shard", "lang"]
    known = known.toDF(*known.columns)  # columns of its own: both sides come from the same table
    return cut.select("shard", "lang", "run").groupBy(*by).cogroup(known.groupBy(*by)).applyInPandas(run, _CELL)


def union_pairs(cells: DataFrame, least: int) -> DataFrame:
    """Per range the transducer of the frequent pairs (``shard`` NULL), and to each shard its own frequent pairs."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        lang, at = part["lang"].iloc[0], int(part["range"].iloc[0])
        rows, sums, places = union(map(Transducer.unpack, part["data"]), 2)
        often = sums >= least
        found = [(None, lang, at, Transducer.build(rows[often], sums[often]).pack())] if often.any() else []
        for shard, place in zip(part["shard"], places, strict=True):
            own = rows[place[often[place]]]
            if len(own):
                found.append((shard, lang, at, _packed(own.ravel())))
        return pd.DataFrame(found, columns=["shard", "lang", "range", "data"])

    return cells.where(F.col("range") != _RUN).groupBy("lang", "range").applyInPandas(run, _CELL)


def long_cells(cells: DataFrame, answers: DataFrame, ranges: int) -> DataFrame:
    """Transducers of the runs of three and four words whose neighbours are all frequent pairs."""

    def run(shard: pd.DataFrame, pairs: pd.DataFrame) -> pd.DataFrame:
        if not len(shard) or not len(pairs):
            return pd.DataFrame([], columns=["shard", "lang", "range", "data"])
        name, lang, data = shard.iloc[0][["shard", "lang", "data"]]
        ids = np.concatenate([_unpacked(data), np.zeros(3, np.int32)])
        known = np.concatenate([_unpacked(d) for d in pairs["data"]]).reshape(-1, 2).astype(np.int64)
        known = np.sort((known[:, 0] << 32) | known[:, 1])
        here = (ids[:-1].astype(np.int64) << 32) | ids[1:]
        ok = known[np.minimum(np.searchsorted(known, here), len(known) - 1)] == here
        start = np.flatnonzero(ok[:-2] & ok[1:-1])
        fourth = np.where(ok[start + 2], ids[start + 3], 0)
        grams = np.column_stack([ids[start], ids[start + 1], ids[start + 2], fourth])
        return pd.DataFrame(_cells(name, lang, grams, 3, ranges), columns=["shard", "lang", "range", "data"])

    by = ["shard", "lang"]
    own, told = cells.where(F.col("range") == _RUN), answers.where(F.col("shard").isNotNull())
    return own.groupBy(*by).cogroup(told.groupBy(*by)).applyInPandas(run, _CELL)


def union_long(cells: DataFrame, least: int) -> DataFrame:
    """Per range the transducer of the frequent runs of three and four words; a prefix sums to its own count."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        rows, sums, _ = union(map(Transducer.unpack, part["data"]), 4)
        three = rows.copy()
        three[:, 3] = 0
        heads, totals, at = distinct(three, sums)
        whole = (rows[:, 3] > 0) & (sums >= least)
        # What a head's frequent runs of four leave of its count stays with the head itself.
        rest = totals - np.bincount(at[whole], sums[whole], len(heads)).astype(np.int64)
        often = totals >= least
        grams, counts, _ = distinct(np.concatenate([heads[often], rows[whole]]), np.concatenate([rest[often], sums[whole]]))
        lang, place = part["lang"].iloc[0], int(part["range"].iloc[0])
        found = [(None, lang, place, Transducer.build(grams, counts).pack())] if len(grams) else []
        return pd.DataFrame(found, columns=["shard", "lang", "range", "data"])

    return cells.groupBy("lang", "range").applyInPandas(run, _CELL)


def frequent_phrases(merged: DataFrame) -> DataFrame:
    """``(lang, ids, a)`` of every n-gram of two words or more in the merged transducers."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for lang, data in zip(batch["lang"], batch["data"], strict=True):
                t = Transducer.unpack(data)
                grams = t.grams()
                ids = [[x for x in g if x] for g in grams.tolist()]
                yield pd.DataFrame({"lang": lang, "ids": ids, "a": t.compose(grams)})

    return merged.select("lang", "data").mapInPandas(run, "lang string, ids array<int>, a bigint")


def look_up(asked: DataFrame, merged: DataFrame, ranges: int) -> DataFrame:
    """``(lang, part, f)`` for the distinct parts of two and three words that are asked for.

    Parts go to the range of their prefix and are composed with its transducer.
    """
    size = F.size("part")
    place = F.when(size == 2, range_column(F.col("part"), 2, ranges)).otherwise(range_column(F.col("part"), 3, ranges))
    asked = asked.select("lang", "part", size.alias("words"), place.alias("range"))

    def run(wanted: pd.DataFrame, parts: pd.DataFrame) -> pd.DataFrame:
        if not len(wanted):
            return pd.DataFrame([], columns=["lang", "part", "f"])
        grams = np.array(wanted["part"].tolist(), np.int64)
        f = sum((Transducer.unpack(d).compose(grams) for d in parts["data"]), np.zeros(len(grams), np.int64))
        return pd.DataFrame({"lang": wanted["lang"], "part": wanted["part"], "f": f})

    by = ["lang", "words", "range"]
    found = asked.groupBy(*by).cogroup(merged.groupBy(*by)).applyInPandas(run, "lang string, part array<int>, f bigint")
    return found


def scored(phrases: DataFrame, words: DataFrame, merged: DataFrame, ranges: int) -> DataFrame:
    """Phrases with their lowest-scoring cut: ``(lang, ids, a, l, r, score)``."""
    cut = F.explode(F.sequence(F.lit(1), F.size("ids") - 1)).alias("k")
    cuts = phrases.select("*", cut).select(
        "*",
        F.slice("ids", F.lit(1), F.col("k")).alias("head"),
        F.slice("ids", F.col("k") + 1, F.size("ids") - F.col("k")).alias("tail"),
    )
    both = cuts.select("lang", F.explode(F.array("head", "tail")).alias("part")).distinct()
    one = (
        both.where(F.size("part") == 1)
        .withColumn("id", F.col("part")[0])
        .join(words.select("lang", "id", F.col("f")), ["lang", "id"])
        .select("lang", "part", "f")
    )
    parts = stage(one.unionByName(look_up(both.where(F.size("part") > 1), merged, ranges)), "parts")
    named = cuts.join(parts.select("lang", F.col("part").alias("head"), F.col("f").alias("l")), ["lang", "head"])
    named = named.join(parts.select("lang", F.col("part").alias("tail"), F.col("f").alias("r")), ["lang", "tail"])
    # Whole numbers of 38 digits: no product is cut or rounded.
    score = F.expr("(cast(2000000 as decimal(10, 0)) * cast(a as decimal(20, 0))) div (cast(l as decimal(20, 0)) + r)")
    best = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    return named.groupBy("lang", "ids", "a").agg(best).select("lang", "ids", "a", "cut.l", "cut.r", "cut.score")


def not_inside(phrases: DataFrame, share: int) -> DataFrame:
    """``(lang, ids)`` of phrases that lie in no longer one with ``share`` per cent of their count or more."""
    spans = [(s, n) for n in (2, 3) for s in range(1, 5 - n + 1)]
    inner = F.array(*[F.when((F.size("ids") > n) & (F.size("ids") >= s + n - 1), F.slice("ids", s, n)) for s, n in spans])
    longer = (
        phrases.where(F.size("ids") > 2)
        .select("lang", F.explode(inner).alias("ids"), F.col("a").alias("around"))
        .where(F.col("ids").isNotNull())
        .groupBy("lang", "ids")
        .agg(F.max("around").alias("around"))
    )
    covered = F.expr(f"cast(100 as decimal(10, 0)) * around >= cast({int(share)} as decimal(10, 0)) * a")
    going = phrases.join(longer, ["lang", "ids"]).where(covered).select("lang", "ids")
    return phrases.join(going, ["lang", "ids"], "left_anti")


def mine_phrases(
    docs: DataFrame,
    *,
    text: str = "text",
    lang: str = "lang",
    least: int = 30,
    covered: int = 80,
    top: int = 2000,
    shard_bytes: int = SHARD_BYTES,
    range_words: int = RANGE_WORDS,
) -> DataFrame:
    """The best collocations of two to four words of each language: ``(lang, rank, phrase, a, l, r, n, score)``.

    Texts are lower-cased in A-Z, cut into pieces at ``.,;:!?`` and line ends, and pieces into words at spaces and tabs.
    A phrase with ``least`` occurrences is a candidate; its score is that of its weakest cut in two; it goes where a
    longer one around it has ``covered`` per cent of its count. The ``top`` of each language are returned.

    * *Shards.* Texts are numbered where they lie. Words are counted corpus-wide, and a phrase with a rare word or a
      rare pair is rare itself, so shards hand in pairs of frequent words, and then runs of three and four words whose
      pairs are all frequent: sorted, each range of prefixes as an automaton that is built n-gram by n-gram.
    * *Union.* The automata of a prefix range are united and counts of equal n-grams summed; the count of a prefix is
      the sum over its range of ranks. Nothing that can reach ``least`` is lost.
    * *Parts.* The parts of two and three words of all cuts are composed with the automata of their own ranges; those
      of one word are looked up in the vocabulary.

    Ranges are equal shares of the mixed prefix of two or three words, so a frequent first word is spread over all of
    them; a prefix that is frequent in all shards has one row of an automaton in each. NULL texts are empty, a NULL
    language is ``und``; repeated rows count as often as they occur; other columns do not matter. An empty table, or one
    without candidates, gives no rows.
    """
    cut = stage(shards(docs, text, lang, shard_bytes), "shards")
    rows = cut.select("shard", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("at", "w"))
    rows = rows.select("shard", "lang", (F.col("at") + 1).alias("at"), F.col("w.words").alias("word"), F.col("w.counts").alias("f"))
    sizes = cut.groupBy("lang").agg(
        F.sum(F.aggregate("counts", F.lit(0).cast("bigint"), lambda s, x: s + x)).alias("n")
    )
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranges = max(1, -(-total // range_words))
    often = rows.groupBy("lang", "word").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    words = stage(
        with_rank(stage(often, "frequent"), ["lang"], ["word"], "id").select("lang", "word", "f", (F.col("id") + 1).cast("int").alias("id")),
        "vocabulary",
    )
    known = rows.select("shard", "lang", "at", "word").join(words, ["lang", "word"]).select("shard", "lang", "at", "id")
    cells = stage(pair_cells(cut, known, ranges), "pairs")
    answers = stage(union_pairs(cells, least), "frequent-pairs")
    longer = stage(union_long(long_cells(cells, answers, ranges), least), "runs")
    merged = answers.where(F.col("shard").isNull()).select("lang", F.lit(2).alias("words"), "range", "data")
    merged = merged.unionByName(longer.select("lang", F.lit(3).alias("words"), "range", "data"))
    phrases = stage(frequent_phrases(merged), "phrases")
    best = scored(not_inside(phrases, covered), words, merged, ranges)
    spelt = (
        best.select("*", F.posexplode("ids").alias("at", "id"))
        .join(words.select("lang", "id", "word"), ["lang", "id"])
        .groupBy("lang", "ids", "a", "l", "r", "score")
        .agg(F.array_sort(F.collect_list(F.struct("at", "word"))).alias("named"))
        .withColumn("phrase", F.array_join(F.transform("named", lambda x: x["word"]), " "))
    )
    # A language may have most of the phrases: the best of each salt first, then the best of those.
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    salted = spelt.withColumn("salt", F.pmod(F.xxhash64("ids"), F.lit(TOP_SALTS)))
    heads = salted.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
    heads = heads.where(F.col("rank") <= top).drop("salt")
    ranked = heads.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    out = stage(
        ranked.where(F.col("rank") <= top).join(F.broadcast(sizes), "lang").select(
            "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score"
        ),
        "mined",
    )
    for done in (cut, cells, answers, longer, phrases):
        discard(done)
    return out
