"""Language detection by character-trigram profiles (multinomial naive Bayes).

The profile of a language is all of its trigrams with integer weights, the log-probability times 1000. Integer
sums do not depend on the order of addition, so a score is the same on any cluster.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from charloom.functions.text import strip_ws
from charloom.operators.ngrams import char_windows, joined
from charloom.operators.runs import count_in_runs, grams
from charloom.session import stage

GRAM = 3
SCALE = 1000
#: Rows of a profile table that may be sent to every executor, about 40 bytes each for four languages.
SHARED_GRAMS = 1_000_000
#: Characters that are looked up at a time.
RUN_CHARS = 1 << 18


@dataclass(frozen=True)
class LanguageProfiles:
    """``table``: gram and one weight column ``w0, w1, ..`` per language of ``langs``, and its number of rows.
    A weight is the gain over a gram no language knows, which weighs the same for all, so that a language
    with little training text is not favoured."""

    langs: tuple[str, ...]
    table: DataFrame
    rows: int


def _weight(count: Column, size: Column) -> Column:
    return F.round(F.log(count / size) * SCALE).cast("bigint")


def train_language_profiles(
    df: DataFrame, langs: Sequence[str], text: str = "text", lang: str = "lang"
) -> LanguageProfiles:
    """Profiles from labelled text: one shuffle of aggregated trigrams into a staged table.

    Only the sizes reach the driver, a number per language.
    """
    labelled = df.where(F.col(lang).isin(list(langs))).withColumn("lang", F.col(lang))
    counts = stage(count_in_runs(labelled, strip_ws(F.col(text)), ["lang"], ["g"], grams(GRAM, heads=False)), "grams")
    sizes = counts.groupBy("lang").agg(
        (F.sum("cnt") + F.count(F.lit(1))).alias("size"),
        _weight(F.lit(1), F.sum("cnt") + F.count(F.lit(1))).alias("unseen"),
    )
    found = {r["lang"]: (r["size"], r["unseen"]) for r in sizes.collect()}
    known = tuple(x for x in langs if x in found)
    floor = min((found[x][1] for x in known), default=0)
    gains = [
        F.coalesce(
            F.max(F.when(F.col("lang") == x, _weight(F.col("cnt") + 1, F.lit(found[x][0])) - F.lit(floor))), F.lit(0)
        ).alias(f"w{i}")
        for i, x in enumerate(known)
    ]
    table = stage(counts.groupBy("g").agg(*gains) if gains else counts.select("g"), "profiles")
    return LanguageProfiles(known, table, table.count())


def _codes(points: np.ndarray) -> np.ndarray:
    """The trigrams of a run of code points as integers."""
    c = points.astype(np.int64)
    return (c[:-2] << 42) | (c[1:-1] << 21) | c[2:] if len(c) >= GRAM else np.zeros(0, np.int64)


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def _runs(texts: list[str | None]) -> Iterator[list[str]]:
    """The texts in runs of about ``RUN_CHARS`` characters; a NULL text is an empty one."""
    run, size = [], 0
    for t in texts:
        run.append(t or "")
        size += len(run[-1])
        if size >= RUN_CHARS:
            yield run
            run, size = [], 0
    if run:
        yield run


def _gains(texts: list[str], known: np.ndarray, gains: np.ndarray) -> np.ndarray:
    """Summed weights of each text's trigrams, a column per language: one look-up for all texts."""
    sizes = np.array([len(t) for t in texts], np.int64)
    codes = _codes(_points("".join(texts)))
    start = np.cumsum(sizes) - sizes
    end = np.maximum(start, start + sizes - GRAM + 1)  # trigrams that reach into the next text are left out
    if not len(codes) or not len(known):
        return np.zeros((len(texts), gains.shape[1]), np.int64)
    at = np.minimum(np.searchsorted(known, codes), len(known) - 1)
    found = np.where((known[at] == codes)[:, None], gains[at], 0)
    upto = np.concatenate([np.zeros((1, found.shape[1]), np.int64), np.cumsum(found, axis=0)])
    # The last texts may be shorter than a trigram and start beyond the last one.
    return upto[np.minimum(end, len(codes))] - upto[np.minimum(start, len(codes))]


def _scored(profiles: LanguageProfiles, text: Column) -> Column:
    """``(n_grams, detected)`` of a text where it stands; for profiles that may be sent to every executor."""
    rows = profiles.table.toPandas()  # at most SHARED_GRAMS rows
    codes = np.array([_codes(_points(g))[0] for g in rows["g"]], dtype=np.int64)
    order = np.argsort(codes)
    weights = rows[[f"w{i}" for i in range(len(profiles.langs))]].to_numpy(np.int64)[order]
    shared = profiles.table.sparkSession.sparkContext.broadcast((codes[order], weights, profiles.langs))

    @F.pandas_udf("n_grams bigint, detected string")
    def score(texts: pd.Series) -> pd.DataFrame:
        known, gains, langs = shared.value
        out: list[tuple[int, str | None]] = []
        for run in _runs(texts.tolist()):
            total = _gains(run, known, gains)
            best = total.argmax(1) if len(langs) else np.zeros(len(run), int)
            for t, k, row in zip(run, best.tolist(), total, strict=True):
                out.append((max(0, len(t) - GRAM + 1), langs[k] if len(langs) and row[k] > 0 else None))
        return pd.DataFrame(out, columns=["n_grams", "detected"])

    return score(strip_ws(text))


def _joined_scores(rows: DataFrame, profiles: LanguageProfiles, text: str) -> DataFrame:
    """The same by joins, for profiles of any size: ``(_row, n_grams, detected)`` of rows numbered by ``_row``."""
    runs = char_windows(rows, GRAM, strip_ws(F.col(text)), ["_row"])
    grams = runs.select("_row", joined(0, GRAM).alias("g"))
    weights = [f"w{i}" for i in range(len(profiles.langs))]
    folded = (
        grams.join(profiles.table, "g", "left")
        .groupBy("_row")
        .agg(F.count(F.lit(1)).alias("n_grams"), *[F.coalesce(F.sum(w), F.lit(0)).alias(w) for w in weights])
    )
    best = F.greatest(*weights, F.lit(0)) if weights else F.lit(0)
    won = [F.when((F.col(w) == best) & (best > 0), F.lit(x)) for w, x in zip(weights, profiles.langs, strict=True)]
    return folded.select("_row", "n_grams", F.coalesce(*won, F.lit(None).cast("string")).alias("detected"))


def _numbered(df: DataFrame) -> DataFrame:
    """Staged with a number of its own per row, so that rows of one key are scored one by one."""
    return stage(df.withColumn("_row", F.monotonically_increasing_id()), "rows")


def detect_language(
    df: DataFrame, profiles: LanguageProfiles, key: str | Sequence[str], text: str = "text"
) -> DataFrame:
    """``(key, n_grams, detected)`` for the texts that have a trigram, row by row; ``key`` is one column or several.

    Ties go to the first language; a text without a known trigram has none. Profiles follow the alphabets and not the
    length of the corpus; a profile of at most ``SHARED_GRAMS`` trigrams goes to the executors and a text is scored in
    its scan task, without an exchange. A larger one is no broadcast and meets the trigrams in a join; answers are the same.
    """
    keys = [key] if isinstance(key, str) else list(key)
    if profiles.rows > SHARED_GRAMS:
        rows = _numbered(df.select(*keys, text))
        return rows.join(_joined_scores(rows, profiles, text), "_row").select(*keys, "n_grams", "detected")
    scored = df.select(*keys, _scored(profiles, F.col(text)).alias("_s"))
    return scored.select(*keys, "_s.n_grams", "_s.detected").where("n_grams > 0")


def with_detected_language(
    df: DataFrame, profiles: LanguageProfiles, key: str | Sequence[str], text: str = "text"
) -> DataFrame:
    """Add ``detected``; NULL for texts under three characters. Rows are scored one by one, also those that share a ``key``."""
    if profiles.rows > SHARED_GRAMS:
        rows = _numbered(df)
        return rows.join(_joined_scores(rows, profiles, text).drop("n_grams"), "_row", "left").drop("_row")
    return df.withColumn("detected", _scored(profiles, F.col(text))["detected"])
