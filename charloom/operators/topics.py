"""Topics as lists of phrases of one or more words, found in one pass over each text by an automaton.

``domain_filter`` looks for single words. Here a phrase may have several, phrases may overlap or contain each other, and
every occurrence is reported. The list is given by the caller and travels with the function; a task builds its
automaton once. For word lists that are tables of their own use ``domain_semi`` and ``domain_anti``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from charloom.functions.text import words

HITS = "array<struct<phrase:int,n:bigint,first:int>>"


def word_line(text: Column) -> Column:
    """The lower-case words of a text, each with one space on either side; NULL for NULL."""
    listed = F.array_join(F.filter(words(text), lambda w: w != ""), " ")
    return F.concat(F.lit(" "), listed, F.lit(" "))


def phrase_line(phrase: str) -> str:
    """The same for a phrase of the list; one without any word is an error."""
    found = re.findall(r"[^\W_]+", phrase.lower())
    if not found:
        raise ValueError(f"no word in the phrase {phrase!r}")
    return f" {' '.join(found)} "


def build_automaton(lines: Sequence[str]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for i, line in enumerate(lines):
        automaton.add_word(line, (i, len(line)))
    automaton.make_automaton()
    return automaton


def count_phrases(automaton: ahocorasick.Automaton, line: str | None) -> list[dict]:
    """``phrase``, ``n`` and ``first`` for each phrase in a line of words: number of occurrences, words before the first."""
    found: dict[int, list[int]] = {}
    for end, (i, size) in automaton.iter(line) if line else ():
        if i in found:
            found[i][0] += 1
        else:
            found[i] = [1, line.count(" ", 0, end - size + 1)]
    return [{"phrase": i, "n": n, "first": first} for i, (n, first) in sorted(found.items())]


def phrase_hits(text: Column, phrases: Sequence[str]) -> Column:
    """Which of ``phrases`` occur in a text: an array of ``(phrase, n, first)``, by position in the list.

    Words are those of ``words``, in lower case, and only whole ones match, so punctuation and line breaks between two words do
    not count. Occurrences may overlap. Empty for NULL, empty and wordless texts; phrases that are equal word for word are an error.
    """
    lines = [phrase_line(p) for p in phrases]
    if len(set(lines)) < len(lines):
        raise ValueError("two phrases are equal")

    def search(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        automaton = build_automaton(lines)
        for batch in batches:
            if lines:
                yield pd.Series([count_phrases(automaton, x) for x in batch], index=batch.index)
            else:
                yield pd.Series([[] for _ in batch], index=batch.index)

    return F.pandas_udf(search, HITS)(word_line(text))


def topic_table(topics: Mapping[str, Sequence[str]]) -> tuple[list[str], list[list[str]]]:
    """The distinct phrases of all topics, and for each the topics that list it."""
    of: dict[str, list[str]] = {}
    for topic, phrases in topics.items():
        for p in phrases:
            of.setdefault(phrase_line(p).strip(), []).append(topic)
    return list(of), [sorted(set(x)) for x in of.values()]


def topic_hits(df: DataFrame, topics: Mapping[str, Sequence[str]], text: str = "text") -> DataFrame:
    """``df`` with ``topic_hits``, a map from each topic found in the text to the number of its phrases' occurrences.

    A phrase may belong to several topics and counts for each.
    """
    phrases, of = topic_table(topics)
    listed = F.array(*[F.array(*[F.lit(t) for t in x]) for x in of]) if of else F.array().cast("array<array<string>>")
    hits = df.withColumn("_hits", phrase_hits(F.col(text), phrases))
    pairs = F.flatten(
        F.transform(
            "_hits", lambda h: F.transform(F.get(listed, h["phrase"]), lambda t: F.struct(t.alias("topic"), h["n"].alias("n")))
        )
    )
    hits = hits.withColumn("_pairs", pairs)
    names = F.array_sort(F.array_distinct(F.transform("_pairs", lambda p: p["topic"])))

    def total(t: Column) -> Column:
        mine = F.filter("_pairs", lambda p: p["topic"] == t)
        return F.aggregate(mine, F.lit(0).cast("bigint"), lambda acc, p: acc + p["n"])

    entries = F.transform(names, lambda t: F.struct(t.alias("key"), total(t).alias("value")))
    return hits.withColumn("topic_hits", F.map_from_entries(entries)).drop("_hits", "_pairs")


def topic_filter(
    df: DataFrame, topics: Mapping[str, Sequence[str]], mode: str = "drop", weights: Mapping[str, float] | None = None, text: str = "text"
) -> DataFrame:
    """Drop rows with any phrase of any topic, keep only those, or add ``weight``: the least weight of the topics found, else 1."""
    if mode not in ("drop", "keep", "weight"):
        raise ValueError(mode)
    found = topic_hits(df, topics, text)
    if mode == "weight":
        given = F.array(*[F.when(F.map_contains_key("topic_hits", t), F.lit(float(w))) for t, w in (weights or {}).items()], F.lit(1.0))
        return found.withColumn("weight", F.array_min(given)).drop("topic_hits")
    hit = F.size("topic_hits") > 0
    return found.where(hit if mode == "keep" else ~hit).drop("topic_hits")
