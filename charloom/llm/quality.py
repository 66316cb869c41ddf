"""Quality classifier: hashed word n-grams and a logistic regression trained by FTRL (operator 8)."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from charloom.llm.common import fold, labelled_sample

BITS = 18
#: Labelled documents per class that are learnt from.
SAMPLE_PER_CLASS = 8_000
#: Words whose hashes a worker remembers at a time.
CACHE_WORDS = 400_000
_RUNS = re.compile(r"(.)\1+")
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shape(word: str) -> str:
    """The form of a word: runs of upper case, lower case and digits as X, x, 0; other characters stay."""
    out = "".join("X" if c.isupper() else "x" if c.isalpha() else "0" if c.isdigit() else c for c in word)
    return _RUNS.sub(r"\1", out)


class Features:
    """Sparse unit vectors of texts: word and word-form n-grams of one and two words, hashed to ``2**bits``.

    Words are runs without ASCII white space. A pair of the same word twice has a mark of its own, so repetition
    is seen whatever the word. Index 0 is the constant.
    """

    def __init__(self, bits: int = BITS):
        self.shift = np.uint64(64 - bits)
        self.seen: dict[str, tuple[int, int]] = {}

    def _add(self, words: list[str]) -> None:
        if len(self.seen) > CACHE_WORDS:
            self.seen = {}
        for w in words:
            if w not in self.seen:
                self.seen[w] = (zlib.crc32(w.encode("utf-8", "surrogatepass")), zlib.crc32(shape(w).encode("utf-8", "surrogatepass")))

    def _index(self, h: np.ndarray, kind: int) -> np.ndarray:
        return ((h + np.uint64(kind)) * _GOLD) >> self.shift

    def __call__(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = re.split(r"[\x20\x09-\x0D]+", text.strip("\x20\x09\x0a\x0b\x0c\x0d")) if text else []
        if not words or words == [""]:
            return np.zeros(1, np.int64), np.ones(1, np.float32)
        self._add(words)
        both = np.array([self.seen[w] for w in words], dtype=np.uint64)
        w, s = both[:, 0], both[:, 1]
        again = (w[1:] == w[:-1]).astype(np.uint64)
        parts = [
            self._index(w, 1),
            self._index(w[:-1] * np.uint64(31) + (w[1:] << np.uint64(20)), 2),
            self._index(s, 3),
            self._index(s[:-1] * np.uint64(31) + (s[1:] << np.uint64(20)) + (again << np.uint64(60)), 4),
        ]
        index, count = np.unique(np.concatenate(parts).astype(np.int64), return_counts=True)
        value = np.log1p(count).astype(np.float32)
        value /= np.sqrt(np.dot(value, value))
        keep = index != 0
        return np.append(index[keep], 0), np.append(value[keep], np.float32(1))


def train_ftrl(
    rows: list[tuple[np.ndarray, np.ndarray, int, float]],
    bits: int = BITS,
    epochs: int = 4,
    alpha: float = 0.6,
    beta: float = 1.0,
    l1: float = 0.05,
    l2: float = 0.05,
) -> np.ndarray:
    """Weights after follow-the-regularised-leader updates over ``(index, value, label, weight)``.

    Per-coordinate rates; a coordinate whose sum of gradients stays below ``l1`` has weight 0. The constant is
    not regularised.
    """
    z, n = np.zeros(1 << bits), np.zeros(1 << bits)

    def weights(i: np.ndarray) -> np.ndarray:
        own = np.where(i == 0, 0.0, l1)
        shrunk = z[i] - np.sign(z[i]) * own
        return np.where(np.abs(z[i]) <= own, 0.0, -shrunk / ((beta + np.sqrt(n[i])) / alpha + np.where(i == 0, 0, l2)))

    order = np.random.default_rng(7)
    for _ in range(epochs):
        for at in order.permutation(len(rows)):
            i, x, y, weight = rows[at]
            w = weights(i)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * weight * x
            sigma = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - sigma * w
            n[i] += g * g
    return weights(np.arange(1 << bits)).astype(np.float32)


def train(docs: DataFrame, labels: DataFrame, *, key: str, text: str, label: str, bits: int, per_class: int) -> np.ndarray:
    """Weights from a bounded, documented sample: features are made where the texts are, one task updates.

    Sampled rows count alike at every size; what the shares take from the ratio of the classes goes to the constant.
    """
    sample = labelled_sample(docs, labels, label, per_class, key=key, text=text)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make = Features(bits)
        for batch in batches:
            rows = [make(t) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "index": [i.astype("<i4").tobytes() for i, _ in rows],
                    "value": [v.astype("<f4").tobytes() for _, v in rows],
                    "label": batch["label"],
                    "share": batch["share"],
                }
            )

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["index", "value", "label"])  # the same order whatever the layout
        rows = [
            (np.frombuffer(i, "<i4").astype(np.int64), np.frombuffer(v, "<f4"), int(y), 1.0)
            for i, v, y in zip(part["index"], part["value"], part["label"], strict=True)
        ]
        w = train_ftrl(rows, bits)
        share = part.groupby("label")["share"].first()
        if {0, 1} <= set(share.index):
            w[0] += np.log(share[0] / share[1])
        used = np.flatnonzero(w)
        return pd.DataFrame({"index": used.astype("int64"), "weight": w[used].astype("float64")})

    made = sample.mapInPandas(vectors, "index binary, value binary, label int, share double")
    # The sample is bounded, so one task may have it whole.
    got = made.groupBy().applyInPandas(learn, "index long, weight double").collect()
    weights = np.zeros(1 << bits, np.float32)
    for r in got:
        weights[r[0]] = r[1]
    return weights


def score_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    threshold: float = 0.3,
    bits: int = BITS,
    per_class: int = SAMPLE_PER_CLASS,
) -> DataFrame:
    """Probability that a text has label 1: ``(key, held_out, score, predicted)`` per row of ``docs``.

    A text is a sparse vector of hashed n-grams over the whole text, its score the logistic of a dot product
    with the trained weights, which are ``2**bits`` numbers and so may be broadcast. Only the text enters a
    score. Labels are learnt from keys that are not held out (``fold``; NULL keys are held out), from at most
    about ``per_class`` documents of each class; the constant brings the sample's ratio of classes back to that of all labels.

    NULL, empty and blank texts get the score of the constant; without usable labels all scores are 0.5. Rows
    that repeat are scored alike; other columns do not matter. An empty table gives an empty result.
    """
    weights = train(docs, labels, key=key, text=text, label=label, bits=bits, per_class=per_class)
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make, w = Features(bits), shared.value.astype(np.float64)
        for batch in batches:
            raw = np.empty(len(batch))
            for at, t in enumerate(batch["_text"]):
                i, x = make(t)
                raw[at] = w[i] @ x
            out = batch.drop(columns="_text")
            out["score"] = 1 / (1 + np.exp(-np.clip(raw, -35, 35)))
            out["predicted"] = (out["score"] >= threshold).astype("int32")
            yield out

    fields = [T.StructField(key, T.StringType()), T.StructField("held_out", T.BooleanType())]
    fields += [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]
    # The key travels as text, for pandas turns whole numbers beside NULLs into floating ones.
    own = F.col(key).cast("string").alias(key)
    narrow = docs.select(own, (fold(F.col(key), 5) == 0).alias("held_out"), F.col(text).alias("_text"))
    scored = narrow.mapInPandas(run, T.StructType(fields))
    return scored.withColumn(key, F.col(key).cast(docs.schema[key].dataType))
