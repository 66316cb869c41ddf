"""Language identification by error-correcting output codes over character n-grams (operator 11)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from charloom.llm.common import fold

#: Weights per bit, n-gram lengths, labelled documents learnt from in all, and passes over them.
BITS, ORDERS, SAMPLE, EPOCHS = 17, (1, 2, 3), 6_000, 4
#: Up to so many languages get the exhaustive code; more get one of random columns.
EXHAUSTIVE = 5
#: Two languages whose decoded losses are closer than this part of their sum are ambiguous.
AMBIGUOUS = 0.1
#: Characters of a piece of text that is turned into n-grams at a time.
CHUNK = 1 << 20
_SPACE = 32


def codebook(languages: int, seed: int = 5) -> np.ndarray:
    """A codeword of +1 and -1 per language, a column per binary classifier.

    No column is constant, repeats another or is its opposite. Few languages get all such columns; others the code, of
    several drawn, whose closest words differ most.
    """
    if languages < 2:
        return np.zeros((languages, 0), np.int8)
    if languages <= EXHAUSTIVE:
        numbers = np.arange(1, 1 << (languages - 1))
        rest = np.where((numbers[None, :] >> np.arange(languages - 1)[:, None]) & 1, 1, -1)
        return np.vstack([-np.ones(len(numbers), np.int64), rest]).astype(np.int8)
    length, draw = int(np.ceil(10 * np.log2(languages))), np.random.default_rng(seed)
    best, apart = None, -1
    for _ in range(60):
        columns: dict[bytes, np.ndarray] = {}
        while len(columns) < length:
            c = draw.choice(np.array([-1, 1], np.int8), languages)
            c = c * c[0]
            if not (c == c[0]).all():
                columns.setdefault(c.tobytes(), c)
        code = np.column_stack(list(columns.values()))
        near = code.astype(np.int32) @ code.T.astype(np.int32)
        least = (length - near[~np.eye(languages, dtype=bool)].max()) // 2
        if least > apart:
            best, apart = code, least
    return best


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point its lower-case letter, or a space where it is no letter."""
    table = np.full(0x110000, _SPACE, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            table[i] = ord(low) if len(low) == 1 else i
    return table


def letters(text: str | None) -> np.ndarray:
    """The letters of a text in lower case with one space around and between runs of them; empty without letters."""
    if not text:
        return np.zeros(0, np.uint64)
    c = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    c = np.concatenate([[_SPACE], c, [_SPACE]]).astype(np.uint64)
    keep = np.concatenate([[True], (c[1:] != _SPACE) | (c[:-1] != _SPACE)])
    c = c[keep]
    return c if len(c) > 1 else np.zeros(0, np.uint64)


def grams(c: np.ndarray, bits: int) -> np.ndarray:
    """Hashed n-grams of all lengths, as indexes of weights."""
    parts, h = [], c * np.uint64(0x9E3779B97F4A7C15)
    for n in ORDERS:
        if n > 1:
            h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + c[n - 1 :] * np.uint64(0x94D049BB133111EB)
        parts.append(((h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits))
    return np.concatenate(parts).astype(np.int64)


def pieces(c: np.ndarray) -> Iterator[np.ndarray]:
    """Bounded pieces of a text that have each of its n-grams once."""
    step, reach = CHUNK, max(ORDERS) - 1
    if len(c) <= step:
        yield c
        return
    for start in range(0, len(c), step):
        yield c[max(0, start - reach) : start + step]


def features(text: str | None, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index and share of each hashed n-gram of the whole text; nothing without letters."""
    c, total = letters(text), np.zeros(0)
    for part in pieces(c) if len(c) else ():
        n = np.bincount(grams(part, bits), minlength=1 << bits)
        total = n if not len(total) else total + n
    index = np.flatnonzero(total)
    return index, (total[index] / total.sum()).astype(np.float32) if len(index) else np.zeros(0, np.float32)


class Model:
    """Weights of the binary classifiers, the codebook, and how far each bit of each word can be trusted."""

    def __init__(self, langs: list[str], code: np.ndarray, weights: np.ndarray, constant: np.ndarray, trust: np.ndarray):
        self.langs, self.code, self.weights, self.constant, self.trust = langs, code, weights, constant, trust

    def margins(self, text: str | None, bits: int) -> np.ndarray | None:
        """One margin per classifier; None for a text without letters."""
        c = letters(text)
        if not len(c):
            return None
        total, n = np.zeros(self.code.shape[1]), 0
        for part in pieces(c):
            at = grams(part, bits)
            total += self.weights[at].sum(0, dtype=np.float64)
            n += len(at)
        return total / n + self.constant

    def decode(self, margin: np.ndarray) -> tuple[int, float, bool]:
        """The language whose word costs least, its share among all words, and whether the next one is as near.

        A bit costs the logistic loss of its margin, weighted by the trust in that bit of that word.
        """
        bits = self.code.shape[1]
        if not bits:
            return 0, 1.0, False
        loss = (self.trust * np.logaddexp(0, -self.code * margin)).sum(1)
        order = np.argsort(loss, kind="stable")
        share = np.exp(-(loss - loss[order[0]]) * bits)
        close = loss[order[1]] - loss[order[0]] < AMBIGUOUS * (loss[order[0]] + loss[order[1]])
        return int(order[0]), float(1 / share.sum()), bool(close)


def _rates(langs: np.ndarray) -> np.ndarray:
    """Rows of a rare language count as much in all as those of a frequent one."""
    n = np.bincount(langs)
    return (len(langs) / (len(n[n > 0]) * np.maximum(n, 1)))[langs]


def fit(rows: list[tuple[np.ndarray, np.ndarray]], langs: np.ndarray, code: np.ndarray, bits: int, epochs: int = EPOCHS):
    """Weights and constants of one logistic classifier per column, by adaptive gradient steps row by row."""
    width = code.shape[1]
    w, g2 = np.zeros((1 << bits, width), np.float32), np.full((1 << bits, width), 1e-8, np.float32)
    b, b2 = np.zeros(width), np.full(width, 1e-8)
    want, rate = (code[langs] > 0).astype(np.float64), _rates(langs)
    order = np.random.default_rng(11)
    for _ in range(epochs):
        for at in order.permutation(len(rows)):
            i, x = rows[at]
            own = w[i]
            error = (1 / (1 + np.exp(-np.clip(x @ own + b, -35, 35))) - want[at]) * min(rate[at], 10.0)
            step = x[:, None] * error.astype(np.float32)
            past = g2[i] + step * step
            g2[i] = past
            w[i] = own - 4.0 * step / np.sqrt(past)
            b2 += error * error
            b -= 0.05 * error / np.sqrt(b2)
    return w, b


def learn(rows: list[tuple[np.ndarray, np.ndarray]], langs: np.ndarray, names: list[str], bits: int) -> Model:
    """Classifiers from all rows; the trust in their bits from a fifth that a first fit has not seen."""
    code = codebook(len(names))
    aside = np.arange(len(rows)) % 5 == 4
    trust = np.ones(code.shape)
    if code.shape[1]:
        w, b = fit([rows[i] for i in np.flatnonzero(~aside)], langs[~aside], code, bits)
        for k in range(len(names)):
            seen = [x @ w[i] + b for i, x in (rows[j] for j in np.flatnonzero(aside & (langs == k)))]
            right = np.sum([m * code[k] > 0 for m in seen], axis=0) if seen else 0
            trust[k] = (right + 1) / (len(seen) + 2)
        w, b = fit(rows, langs, code, bits)
    else:
        w, b = np.zeros((1 << bits, 0), np.float32), np.zeros(0)
    return Model(names, code, w, b, trust / np.maximum(trust.sum(1, keepdims=True), 1e-12))


def train(docs: DataFrame, *, key: str, text: str, lang: str, folds: int, held_out: int, bits: int, sample: int) -> Model:
    """A model from a bounded sample of the labelled texts: features where the texts are, one task learns.

    Each language gets an equal part of ``sample``, by a hash of key and text. Texts without letters teach nothing.
    """
    known = docs.where((fold(F.col(key), folds) != held_out) & F.col(lang).isNotNull() & F.col(text).rlike("\\p{L}"))
    sizes = {r[0]: r[1] for r in known.groupBy(F.col(lang).cast("string")).count().collect()}
    names = sorted(sizes)
    if len(names) < 2:  # nothing to tell apart
        code = codebook(len(names))
        return Model(names, code, np.zeros((1 << bits, 0), np.float32), np.zeros(0), np.ones(code.shape))
    each = max(1, sample // len(names))
    parts = [F.lit(v) for x in names for v in (x, min(1.0, each / sizes[x]))]
    share = F.element_at(F.create_map(*parts), F.col("lang"))
    drawn = F.pmod(F.xxhash64("key", "text", F.lit("sample")), F.lit(1 << 20)) < share * (1 << 20)
    rows = known.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).cast("string").alias("lang")).where(drawn)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [features(t, bits) for t in batch["text"]]
            yield pd.DataFrame(
                {
                    "lang": batch["lang"],
                    "index": [i.astype("<i4").tobytes() for i, _ in made],
                    "share": [x.astype("<f4").tobytes() for _, x in made],
                }
            )

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["index", "share", "lang"])  # the same order whatever the layout
        number = {x: i for i, x in enumerate(names)}
        made = [
            (np.frombuffer(i, "<i4").astype(np.int64), np.frombuffer(x, "<f4"))
            for i, x in zip(part["index"], part["share"], strict=True)
        ]
        m = learn(made, part["lang"].map(number).to_numpy(np.int64), names, bits)
        used = np.flatnonzero(m.weights.any(1)) if m.code.shape[1] else np.zeros(0, np.int64)
        return pd.DataFrame(
            [(used.astype("<i4").tobytes(), m.weights[used].astype("<f4").tobytes(), m.constant.astype("<f8").tobytes(), m.trust.astype("<f8").tobytes())],
            columns=["used", "weights", "constant", "trust"],
        )

    made = rows.select("text", "lang").mapInPandas(vectors, "lang string, index binary, share binary")
    # The sample is bounded, so one task may have it whole.
    got = made.groupBy().applyInPandas(run, "used binary, weights binary, constant binary, trust binary").collect()
    code = codebook(len(names))
    weights, constant, trust = np.zeros((1 << bits, code.shape[1]), np.float32), np.zeros(code.shape[1]), np.ones(code.shape)
    for used, w, c, t in got:
        weights[np.frombuffer(used, "<i4")] = np.frombuffer(w, "<f4").reshape(-1, code.shape[1])
        constant, trust = np.frombuffer(c, "<f8"), np.frombuffer(t, "<f8").reshape(code.shape)
    return Model(names, code, weights, constant, trust)


def identify(
    docs: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    folds: int = 4,
    held_out: int = 2,
    bits: int = BITS,
    sample: int = SAMPLE,
) -> DataFrame:
    """The language of each whole text: ``(key, held_out, lang_pred, score, ambiguous)`` per row of ``docs``.

    Each language has a codeword, and each of its bits a binary classifier over the shares of hashed letter n-grams. A
    text's language is that of the nearest codeword by weighted loss; ``ambiguous`` says that another is about as near.
    ``score`` is the language's share among all words. Only the text enters a prediction; languages are learnt from
    rows that are not held out (``fold``), at most about ``sample`` of them, an equal part per language.

    NULL texts and texts without a letter are ``und`` with score 0, as is everything where no language can be learnt;
    one language alone has score 1. A NULL key counts as the empty text; rows that repeat are predicted alike; other
    columns do not matter. An empty table gives an empty result.
    """
    model = train(docs, key=key, text=text, lang=lang, folds=folds, held_out=held_out, bits=bits, sample=sample)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for batch in batches:
            found = []
            for t in batch["_text"]:
                margin = m.margins(t, bits) if m.langs else None
                best = (None, 0.0, False) if margin is None else m.decode(margin)
                found.append(("und" if best[0] is None else m.langs[best[0]], best[1], best[2]))
            out = batch.drop(columns="_text")
            names, scores, close = zip(*found, strict=True) if found else ([], [], [])
            yield out.assign(lang_pred=list(names), score=np.array(scores, float), ambiguous=np.array(close, bool))

    fields = [T.StructField(key, T.StringType()), T.StructField("held_out", T.BooleanType())]
    fields += [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("ambiguous", T.BooleanType())]
    # The key travels as text, for pandas turns whole numbers beside NULLs into floating ones.
    own = F.col(key).cast("string").alias(key)
    narrow = docs.select(own, (fold(F.col(key), folds) == held_out).alias("held_out"), F.col(text).alias("_text"))
    return narrow.mapInPandas(run, T.StructType(fields)).withColumn(key, F.col(key).cast(docs.schema[key].dataType))
