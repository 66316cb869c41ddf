"""Toxic spans by a linear-chain conditional random field (operator 10)."""

from __future__ import annotations

import pickle
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from charloom.llm.common import fold, labelled_sample, shield, unshield

BITS = 18
#: Labelled documents per class that are learnt from.
SAMPLE_PER_CLASS = 2_000
#: Characters of text that are tagged at a time, words a worker remembers, and tokens that training takes at a time:
#: whole texts, so a longer one is taken alone. They bound a worker's memory and leave no text or token out.
CHUNK_CHARS, CACHE_WORDS, BLOCK_TOKENS = 400_000, 200_000, 1 << 16
#: A word or word start marks toxic documents if it is in so many of them, and that much more often than elsewhere.
MIN_MARKED, MIN_LIFT, MIN_PART_OF_BEST = 5, 20.0, 0.2
TOKEN = re.compile(r"[^\W_]+")


#: What a token label can rest on: the word in lower case (None) and, of longer words, their first letters.
KEY_STARTS = (None, 4, 5, 6)


def word_keys(words: Iterable[str], n: int | None) -> tuple[np.ndarray, int]:
    """Per word the number of its key of one kind (``KEY_STARTS``), -1 without one; and the number of keys."""
    ids: dict[str, int] = {}
    lowered = (w.lower() for w in words)
    found = array("i", (-1 if n is not None and len(w) <= n else ids.setdefault(w[:n], len(ids)) for w in lowered))
    return np.array(found, np.int32), len(ids)


def _hash(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


#: Features of a word.
N_FEATURES = 7


def word_features(word: str, bits: int = BITS) -> list[int]:
    """Hashed features of a token: word, starts of 3 to 6 letters, end of 3, and form."""
    w = word.lower()
    form = "X" if word.isupper() else "Xx" if word[:1].isupper() else "0" if word.isdigit() else "x"
    names = [f"w:{w}", f"f:{form}", f"e:{w[-3:]}", *(f"s:{w[:n]}" for n in (3, 4, 5, 6))]
    return [_hash(x) >> (32 - bits) for x in names]


# --- the chain --------------------------------------------------------------------------------------


class Chain:
    """Forward and backward messages of many two-state chains laid end to end.

    A token's matrix is ``M[i, j] = T[i, j] * psi[j]``; at the first token of a text all rows are the start
    row, which cuts the chain there. The long chain is folded into about ``sqrt(n)`` rows: the products of the
    rows are formed side by side, passed from row to row, and carried through the rows side by side again. So
    a text of any length takes part whole, and the messages are exact.
    """

    def __init__(self, emission: np.ndarray, first: np.ndarray, trans: np.ndarray, start: np.ndarray):
        n = len(emission)
        self.n, self.k = n, max(1, int(np.sqrt(n)))
        rows = -(-n // self.k)
        pad = rows * self.k - n
        e = np.concatenate([emission, np.zeros(pad)]).reshape(rows, self.k)
        f = np.concatenate([first, np.ones(pad, bool)]).reshape(rows, self.k)
        e = np.clip(e, -30, 30)
        psi = np.stack([np.exp(-np.maximum(e, 0)), np.exp(np.minimum(e, 0))], -1)  # the larger one is 1
        t, s = np.exp(trans), np.exp(start)
        self.m = np.where(f[..., None, None], s[None, :], t) * psi[..., None, :]  # rows, k, i, j
        self.alpha, self.beta = self._forward(), self._backward()

    def _forward(self) -> np.ndarray:
        m = self.m
        rows = len(m)
        product = np.broadcast_to(np.eye(2), (rows, 2, 2))
        for t in range(self.k):
            product = product @ m[:, t]
            product = product / product.max((1, 2), keepdims=True)
        into = np.empty((rows, 2))
        v = np.array([0.5, 0.5])
        for r in range(rows):
            into[r] = v
            v = v @ product[r]
            v = v / v.sum()
        alpha = np.empty((rows, self.k, 2))
        for t in range(self.k):
            into = into[:, :1] * m[:, t, 0] + into[:, 1:] * m[:, t, 1]
            into /= into.sum(1, keepdims=True)
            alpha[:, t] = into
        self.product = product
        return alpha

    def _backward(self) -> np.ndarray:
        m = self.m
        rows = len(m)
        into = np.empty((rows, 2))
        v = np.array([0.5, 0.5])
        for r in range(rows - 1, -1, -1):
            into[r] = v
            v = self.product[r] @ v
            v = v / v.sum()
        beta = np.empty((rows, self.k, 2))
        for t in range(self.k - 1, -1, -1):
            beta[:, t] = into
            into = m[:, t, :, 0] * into[:, :1] + m[:, t, :, 1] * into[:, 1:]
            into /= into.sum(1, keepdims=True)
        return beta

    def marginals(self) -> np.ndarray:
        """Probability of state 1 for each token."""
        both = self.alpha * self.beta
        return (both[..., 1] / both.sum(-1)).reshape(-1)[: self.n]

    def pairs(self, first: np.ndarray) -> np.ndarray:
        """Expected number of transitions ``i -> j`` inside texts."""
        alpha, beta = self.alpha.reshape(-1, 2)[: self.n], self.beta.reshape(-1, 2)[: self.n]
        m = self.m.reshape(-1, 2, 2)[: self.n]
        inner = np.flatnonzero(~first)
        inner = inner[inner > 0]
        xi = alpha[inner - 1][:, :, None] * m[inner] * beta[inner][:, None, :]
        return (xi / xi.sum((1, 2), keepdims=True)).sum(0)


class Model:
    """Weights of the field, and the numbers that turn marginals into a document's probability."""

    def __init__(self, bits: int = BITS):
        self.bits = bits
        self.own, self.left, self.right = (np.zeros(1 << bits) for _ in range(3))
        self.bias, self.trans, self.start = -4.0, np.zeros((2, 2)), np.zeros(2)
        self.doc = np.zeros(4)
        self.prior = 0.5


class Vocabulary:
    """Codes of words; the hashed features of new ones are kept until they are taken."""

    def __init__(self, bits: int = BITS):
        self.bits, self.code, self.new = bits, {}, array("i")

    def __call__(self, words: list[str]) -> np.ndarray:
        code = self.code
        for w in words:
            if w not in code:
                code[w] = len(code)
                self.new.extend(word_features(w, self.bits))
        return np.fromiter((code[w] for w in words), np.int32, len(words))

    def take(self) -> np.ndarray:
        """Features of the words met since the last call, a row each."""
        rows, self.new = np.array(self.new, np.int32).reshape(-1, N_FEATURES), array("i")
        return rows


def _shifted(score: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A per-token value seen from the next and from the previous token of the same text."""
    before, after = np.zeros(len(score)), np.zeros(len(score))
    before[1:] = np.where(first[1:], 0, score[:-1])
    after[:-1] = np.where(first[1:], 0, score[1:])
    return before, after


def _sums(model: Model, table: np.ndarray) -> np.ndarray:
    """What each word adds to its own token, to the one after it and to the one before it."""
    out = np.zeros((3, len(table)))
    for row, w in zip(out, (model.own, model.left, model.right), strict=True):
        for feature in table.T:
            row += w[feature]
    return out


def _chain(model: Model, sums: np.ndarray, codes: np.ndarray, first: np.ndarray) -> Chain:
    before, _ = _shifted(sums[1][codes], first)
    _, after = _shifted(sums[2][codes], first)
    return Chain(sums[0][codes] + before + after + model.bias, first, model.trans, model.start)


def mark_tokens(words: list[str], codes: np.ndarray, sizes: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """Token labels from document labels: in toxic documents, the words that tell them from the others.

    ``codes`` are the texts end to end, as numbers into ``words``, and ``sizes`` their lengths. A key (``word_keys``)
    marks if enough toxic documents have it and few others. Within one document the marks that are rare beside its
    strongest one are left out, for copies of a document share all their words.
    """
    ends = np.cumsum(sizes)
    n1, n0 = max(1, int(toxic.sum())), max(1, int((~toxic).sum()))
    strength = np.zeros(len(words), np.int64)
    for n in KEY_STARTS:  # the keys of one kind at a time
        key_of, count = word_keys(words, n)
        having = np.zeros((2, count + 1), np.int64)  # the last is of words without a key
        for end, size, t in zip(ends, sizes, toxic, strict=True):
            having[int(t), np.unique(key_of[codes[end - size : end]])] += 1
        clean, found = having[:, :count]
        marks = np.where((found >= MIN_MARKED) & (found / n1 >= MIN_LIFT * (clean + 0.5) / n0), found, 0)
        strength = np.maximum(strength, np.append(marks, 0)[key_of])
    out = np.zeros(len(codes), np.uint8)
    for end, size in zip(ends[toxic], sizes[toxic], strict=True):
        s = strength[codes[end - size : end]]
        out[end - size : end] = (s > 0) & (s >= MIN_PART_OF_BEST * s.max(initial=0))
    return out


def blocks(sizes: np.ndarray, tokens: int) -> list[tuple[int, int]]:
    """Runs of texts ``(from, to)`` with about so many tokens each; a longer text is a run of its own."""
    out, begin, held = [], 0, 0
    for at, size in enumerate(sizes):
        if at > begin and held + size > tokens:
            out.append((begin, at))
            begin, held = at, 0
        held += size
    return [*out, (begin, len(sizes))]


def train_chain(texts: list[str], toxic: np.ndarray, weight: np.ndarray, rounds: int = 25, bits: int = BITS) -> Model:
    """Maximum likelihood by AdaGrad over all tokens of the sample, then the document's logistic.

    A token is kept in 6 bytes. Each round goes through all of them, block by block (``BLOCK_TOKENS``), and sums
    the blocks' gradients, so the messages of one block are in memory at a time.
    """
    model, words = Model(bits), Vocabulary(bits)
    total = weight.sum()
    model.prior = float(weight[toxic].sum() / total) if total else 0.5
    coded = [words(TOKEN.findall(t)) for t in texts]
    sizes = np.array([len(c) for c in coded], np.int64)
    filled = np.flatnonzero(sizes)
    if not len(filled) or toxic.all() or not toxic.any():
        model.doc = np.array([0.0, 0.0, 0.0, np.log((model.prior + 1e-6) / (1 - model.prior + 1e-6))])
        return model
    codes = np.concatenate(coded)
    del coded
    y = mark_tokens(list(words.code), codes, sizes, toxic)
    table, n = words.take(), len(codes)
    del words
    sizes = sizes[filled]
    starts = np.cumsum(sizes) - sizes
    first = np.zeros(n, bool)
    first[starts] = True
    parts = [(a, b, slice(starts[a], starts[b - 1] + sizes[b - 1])) for a, b in blocks(sizes, BLOCK_TOKENS)]
    seen = np.zeros((2, 2))
    for _, _, part in parts:
        mine = y[part]
        seen += np.bincount((2 * mine[:-1] + mine[1:])[~first[part][1:]], minlength=4).reshape(2, 2)
    state = {k: np.full(np.shape(getattr(model, k)), 1e-8) for k in ("own", "left", "right", "bias", "trans", "start")}

    def step(name: str, g: np.ndarray | float, rate: float) -> None:
        state[name] = state[name] + np.square(g)
        setattr(model, name, getattr(model, name) - rate * g / np.sqrt(state[name]))

    for _ in range(rounds):
        sums = _sums(model, table)
        by_word, pairs, bias, at = np.zeros(sums.shape), np.zeros((2, 2)), 0.0, 0.0
        for _, _, part in parts:
            mine, begins = codes[part], first[part]
            chain = _chain(model, sums, mine, begins)
            d = (chain.marginals() - y[part]) / n
            before, after = _shifted(d, begins)
            for row, by_token in zip(by_word, (d, after, before), strict=True):
                row += np.bincount(mine, by_token, len(row))
            pairs += chain.pairs(begins)
            bias, at = bias + d.sum(), at + d[begins].sum()
        for name, row in zip(("own", "left", "right"), by_word, strict=True):
            g = sum(np.bincount(feature, row, 1 << bits) for feature in table.T)
            step(name, g + 1e-8 * getattr(model, name), 0.5)
        step("bias", float(bias), 0.2)
        step("trans", (pairs - seen) / n, 0.2)
        step("start", np.array([-at, at]), 0.2)
    sums = _sums(model, table)
    x = np.tile(NO_TOKEN, (len(texts), 1))
    for a, b, part in parts:
        p = _chain(model, sums, codes[part], first[part]).marginals()
        x[filled[a:b]] = doc_features(p, starts[a:b] - starts[a])
    w = weight / total
    for _ in range(2000):
        q = 1 / (1 + np.exp(-np.clip(x @ model.doc, -35, 35)))
        hess = (x * (w * (q * (1 - q) + 1e-4))[:, None]).T @ x + 1e-5 * np.eye(4)
        move = np.linalg.solve(hess, x.T @ (w * (q - toxic)) + 1e-5 * model.doc)
        model.doc = model.doc - move
        if np.abs(move).max() < 1e-7:
            break
    return model


LOWEST = -12.0
#: Features of a text without a token.
NO_TOKEN = np.array([LOWEST, 0.0, np.log(1e-5), 1.0])


def doc_features(p: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Per text: logit of its likeliest token, expected toxic tokens and their density as logarithms, constant."""
    top = np.clip(np.maximum.reduceat(p, starts), 1e-12, 1 - 1e-12)
    logit = np.clip(np.log(top / (1 - top)), LOWEST, -LOWEST)
    expected = np.add.reduceat(p, starts)
    sizes = np.diff(np.append(starts, len(p)))
    return np.stack([logit, np.log1p(expected), np.log(expected / sizes + 1e-5), np.ones(len(starts))], 1)


class Tagger:
    """Scores texts with a model; remembers the weights of the words it has met."""

    def __init__(self, model: Model):
        self.model = model
        self._forget()

    def _forget(self) -> None:
        self.words = Vocabulary(self.model.bits)
        self.sums = np.zeros((3, 0))

    def _weights(self) -> np.ndarray:
        new = self.words.take()
        if len(new):
            self.sums = np.concatenate([self.sums, _sums(self.model, new)], 1)
        return self.sums

    def __call__(self, texts: list[str | None], span_at: float = 0.5) -> tuple[np.ndarray, list[list[tuple]]]:
        """Document probabilities, and per document the spans ``(start, end, probability)`` in characters."""
        m = self.model
        if len(self.words.code) > CACHE_WORDS:
            self._forget()
        coded = [self.words(TOKEN.findall(t) if t else []) for t in texts]
        x = np.tile(NO_TOKEN, (len(texts), 1))
        spans: list[list[tuple]] = [[] for _ in texts]
        filled = [i for i, c in enumerate(coded) if len(c)]
        if filled:
            codes = np.concatenate(coded)
            sizes = np.array([len(coded[i]) for i in filled])
            starts = np.cumsum(sizes) - sizes
            first = np.zeros(len(codes), bool)
            first[starts] = True
            p = _chain(m, self._weights(), codes, first).marginals()
            x[filled] = doc_features(p, starts)
            hits = np.flatnonzero(p >= span_at)
            for d in np.unique(np.searchsorted(starts, hits, "right") - 1):
                mine = p[starts[d] : starts[d] + sizes[d]]
                for q, word in zip(mine, TOKEN.finditer(texts[filled[d]]), strict=True):
                    if q >= span_at:
                        spans[filled[d]].append((word.start(), word.end(), float(q)))
        return 1 / (1 + np.exp(-np.clip(x @ m.doc, -35, 35))), spans


# --- on Spark ---------------------------------------------------------------------------------------


def train(docs: DataFrame, labels: DataFrame, *, key: str, text: str, label: str, per_class: int) -> Model:
    """A model from a bounded, documented sample, learnt in one task; equal texts of a class teach once."""
    sample = labelled_sample(docs, labels, label, per_class, key=key, text=text)
    sample = sample.where(F.col("text").isNotNull()).groupBy("text", "label").agg(F.max("share").alias("share"))

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["text", "label"])  # the same order whatever the layout
        toxic = part["label"].to_numpy() == 1
        return pd.DataFrame({"model": [pickle.dumps(train_chain(part["text"].tolist(), toxic, 1 / part["share"].to_numpy()))]})

    # The sample is bounded, so one task may have it whole.
    got = sample.groupBy().applyInPandas(learn, "model binary").collect()
    return pickle.loads(got[0][0]) if got else Model()


def score_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    *,
    key: str = "doc_id",
    text: str = "text",
    label: str = "toxic",
    threshold: float = 0.5,
    per_class: int = SAMPLE_PER_CLASS,
) -> DataFrame:
    """Toxic spans and a document's probability; the columns of ``docs`` with four more.

    Adds ``_held_out``, ``_score``, ``_predicted`` and ``_spans`` (``start``, ``end`` in characters, ``p``). Tokens are
    runs of letters and digits. The field tags each token with the marginal of its forward and backward
    messages over the whole text; the likeliest token, the expected number of toxic ones and their density make the score. Token
    labels are derived from document labels (``mark_tokens``), learnt from keys that are not held out (``fold``; NULL
    keys are held out), at most about ``per_class`` documents a class, weighted back to the class sizes.

    NULL and empty texts, and texts without a token, score as a text without a toxic token and have no spans. With no
    labels of one class all scores are the share of toxic labels (0.5 without labels). Rows that repeat are scored alike;
    other columns pass through. An empty table gives an empty result.
    """
    docs, moved = shield(docs, {"_tag"}, {"_held_out", "_score", "_predicted", "_spans"})
    model = train(docs, labels, key=key, text=text, label=label, per_class=per_class)
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(model))
    kind = "score double, spans array<struct<start: int, end: int, p: double>>"

    @F.pandas_udf(kind)
    def tag(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        tagger = Tagger(pickle.loads(shared.value))
        for texts in parts:
            scores, spans, chunk, size = [], [], [], 0
            todo = texts.tolist()
            for at, t in enumerate(todo):
                chunk.append(t)
                size += len(t) if t else 0
                if size >= CHUNK_CHARS or at == len(todo) - 1:
                    s, x = tagger(chunk)
                    scores.append(s)
                    spans += [[{"start": a, "end": b, "p": q} for a, b, q in y] for y in x]
                    chunk, size = [], 0
            yield pd.DataFrame({"score": np.concatenate(scores) if scores else np.zeros(0), "spans": spans})

    tagged = docs.withColumn("_tag", tag(F.col(text)))
    out = tagged.select(
        *docs.columns,
        (fold(F.col(key), 5) == 0).alias("_held_out"),
        F.col("_tag.score").alias("_score"),
        (F.col("_tag.score") >= threshold).cast("int").alias("_predicted"),
        F.col("_tag.spans").alias("_spans"),
    )
    return unshield(out, moved)
