"""Near-duplicate vectors by iterative quantisation and multi-index Hamming tables (operator 6)."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from charloom.llm.common import block_pairs, components
from charloom.llm.vectors import by_length, usable
from charloom.session import stage

#: Vectors that the rotations are learnt from, most bits of one rotation, bits of the code that prunes a bucket.
SAMPLE, BITS, CODE_BITS = 4096, 64, 64
#: Rows of a bucket on average: the width of a table's key is the logarithm of the rows over it, and at most ``MOST_WIDTH``.
BUCKET_ROWS, MOST_WIDTH = 64, 24
#: Pairs at the threshold that are planted in the sample for each kind of direction, and the part of them that may stay unmet.
PLANTED, MISSED = 4096, 0.0005
#: Tables from which on narrower keys are taken instead of more tables.
MOST_TABLES = 128


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def planted_pairs(x: np.ndarray, threshold: float, count: int = PLANTED, seed: int = 3) -> list[tuple[np.ndarray, np.ndarray]]:
    """Pairs of unit vectors at the threshold, by kind: apart in any direction, apart as the vectors of ``x`` are, and those in ``x``."""
    r = np.random.default_rng(seed)
    left = x[r.integers(0, len(x), count)]
    kinds = []
    for away in (r.normal(size=left.shape), x[r.integers(0, len(x), count)] - x[r.integers(0, len(x), count)]):
        away = away - (away * left).sum(1, keepdims=True) * left
        size = np.linalg.norm(away, axis=1, keepdims=True)
        ok = size[:, 0] > 1e-9
        if ok.any():
            kinds.append((left[ok], threshold * left[ok] + np.sqrt(1 - threshold**2) * (away[ok] / size[ok])))
    cos = np.triu(x @ x.T, 1)
    i, j = np.nonzero((cos >= threshold) & (cos < threshold + (1 - threshold) / 4))
    if len(i):
        some = r.permutation(len(i))[:count]
        kinds.append((x[i[some]], x[j[some]]))
    return kinds


class Tables:
    """Signs of centred, rotated unit vectors: the keys of hash tables and the code that prunes their buckets."""

    def __init__(self, mean: np.ndarray, turn: np.ndarray, width: int, tables: int, near: int):
        self.mean, self.turn, self.width, self.tables, self.near = mean, turn, width, tables, near

    @staticmethod
    def learn(x: np.ndarray, threshold: float, width: int) -> Tables:
        """Tables are added until all but ``MISSED`` of the planted pairs of each kind meet in one.

        Half of the vectors teach the rotations, the pairs are planted on the others. Where ``MOST_TABLES`` do not
        do, keys get narrower; keys without bits are one bucket, in which everything meets.
        """
        x = _unit(x)
        taught, tried = (x[::2], x[1::2]) if len(x) > 1 else (x, x)
        mean = taught.mean(0)
        v = taught - mean
        axes = np.linalg.eigh(v.T @ v)[1][:, ::-1][:, :BITS]
        v = v @ axes
        kinds = planted_pairs(tried, threshold)
        turns: list[np.ndarray] = []
        differ = [np.zeros((len(a), 0), bool) for a, _ in kinds]

        def need(bits: int) -> None:
            while sum(t.shape[1] for t in turns) < bits:
                turns.append(axes @ _rotation(v, seed=5 + len(turns)))
                for k, (a, b) in enumerate(kinds):
                    apart = ((a - mean) @ turns[-1] >= 0) != ((b - mean) @ turns[-1] >= 0)
                    differ[k] = np.concatenate([differ[k], apart], 1)

        need(CODE_BITS)
        near = max((int(d[:, :CODE_BITS].sum(1).max()) for d in differ), default=0) + 1
        while True:
            apart, tables = [np.ones(len(d), bool) for d in differ], 0
            while not tables or (tables < MOST_TABLES and any(o.mean() > MISSED for o in apart)):
                need((tables + 1) * width)
                for o, d in zip(apart, differ, strict=True):
                    o &= d[:, tables * width : (tables + 1) * width].any(1)
                tables += 1
            if not any(o.mean() > MISSED for o in apart):
                break
            width = max(0, width - 2)
        used = np.concatenate(turns, 1)[:, : max(CODE_BITS, tables * width)]
        return Tables(mean, used, width, tables, near)

    def keys(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(codes, keys)``: a code of ``CODE_BITS`` bits per vector, and its key in every table."""
        signs = ((_unit(x) - self.mean) @ self.turn) >= 0
        code = signs[:, :CODE_BITS].astype(np.uint64) << np.arange(CODE_BITS, dtype=np.uint64)
        cut = signs[:, : self.tables * self.width].reshape(len(x), self.tables, self.width)
        return code.sum(1, dtype=np.uint64).view(np.int64), (cut << np.arange(self.width)).sum(2).astype(np.int32)


def _rotation(v: np.ndarray, rounds: int = 20, seed: int = 5) -> np.ndarray:
    """Alternate between signs and the rotation that fits them best, from a random one."""
    r = np.linalg.qr(np.random.default_rng(seed).normal(size=(v.shape[1], v.shape[1])))[0]
    for _ in range(rounds):
        u, _, w = np.linalg.svd(np.where(v @ r >= 0, 1.0, -1.0).T @ v)
        r = (u @ w).T
    return r


def _linked(left: pd.DataFrame, right: pd.DataFrame, table: int, same: bool, threshold: float) -> np.ndarray:
    """Which pairs of two blocks of a bucket are links that this table is the first to find."""
    x, y = (np.array(p["vec"].tolist()) for p in (left, right))
    x, y = _unit(x), _unit(y)
    hit = (x @ y.T) >= threshold - 1e-9
    # The exact value decides near the threshold, pair by pair.
    close = np.argwhere(hit & ((x @ y.T) < threshold + 1e-9))
    raw_x, raw_y = left["vec"].tolist(), right["vec"].tolist()
    for i, j in close:
        a, b = np.asarray(raw_x[i]), np.asarray(raw_y[j])
        hit[i, j] = a @ b / np.sqrt((a @ a) * (b @ b)) >= threshold
    c, d = (np.array(p["keys"].tolist(), np.int32) for p in (left, right))
    for t in range(table if hit.any() else 0):
        hit &= c[:, t, None] != d[None, :, t]
    if same:
        hit &= np.triu(np.ones(hit.shape, bool), 1)
    hit &= left["id"].to_numpy()[:, None] != right["id"].to_numpy()[None]
    return hit


def _summed(left: pd.DataFrame, right: pd.DataFrame, hit: np.ndarray) -> pd.DataFrame:
    """Per vector its new links and the smallest id that it reaches in these blocks: no list of pairs."""
    ids = np.concatenate([left["id"], right["id"]])
    links = np.concatenate([hit @ right["n"].to_numpy(), hit.T @ left["n"].to_numpy()])
    reach, old = ids.copy(), None
    k = len(left)
    rows, cols = hit.any(1), hit.any(0)
    h = hit[rows][:, cols]
    big = np.iinfo(np.int64).max
    a, b = np.flatnonzero(rows), k + np.flatnonzero(cols)
    while len(a) and (old is None or (old != reach).any()):
        old = reach.copy()
        reach[a] = np.minimum(reach[a], np.where(h, reach[b][None], big).min(1))
        reach[b] = np.minimum(reach[b], np.where(h, reach[a][:, None], big).min(0))
        low = pd.Series(reach).groupby(ids).transform("min").to_numpy()  # a block may meet itself
        reach = low
    some = links > 0
    return pd.DataFrame({"id": ids[some], "links": links[some], "root": reach[some]})


def near_vectors(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    threshold: float = 0.95,
    sample: int = SAMPLE,
) -> DataFrame:
    """Links between vectors of a cosine of ``threshold`` or more: ``(key, n_links, component_id, kept)`` per row.

    * *Classes.* Equal vectors are one class with a weight, so thousands of copies are one code and one row.
    * *Tables.* Rotations learnt on at most about ``sample`` vectors, chosen by hash, turn a vector into signs; each run of them is
      the key of a table, and vectors meet where a key is the same. The number of tables is not given but measured: they
      are added until 99.95 % of pairs planted right at the threshold meet (``Tables.learn``), in the sample's own vectors,
      so a strong common direction or few dimensions get more tables or narrower keys. Pairs above the threshold
      meet more often. It stays a measure: a link may be missed, none is invented.
    * *Rerank.* Only rows with a near code in their bucket go on with their vectors; how near is measured on the same pairs.
      In a bucket, block meets block, cosines are computed in double precision on the original vectors, and what leaves the
      task is a number of links and a smallest neighbour for each vector, not the pairs. A pair counts in the first
      table that finds it.

    Vectors of each length are compared among themselves, with rotations and tables of their own. What takes no part is said
    at ``usable``; such rows have no link and their own key as component. Rows that
    repeat a key get one answer. An empty table gives an empty result; other columns do not matter.
    """
    typed = vectors.withColumn(key, F.col(key).cast("long"))
    clean = stage(usable(typed, key, vector), "vectors")
    found = [_near(part, threshold, sample) for part in by_length(clean)]
    none = clean.select("key", F.col("key").alias("component_id"), F.lit(0).cast("long").alias("n_links"))
    return _answer(typed, key, reduce(lambda a, b: a.unionByName(b), found) if found else none)


def _near(clean: DataFrame, threshold: float, sample: int) -> DataFrame:
    """``(key, component_id, n_links)`` of vectors of one length."""
    classes = stage(
        clean.groupBy("vec").agg(F.min("key").alias("id"), F.count(F.lit(1)).alias("n")).select("id", "n", "vec"), "classes"
    )
    size = classes.count()
    part = min(1.0, sample / size)
    drawn = classes.where(F.pmod(F.xxhash64("id", F.lit("itq")), F.lit(1 << 20)) <= part * (1 << 20))
    # A bounded sample, in an order of its own; the smallest id stands in for an empty one.
    taught = [r[1] for r in sorted(drawn.select("id", "vec").collect())] or [classes.orderBy("id").first()["vec"]]
    width = min(MOST_WIDTH, max(0, round(np.log2(size / BUCKET_ROWS))))
    learnt = Tables.learn(np.array(taught), threshold, width)
    shared = clean.sparkSession.sparkContext.broadcast(learnt)

    @F.pandas_udf("code long, keys array<int>")
    def signs(vec: pd.Series) -> pd.DataFrame:
        codes, keys = shared.value.keys(np.array(vec.tolist())) if len(vec) else ([], [])
        return pd.DataFrame({"code": pd.Series(codes, dtype="int64"), "keys": pd.Series(list(keys), dtype=object)})

    coded = stage(classes.withColumn("_s", signs("vec")).select("id", "n", "vec", "_s.code", "_s.keys"), "codes")
    based = coded.select("id", "code", F.posexplode("keys").alias("t", "bucket"))

    other = based.select(*[F.col(c).alias(f"_{c}") for c in ("id", "code", "t", "bucket")])
    bits = F.col("code").bitwiseXOR(F.col("_code"))
    fresh = (F.col("t") == F.col("_t")) & (F.col("bucket") == F.col("_bucket")) & (F.col("id") != F.col("_id"))
    fresh &= F.bit_count(bits) <= learnt.near
    # What met in one of the tables that the code spans needs no vectors in a later one.
    for t in range(min(learnt.tables - 1, CODE_BITS // learnt.width) if learnt.width else 0):
        run = F.lit((1 << learnt.width) - 1).cast("long")
        fresh &= (F.col("t") <= t) | (F.shiftrightunsigned(bits, t * learnt.width).bitwiseAND(run) != 0)
    alive = stage(based.join(other, fresh, "left_semi").select("id", "t", "bucket"), "alive")
    dealt = block_pairs(alive, ["t", "bucket"], "id").join(coded.select("id", "n", "vec", "keys"), "id")

    def meet(group: pd.DataFrame) -> pd.DataFrame:
        a, b, t = (int(group[c].iloc[0]) for c in ("_a", "_b", "t"))
        left, right = (group[group["_mine"] == x].sort_values("id") for x in (a, b))
        return _summed(left, right, _linked(left, right, t, a == b, threshold))

    met = dealt.groupBy("t", "bucket", "_a", "_b").applyInPandas(meet, "id long, links long, root long")
    found = stage(met, "links")
    degrees = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")).distinct())
    by_class = (
        classes.join(degrees, "id", "left")
        .join(roots, "id", "left")
        .select(
            "vec",
            F.coalesce("component", "id").alias("component_id"),
            (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        )
    )
    return clean.join(by_class, "vec").select("key", "component_id", "n_links")


def _answer(rows: DataFrame, key: str, answers: DataFrame) -> DataFrame:
    met = rows.select(F.col(key).alias("_own")).join(answers, F.col("_own") == F.col("key"), "left")
    out = met.select(
        F.col("_own").alias(key),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "_own").alias("component_id"),
    )
    return out.withColumn("kept", F.col(key).eqNullSafe(F.col("component_id")))
