"""Nearest neighbours by hierarchical navigable small-world graphs, one per shard (operator 5)."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from charloom.llm.vectors import by_length, usable
from charloom.session import stage

#: Distinct vectors of a graph, links of a node (twice that on the ground layer), and the width of a search.
SHARD_ROWS, LINKS, BEAM = 8192, 16, 96
#: Queries that meet a graph at a time.
QUERY_BLOCK = 1024
CHUNK = 256


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    d = (x * x).sum(1)[:, None] + (y * y).sum(1)[None] - 2 * (x @ y.T)
    return np.maximum(d, 0, out=d)


def _select(x: np.ndarray, cand: np.ndarray, dist: np.ndarray, links: int) -> tuple[np.ndarray, np.ndarray]:
    """Diverse neighbours: from near to far, one is taken if it is nearer to the node than to those taken before.

    Free places are filled with the nearest of the others. ``cand`` has -1 where there is none, sorted last.
    """
    out, out_d = np.full((len(cand), links), -1, np.int32), np.full((len(cand), links), np.inf, np.float32)
    for a in range(0, len(cand), CHUNK):
        c, d = cand[a : a + CHUNK], dist[a : a + CHUNK]
        v = x[c]
        n = (v * v).sum(2)
        g = n[:, :, None] + n[:, None, :] - 2 * (v @ v.transpose(0, 2, 1))
        taken = np.zeros(c.shape, bool)
        for j in range(c.shape[1]):
            near = np.where(taken, g[:, j, :], np.inf).min(1)
            taken[:, j] = (c[:, j] >= 0) & (d[:, j] <= near) & (taken.sum(1) < links)
        rank = np.where(taken, 0, np.where(c >= 0, 1, 2)) * np.float32(1e30) + np.where(np.isfinite(d), d, 1e29)
        order = np.argsort(rank, 1, kind="stable")[:, :links]
        k = order.shape[1]
        out[a : a + CHUNK, :k] = np.take_along_axis(c, order, 1)
        out_d[a : a + CHUNK, :k] = np.take_along_axis(d, order, 1)
    return out, out_d


def build_layer(x: np.ndarray, links: int) -> np.ndarray:
    """Neighbour array ``(n, links)`` of one layer, -1 where there is none.

    Nodes come in by batches that double, each linking to diverse neighbours among the nodes before it and its
    own batch; these link back and drop what is then too many. A shard is bounded, so the candidates of an
    insertion are found by distances in blocks and not by a search that could miss them.
    """
    n, width = len(x), 3 * links
    nbr, nbr_d = np.full((n, links), -1, np.int32), np.full((n, links), np.inf, np.float32)
    start, stop = 0, min(n, 64)
    while start < n:
        k = min(width, stop - 1)
        for a in range(start, stop, CHUNK):
            b = min(stop, a + CHUNK)
            if k <= 0:
                break
            d = _distances(x[a:b], x[:stop])
            d[np.arange(b - a), np.arange(a, b)] = np.inf
            near = np.argpartition(d, k - 1, 1)[:, :k]
            dn = np.take_along_axis(d, near, 1)
            order = np.argsort(dn, 1, kind="stable")
            near, dn = np.take_along_axis(near, order, 1), np.take_along_axis(dn, order, 1)
            nbr[a:b], nbr_d[a:b] = _select(x, near, dn, links)
        # Links back: each target gets the nodes that chose it, nearest first, next to what it has.
        src = np.repeat(np.arange(start, stop), links)
        dst, dd = nbr[start:stop].ravel(), nbr_d[start:stop].ravel()
        ok = dst >= 0
        src, dst, dd = src[ok], dst[ok], dd[ok]
        order = np.lexsort((dd, dst))
        src, dst, dd = src[order], dst[order], dd[order]
        target, first = np.unique(dst, return_index=True)
        rank = np.arange(len(dst)) - np.repeat(first, np.diff(np.append(first, len(dst))))
        keep = rank < width
        cand = np.full((len(target), links + width), -1, np.int64)
        dist = np.full(cand.shape, np.inf, np.float32)
        cand[:, :links], dist[:, :links] = nbr[target], nbr_d[target]
        row = np.searchsorted(target, dst[keep])
        cand[row, links + rank[keep]], dist[row, links + rank[keep]] = src[keep], dd[keep]
        twice = (cand[:, links:, None] == cand[:, None, :links]).any(2)
        cand[:, links:][twice], dist[:, links:][twice] = -1, np.inf
        order = np.argsort(dist, 1, kind="stable")
        cand, dist = np.take_along_axis(cand, order, 1), np.take_along_axis(dist, order, 1)
        nbr[target], nbr_d[target] = _select(x, cand, dist, links)
        start, stop = stop, min(n, 2 * stop)
    return nbr


class Graph:
    """Layers of one shard: which nodes are in each, their neighbour arrays, the entry."""

    def __init__(self, x: np.ndarray, layers: list[tuple[np.ndarray, np.ndarray]]):
        self.x, self.layers = x, layers  # ground layer first; (nodes, neighbours as node numbers)

    @staticmethod
    def build(x: np.ndarray, links: int = LINKS, seed: int = 11) -> Graph:
        """Levels are drawn from a geometric law; each layer is built on its own nodes in their order."""
        x = x.astype(np.float32)
        draw = np.random.default_rng(seed).random(len(x))
        level = np.floor(-np.log(1 - draw) / np.log(links)).astype(int)
        level[0] = max(level.max(), level[0])
        layers = []
        for lv in range(level.max() + 1):
            nodes = np.flatnonzero(level >= lv)
            nbr = build_layer(x[nodes], links * 2 if lv == 0 else links)
            layers.append((nodes, np.where(nbr >= 0, nodes[nbr], -1).astype(np.int32)))
        return Graph(x, layers)

    def search(self, q: np.ndarray, k: int, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
        """``(nodes, squared distances)`` of about the ``k`` nearest, -1 where there are fewer; all queries in step."""
        x, m = self.x, len(q)
        at = np.zeros(m, np.int64)
        best = ((q - x[0]) ** 2).sum(1)
        for nodes, nbr in self.layers[:0:-1]:
            moving = np.arange(m)
            while len(moving):
                around = nbr[np.searchsorted(nodes, at[moving])]
                d = ((x[around] - q[moving, None]) ** 2).sum(2)
                d[around < 0] = np.inf
                j = d.argmin(1)
                low = d[np.arange(len(j)), j]
                better = low < best[moving]
                moving, j, low, around = moving[better], j[better], low[better], around[better]
                at[moving], best[moving] = around[np.arange(len(j)), j], low
        nbr = self.layers[0][1]
        beam = max(beam, k)
        found = np.full((m, beam), -1, np.int64)
        dist = np.full((m, beam), np.inf, np.float32)
        todo = np.zeros((m, beam), bool)
        found[:, 0], dist[:, 0], todo[:, 0] = at, best, True
        seen = np.zeros((m, len(x)), bool)
        seen[np.arange(m), at] = True
        active = np.arange(m)
        while len(active):
            d = np.where(todo[active], dist[active], np.inf)
            j = d.argmin(1)
            open_ = np.isfinite(d[np.arange(len(j)), j])
            active, j = active[open_], j[open_]
            if not len(active):
                break
            todo[active, j] = False
            around = nbr[found[active, j]]
            new = (around >= 0) & ~seen[active[:, None], around]
            r, c = np.nonzero(new)
            seen[active[r], around[r, c]] = True
            nd = np.full(around.shape, np.inf, np.float32)
            nd[r, c] = ((x[around[r, c]] - q[active[r]]) ** 2).sum(1)
            all_d = np.concatenate([dist[active], nd], 1)
            order = np.argpartition(all_d, beam - 1, 1)[:, :beam]
            dist[active] = np.take_along_axis(all_d, order, 1)
            found[active] = np.take_along_axis(np.concatenate([found[active], around], 1), order, 1)
            todo[active] = np.take_along_axis(np.concatenate([todo[active], new], 1), order, 1)
        order = np.argsort(dist, 1, kind="stable")[:, :k]
        dist = np.take_along_axis(dist, order, 1)
        return np.where(np.isfinite(dist), np.take_along_axis(found, order, 1), -1), dist


# --- on Spark ---------------------------------------------------------------------------------------


def build_index(classes: DataFrame, shards: int, links: int = LINKS) -> DataFrame:
    """Stored graphs: a row per distinct vector with its neighbours of all its layers as one flat array.

    ``(shard, node, keys, vec, links)``: ``links`` has the number of layers and then ``2 * links`` neighbours on the
    ground layer and ``links`` on each layer above.
    """

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("first").reset_index(drop=True)  # the same graph whatever the layout
        graph = Graph.build(np.array(part["vec"].tolist()), links)
        flat: list[list[np.ndarray]] = [[] for _ in range(len(part))]
        for nodes, nbr in graph.layers:
            for node, row in zip(nodes, nbr, strict=True):
                flat[node].append(row)
        part["node"] = np.arange(len(part), dtype=np.int32)
        part["links"] = [np.concatenate([[len(f)], *f]).astype(np.int32) for f in flat]
        return part[["shard", "node", "keys", "vec", "links"]]

    shard = F.pmod(F.xxhash64("first", F.lit("shard")), F.lit(shards)).cast("int")
    kinds = "shard int, node int, keys array<long>, vec array<double>, links array<int>"
    return stage(classes.withColumn("shard", shard).groupBy("shard").applyInPandas(run, kinds), "hnsw")


def _graph(part: pd.DataFrame, links: int) -> Graph:
    flat = part["links"].tolist()
    depth = np.array([f[0] for f in flat])
    layers = []
    for lv in range(depth.max()):
        nodes = np.flatnonzero(depth > lv)
        a = 1 if lv == 0 else 1 + 2 * links + (lv - 1) * links
        layers.append((nodes, np.stack([flat[i][a : a + (2 * links if lv == 0 else links)] for i in nodes])))
    return Graph(np.array(part["vec"].tolist(), dtype=np.float32), layers)


def nearest(
    vectors: DataFrame,
    *,
    key: str = "vec_id",
    vector: str = "embedding",
    every: int = 100,
    k: int = 10,
    shard_rows: int = SHARD_ROWS,
    links: int = LINKS,
    beam: int = BEAM,
) -> DataFrame:
    """The ``k`` nearest rows of each query, a row whose key is divisible by ``every``, against all other rows.

    Returns ``(query_id, rank, key, score)`` with the Euclidean distance in double precision on the original vectors,
    nearest first, ties to the smaller key; fewer rows where there are fewer candidates.

    Equal vectors are one node with their ``k + 1`` smallest keys, the only ones that can be an answer; so thousands
    of copies neither crowd a graph nor a task. Distinct vectors are hashed into shards of about ``shard_rows``,
    whatever their number, each with its graph stored as flat neighbour arrays. Queries go to every shard in blocks
    of about ``QUERY_BLOCK``; each pair of a shard and a block is a task's group, and the best of all shards are merged.

    Vectors of each length have graphs of their own, and a query's candidates are those of its length. What takes no part
    is said at ``usable``; such a query gives no rows. Rows that repeat a key count once. An
    empty table gives an empty result; other columns do not matter.
    """
    clean = stage(usable(vectors.withColumn(key, F.col(key).cast("long")), key, vector), "vectors")
    found = [_nearest(part, every, k, shard_rows, links, beam) for part in by_length(clean)]
    none = clean.select(F.col("key").alias("query_id"), F.lit(0).alias("rank"), "key", F.lit(0.0).alias("score")).limit(0)
    return (reduce(lambda a, b: a.unionByName(b), found) if found else none).withColumnRenamed("key", key)


def _nearest(clean: DataFrame, every: int, k: int, shard_rows: int, links: int, beam: int) -> DataFrame:
    """``(query_id, rank, key, score)`` among vectors of one length."""
    of_copies = Window.partitionBy("vec").orderBy("key")
    few = clean.withColumn("_n", F.row_number().over(of_copies)).where(F.col("_n") <= k + 1)
    classes = few.groupBy("vec").agg(F.array_sort(F.collect_list("key")).alias("keys"))
    classes = stage(classes.withColumn("first", F.col("keys")[0]), "classes")
    shards = max(1, -(-classes.count() // shard_rows))
    index = build_index(classes, shards, links)

    asked = clean.where(F.col("key") % every == 0)
    blocks = max(1, -(-asked.count() // QUERY_BLOCK))
    block = F.pmod(F.xxhash64("key", F.lit("query")), F.lit(blocks)).cast("int")
    numbers = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    queries = asked.select(
        "key", "vec", block.alias("block"), F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard")
    )

    def run(part: pd.DataFrame, ask: pd.DataFrame) -> pd.DataFrame:
        if not len(part) or not len(ask):
            return pd.DataFrame({"query_id": [], "key": [], "score": []}).astype({"query_id": "int64", "key": "int64"})
        part = part.sort_values("node").reset_index(drop=True)
        x, q = np.array(part["vec"].tolist()), np.array(ask["vec"].tolist())
        graph = _graph(part, links)
        out = []
        keys = part["keys"].tolist()
        for a in range(0, len(q), QUERY_BLOCK):
            nodes, _ = graph.search(q[a : a + QUERY_BLOCK].astype(np.float32), k + 1, beam)
            for own, v, near in zip(ask["key"].iloc[a : a + QUERY_BLOCK], q[a : a + QUERY_BLOCK], nodes, strict=True):
                near = near[near >= 0]
                d = np.sqrt(((x[near] - v) ** 2).sum(1))
                pairs = sorted((s, c) for s, i in zip(d, near, strict=True) for c in keys[i] if c != own)
                out += [(own, c, s) for s, c in pairs[:k]]
        return pd.DataFrame(out, columns=["query_id", "key", "score"])

    met = index.withColumn("block", numbers).groupBy("shard", "block").cogroup(queries.groupBy("shard", "block"))
    found = met.applyInPandas(run, "query_id long, key long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "key"))
    return (
        found.withColumn("rank", rank)
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "key", "score")
    )
