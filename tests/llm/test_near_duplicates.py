"""Near-duplicates of texts and vectors, and nearest neighbours, against brute force."""

from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from charloom.llm import common, hnsw, itq, minhash


def smallest_reachable(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_cycles(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(200, 201), (201, 202), (202, 200), (7, 7)]
    got = dict(common.components(spark.createDataFrame(edges, "a long, b long")).collect())
    nodes = {x for e in edges for x in e}
    assert got == smallest_reachable(nodes, edges)
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_take_no_round_that_changes_nothing(spark, monkeypatch):
    written = []
    monkeypatch.setattr(common, "stage", lambda df, name, real=common.stage: written.append(name) or real(df, name))
    stars = [(i % 4, i) for i in range(10, 60)] + [(5, 6)]
    assert dict(common.components(spark.createDataFrame(stars, "a long, b long")).collect()) == smallest_reachable(
        {x for e in stars for x in e}, stars
    )
    assert len(written) == 1  # the edges as given
    written.clear()
    common.components(spark.createDataFrame([(1, 2), (2, 3), (1, 3)], "a long, b long"))
    assert len(written) == 2  # and as one round leaves them


def test_block_pairs_let_every_two_rows_meet_once(spark):
    df = spark.range(50).select("id", (F.col("id") % 2).alias("g"))
    dealt = common.block_pairs(df, ["g"], "id", block_rows=6).collect()
    met = {}
    by = {}
    for r in dealt:
        by.setdefault((r["g"], r["_a"], r["_b"]), []).append((r["_mine"], r["id"]))
    for (g, a, b), rows in by.items():
        left = [i for m, i in rows if m == a]
        right = [i for m, i in rows if m == b]
        for i in left:
            for j in right:
                if (a != b) or i < j:
                    met[(min(i, j), max(i, j))] = met.get((min(i, j), max(i, j)), 0) + 1
    want = {(i, j) for i in range(50) for j in range(i + 1, 50) if i % 2 == j % 2}
    assert set(met) == want and set(met.values()) == {1}


# --- texts ------------------------------------------------------------------------------------------


def shingles(text, words):
    w = (text or "").encode().lower().split()
    if not w:
        return set()
    return {tuple(w[i : i + words]) for i in range(len(w) - words + 1)} or {tuple(w)}


def text_groups(data, words):
    sets = [shingles(t, words) for _, t in data]
    links = [
        (a, b)
        for a in range(len(data))
        for b in range(a)
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])
    ]
    part = smallest_reachable(range(len(data)), links)
    low = {}
    for i, (k, _) in enumerate(data):
        if k is not None:
            low[part[i]] = min(low.get(part[i], k), k)
    return [(k, len(sets[i]), low.get(part[i]) if sets[i] else k) for i, (k, _) in enumerate(data)]


@pytest.mark.parametrize(("words", "block"), [(2, 2048), (5, 2048), (2, 3)])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, words, block):
    # A tiny block deals every bucket into several.
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", block * minhash.LEAST_SHINGLES)
    r = random.Random(words)
    vocabulary = [f"w{i}" for i in range(300)]
    data = []
    for _ in range(12):
        base = [r.choice(vocabulary) for _ in range(r.randint(30, 150))]
        data.append(" ".join(base))
        for _ in range(r.randint(0, 9)):
            edited = [r.choice(vocabulary) if r.random() < r.choice([0.02, 0.04, 0.08]) else w for w in base]
            data.append(" ".join(edited))
    data += [data[0].upper(), data[1] + "  ", data[2].replace(" ", "\n"), "one", "ONE ", "two words", "É x", "é x"]
    keyed = [(i * 3 % 101, t) for i, t in enumerate(data)]
    keyed += [(500, None), (501, ""), (502, " \t"), (None, "one"), (keyed[3][0], "a text under a known id " * 3)]
    df = spark.createDataFrame(keyed, "doc_id long, text string").withColumn("node", F.lit(1)).withColumn("set", F.lit(2))
    got = minhash.near_duplicates(df.repartition(6), words=words).collect()
    assert sorted(map(str, [(g["doc_id"], g["n_shingles"], g["component_id"]) for g in got])) == sorted(
        map(str, text_groups(keyed, words))
    )
    assert all(g["kept"] == (g["doc_id"] == g["component_id"]) for g in got)


def test_open_buckets_join_components_and_not_their_texts_again(spark, monkeypatch):
    calls = []

    def recorded(edges, real=common.components):
        found = real(edges)
        calls.append(([tuple(map(bytes, e)) for e in edges.collect()], {bytes(i): bytes(c) for i, c in found.collect()}))
        return found

    monkeypatch.setattr(minhash, "components", recorded)
    r = random.Random(0)
    data = []
    for _ in range(6):  # edits of a text, some of them too far from the centre of their bucket
        base = [f"w{r.randrange(4000)}" for _ in range(60)]
        for _ in range(25):
            data.append(" ".join(f"w{r.randrange(4000)}" if r.random() < 0.06 else w for w in base))
    df = spark.createDataFrame(list(enumerate(data)), "doc_id long, text string")
    got = minhash.near_duplicates(df, words=1).collect()
    want = text_groups(list(enumerate(data)), 1)
    assert sorted((g["doc_id"], g["n_shingles"], g["component_id"]) for g in got) == sorted(want)
    (links, parts), (more, _) = calls
    assert more and len(more) < len(links)
    assert all(parts.get(x, x) == x for e in more for x in e)


def test_near_duplicates_of_long_and_of_no_texts(spark):
    long = " ".join(f"t{i}" for i in range(60_000))
    df = spark.createDataFrame([(2, long), (1, long + " end"), (3, "short")], "doc_id long, text string")
    got = {g["doc_id"]: g["component_id"] for g in minhash.near_duplicates(df).collect()}
    assert got == {1: 1, 2: 1, 3: 3}
    assert minhash.near_duplicates(df.limit(0)).count() == 0


def test_pruning_keeps_pairs_at_the_threshold():
    limits = minhash.fewest_matches(0.8)
    r = np.random.default_rng(0)
    same = np.zeros((20_000, minhash.HASHES), np.uint16)
    at = np.where(r.random(same.shape) < 0.8, 0, 1).astype(np.uint16)
    assert len(minhash.similar(same, at, limits)[0]) > 0.98 * len(at)
    far = np.where(r.random(same.shape) < 0.5, 0, 1).astype(np.uint16)
    assert len(minhash.similar(same, far, limits)[0]) < 0.001 * len(at)


def test_limits_take_little_memory():
    tracemalloc.start()
    limits = minhash.fewest_matches(0.8)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 5e6
    assert limits == [(36, 21), (72, 47), (108, 74), (144, 100), (180, 127), (216, 155), (252, 182)]


# --- vectors ----------------------------------------------------------------------------------------


def vectors(n, dim, seed):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, dim)).astype(np.float32)
    for i in range(n // 3, n // 2):  # near copies at all angles, exact copies
        x[i] = x[i % 20] + r.normal(size=dim) * r.choice([0.05, 0.2, 0.3, 0.33, 0.4])
    x[n // 2 : n // 2 + 40] = x[3]
    return x


BAD = [(9001, None), (9002, [0.0] * 8), (9003, [1.0, None] + [0.0] * 6), (9004, [float("nan")] * 8), (9005, [float("inf")] * 8)]
BAD += [(9006, []), (9007, [1.0, 2.0]), (9100, [float("-inf")] * 8), (None, [1.0] * 8)]


@pytest.mark.parametrize(("dim", "bad"), [(8, True), (64, False), (90, False)])
def test_links_equal_brute_force(spark, dim, bad):
    x = vectors(400, dim, dim)
    data = [(i, v.tolist()) for i, v in enumerate(x)]
    if bad:
        data += BAD
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("id", F.lit(1)).withColumn("code", F.lit("x"))
    got = {g["vec_id"]: g for g in itq.near_vectors(df.repartition(5)).collect()}
    y = x.astype(np.float64)
    cos = (y @ y.T) / np.linalg.norm(y, axis=1)[:, None] / np.linalg.norm(y, axis=1)[None]
    link = (cos >= 0.95) & ~np.eye(len(y), dtype=bool)
    found = sum(g["n_links"] for g in got.values())
    assert found >= 0.97 * link.sum()
    assert all(got[i]["n_links"] <= link[i].sum() for i in range(len(y)))
    if found == link.sum():
        want = smallest_reachable(range(len(y)), np.argwhere(link).tolist())
        assert {i: got[i]["component_id"] for i in range(len(y))} == want
    if bad:
        for k, _ in BAD:
            assert (got[k]["n_links"], got[k]["component_id"], got[k]["kept"]) == (0, k, True)
    assert itq.near_vectors(df.limit(0)).count() == 0


@pytest.mark.parametrize(("dim", "common"), [(64, 0.0), (64, 0.69), (32, 0.0), (32, 0.5)])
def test_links_at_the_threshold_are_met_whatever_the_vectors(spark, dim, common):
    # Pairs of a cosine of 0.95 to 0.96 among vectors with a common direction: brute force over all.
    r = np.random.default_rng(dim)
    unit = lambda v: v / np.linalg.norm(v, axis=-1, keepdims=True)
    x = unit(np.sqrt(1 - common) * unit(r.normal(size=(3000, dim))) + np.sqrt(common) * unit(r.normal(size=dim)))
    away = r.normal(size=(1500, dim))
    away = unit(away - (away * x[:1500]).sum(1, keepdims=True) * x[:1500])
    c = r.uniform(0.9501, 0.96, size=(1500, 1))
    x = np.concatenate([x, c * x[:1500] + np.sqrt(1 - c * c) * away])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    got = {g["vec_id"]: g["n_links"] for g in itq.near_vectors(df).collect()}
    link = (unit(x) @ unit(x).T >= 0.95) & ~np.eye(len(x), dtype=bool)
    assert link.sum() >= 3000 and all(got[i] <= n for i, n in enumerate(link.sum(1)))
    assert sum(got.values()) >= 0.995 * link.sum()


@pytest.mark.parametrize("shard_rows", [100, 10_000])
def test_neighbours_against_brute_force(spark, monkeypatch, shard_rows):
    monkeypatch.setattr(hnsw, "QUERY_BLOCK", 3)
    x = vectors(900, 16, 4)
    x[450:470] = np.round(x[450:470])
    data = [(i, v.tolist()) for i, v in enumerate(x)] + [(k, v) for k, v in BAD if k]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("shard", F.lit(1))
    got = {}
    for g in hnsw.nearest(df.repartition(4), shard_rows=shard_rows).collect():
        got.setdefault(g["query_id"], []).append((g["rank"], g["vec_id"], g["score"]))
    assert set(got) == set(range(0, 900, 100))
    y, hits = x.astype(np.float64), 0
    for q, found in got.items():
        found.sort()
        d = np.sqrt(((y - y[q]) ** 2).sum(1))
        want = [i for i in np.lexsort((np.arange(len(y)), d)) if i != q][:10]
        assert [r for r, _, _ in found] == list(range(1, 11))
        assert all(s == pytest.approx(d[v], rel=1e-14) for _, v, s in found)
        assert found == sorted(found, key=lambda f: (f[2], f[1])) and q not in [v for _, v, _ in found]
        hits += len({v for _, v, _ in found} & set(want))
    assert hits >= 0.95 * 10 * len(got)


def test_few_candidates_copies_and_repeated_keys(spark):
    data = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 2.0]), (100, [1.0, 0.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = sorted((g["query_id"], g["rank"], g["vec_id"]) for g in hnsw.nearest(df).collect())
    assert [v for q, _, v in got if q == 0] == [1, 2, 100, 3] and [v for q, _, v in got if q == 100] == [0, 1, 2, 3]
    assert hnsw.nearest(df.limit(0)).count() == 0
    assert hnsw.nearest(df.where("vec_id = 0")).count() == 0
    links = {g["vec_id"]: (g["n_links"], g["component_id"]) for g in itq.near_vectors(df).collect()}
    assert links == {0: (3, 0), 1: (3, 0), 2: (3, 0), 100: (3, 0), 3: (0, 3)}


def test_graph_search_recall():
    r = np.random.default_rng(2)
    centres = r.normal(size=(30, 32)) * 3
    x = (centres[r.integers(0, 30, 3000)] + r.normal(size=(3000, 32))).astype(np.float32)
    graph = hnsw.Graph.build(x)
    assert len(graph.layers) > 1 and all((nbr < len(x)).all() for _, nbr in graph.layers)
    q = x[::50] + r.normal(size=(60, 32)).astype(np.float32) * 0.1
    found, _ = graph.search(q, 10)
    d = ((q[:, None] - x[None]) ** 2).sum(2)
    want = np.argsort(d, 1)[:, :10]
    assert np.mean([len(set(a) & set(b)) / 10 for a, b in zip(found, want, strict=True)]) > 0.95


def test_vectors_of_every_length_take_part(spark):
    r = np.random.default_rng(3)
    data = [(i, r.normal(size=3).tolist()) for i in range(300, 305)] + [(200, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [2.0, 4.0]), (100, [-1.0, 2.0])]
    data += [(400, [5.0]), (500, [float("nan"), 1.0])]
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>")
    got = {g["vec_id"]: (g["n_links"], g["component_id"], g["kept"]) for g in itq.near_vectors(df.repartition(3)).collect()}
    assert got[200] == (2, 7, False) and got[7] == (2, 7, True) and got[8] == (2, 7, False)
    assert got[100] == (0, 100, True) and got[400] == (0, 400, True) and got[500] == (0, 500, True) and len(got) == len(data)
    near = sorted(map(tuple, hnsw.nearest(df.repartition(3)).select("query_id", "rank", "vec_id", "score").collect()))
    rows = {k: np.array(v) for k, v in data if k != 500}
    want = []
    for q in (100, 200, 300, 400):
        others = sorted((float(np.sqrt(((rows[q] - v) ** 2).sum())), k) for k, v in rows.items() if k != q and len(v) == len(rows[q]))
        want += [(q, i + 1, k, s) for i, (s, k) in enumerate(others[:10])]
    assert [x[:3] for x in near] == [x[:3] for x in want]
    assert [x[3] for x in near] == pytest.approx([x[3] for x in want])
