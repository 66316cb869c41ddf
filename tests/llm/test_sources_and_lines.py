"""Mixing and line dedup: brute force, edge cases, and the registered SQL on a given table."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from charloom.llm import line_dedup, mixing, queries, sql

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, source string, text string"


def rows(df, *names):
    return [tuple(r[n] for n in names) for r in df.collect()]


@pytest.mark.parametrize("name", sorted(sql.all_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(sql.all_sql()[name])
    got = queries.all_queries()[name](spark, SF)
    order = sorted(got.columns)
    assert order == sorted(want.columns)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(rows(got, *order), key=key) == sorted(want.select(", ".join(order)).fetchall(), key=key)


# --- mixing -----------------------------------------------------------------------------------------


def test_targets_stop_at_their_limit_and_share_the_excess(spark):
    sizes = spark.createDataFrame([("a", 10), ("b", 1000), ("c", 1000), (None, 30)], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(sizes, 2040, [5.0, 2.0, 1.0], 3).collect()}
    # Weights 5, 2, 1, 5 in code point order, NULL last: a and NULL stop at 30 and 90.
    assert got["a"] == 30 and got[None] == 90
    assert got["b"] == pytest.approx((2040 - 120) * 2 / 3) and got["c"] == pytest.approx((2040 - 120) / 3)


def test_mix_comes_near_targets_and_repeats(spark):
    r = random.Random(3)
    data = [(i, r.choice(["s1", "s2", "s3", None]), " ".join(["w"] * r.randint(0, 40))) for i in range(800)]
    docs = spark.createDataFrame(data, DOCS)
    first = mixing.mix(docs)
    by = {}
    for s, size, total, target, taken in rows(first, "source", "_size", "_source_size", "_target", "_taken"):
        assert taken in (0, size, 2 * size, 3 * size)
        assert min(taken, 3 * size) >= int(target // total) * size
        by.setdefault((s, total, target), []).append(taken)
    for (_, total, target), taken in by.items():
        assert abs(sum(taken) - target) <= 40 and target <= 3 * total
    assert sorted(rows(first, "doc_id", "_taken")) == sorted(rows(mixing.mix(docs.repartition(7)), "doc_id", "_taken"))


def test_mix_edge_cases(spark):
    data = [(None, "a", "x y"), (1, None, None), (1, "a", ""), (2, "b", "x " * 5000), (2, "b", "x " * 5000), (3, "b", "y")]
    docs = spark.createDataFrame(data, DOCS).withColumn("_draw", F.lit(1)).withColumn("_Size", F.lit("old"))
    got = mixing.mix(docs)
    assert got.count() == 6 and "_draw" in got.columns and got.columns.count("_size") == 1 and "_Size" not in got.columns
    assert {r["_taken"] for r in got.where("text is null or text = ''").collect()} == {0}
    twice = [r["_taken"] for r in got.where("doc_id = 2").collect()]
    assert twice[0] == twice[1]  # rows that repeat an id are drawn together
    assert mixing.mix(docs.limit(0)).count() == 0


# --- line dedup -------------------------------------------------------------------------------------


def brute(docs, least):
    """Every run of lines that reaches ``least`` words and came before, by comparing all windows."""
    lines = {k: [x.strip(" \t\n\x0b\x0c\r") for x in (t or "").split("\n")] for k, t in docs}
    full = {k: [i for i, x in enumerate(v) if x] for k, v in lines.items()}
    seen, gone = {}, set()
    for k in sorted(docs_keys := [d[0] for d in docs]):
        at = full[k]
        for s in range(len(at)):
            for e in range(s, len(at)):
                run = tuple(lines[k][i] for i in at[s : e + 1])
                if sum(len(x.split()) for x in run) < least:
                    continue
                first = seen.setdefault(run, (k, s, e))
                if first != (k, s, e):
                    low = first[2] + 1 if first[0] == k else s
                    gone |= {(k, at[i]) for i in range(max(s, low), e + 1)}
    assert len(docs_keys) == len(set(docs_keys))
    return {k: "\n".join(x for i, x in enumerate((t or "").split("\n")) if (k, i) not in gone) for k, t in docs}


@pytest.mark.parametrize("seed", range(3))
def test_line_dedup_equals_brute_force(spark, seed):
    r = random.Random(seed)
    pool = [" ".join(f"w{r.randint(0, 9)}" for _ in range(r.randint(1, 9))) for _ in range(12)]
    passages = [[r.choice(pool) for _ in range(r.randint(2, 6))] for _ in range(4)]
    docs = []
    for i in range(40):
        out = []
        for _ in range(r.randint(0, 5)):
            out += r.choice(passages) if r.random() < 0.5 else [r.choice(pool) + f" {i} {r.random()}", ""]
        docs.append((i, "\n".join(("  " if r.random() < 0.2 else "") + x for x in out)))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    got = dict(rows(line_dedup.line_dedup(df, min_words=10), "doc_id", "text"))
    assert got == brute(docs, 10)


def test_line_dedup_passages_and_edges(spark):
    passage = " ".join(f"p{i}" for i in range(51))
    short = "only a few words"
    data = [
        (1, f"one\n{passage}\n{short}"),
        (2, f"two\n{short}\n \t{passage} \nend"),
        (3, passage),
        (4, None),
        (5, ""),
        (6, f"{short}\n\n{short}"),
        (7, "x " * 200_000),
        (None, "first of all " + passage),
        (2, "another text under the same id"),
    ]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("_gone", F.lit(9)).withColumn("_LINES", F.lit(8))
    out = line_dedup.line_dedup(docs)
    got = {(r["doc_id"], r["_removed"]): r["text"] for r in out.collect()}
    assert got[(1, 0)] == data[0][1] and got[(2, 1)] == f"two\n{short}\nend" and got[(3, 1)] == ""
    assert got[(4, 0)] is None and got[(5, 0)] == "" and got[(6, 0)] == data[5][1]
    assert got[(7, 0)] == data[6][1] and got[(None, 0)] == data[7][1]
    assert set(out.columns) == {"doc_id", "text", "_gone", "_lines", "_removed"}
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0


def test_line_dedup_keeps_the_first_place_when_a_run_overlaps_itself(spark):
    line = " ".join(f"a{i}" for i in range(20))
    docs = spark.createDataFrame([(1, "\n".join([line] * 6))], "doc_id long, text string")
    assert line_dedup.line_dedup(docs).first()["text"] == "\n".join([line] * 3)


def test_winnowing_selects_the_least_line_of_every_window(spark):
    """Every smallest window is at its least line, once, and most lines are selected by none."""
    r = random.Random(11)
    counts = [r.randint(1, 12) for _ in range(300)]
    hashes = [r.randint(-9, 9) if r.random() < 0.3 else r.getrandbits(60) for _ in counts]
    cut = spark.createDataFrame([(1, 2, counts, hashes), (3, 4, [3], [5])], "_key int, _text long, _words array<int>, _hashes array<long>")
    got = line_dedup._winnow(cut, 50).collect()
    assert {x["_key"] for x in got} == {1}
    want = {}
    for i in range(300):
        for step, at in ((1, range(i, 300)), (-1, range(i, -1, -1))):
            total = 0
            for j in at:
                total += counts[j]
                if total >= 50:
                    s, e = min(i, j), max(i, j)
                    least = hashes.index(min(hashes[s : e + 1]), s, e + 1)
                    want.setdefault(least + 1, set()).add((s + 1, e - s + 1))
                    break
    assert {x["_at"]: {(w["s"], w["n"]) for w in x["_windows"]} for x in got} == want
    assert sum(len(x["_windows"]) for x in got) == sum(map(len, want.values())) and len(got) < 150
    for x in got:
        assert x["_print"] == hashes[x["_at"] - 1]
        end = max(w["s"] + w["n"] - 1 for w in x["_windows"])
        assert x["_context"] == hashes[x["_from"] - 1 : end]
