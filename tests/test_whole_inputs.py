"""Short lines, NULL groups, colliding keys, positions on ingest, and the scoring rule on a longer key."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from charloom.operators import holdout, langid, predict, quotas, scoring
from charloom.plans import corpora, modelling
from charloom.sources import files
from charloom.streaming import jobs as streams


@pytest.fixture
def profiles(spark):
    rows = [("en", "the house and the river are here with the others"), ("fr", "le chat est dans la maison avec les autres")]
    return langid.train_language_profiles(spark.createDataFrame(rows, "lang string, text string"), ["en", "fr"])


@pytest.mark.parametrize("shared", [langid.SHARED_GRAMS, 0])
def test_detection_with_keys_that_restart(spark, monkeypatch, profiles, shared):
    monkeypatch.setattr(langid, "SHARED_GRAMS", shared)
    first = spark.createDataFrame([(1, "the others are here"), (2, "ab")], "pos long, text string")
    second = spark.createDataFrame([(1, "le chat"), (2, "dans la maison")], "pos long, text string")
    split = corpora.job_detected_splits([first, second], profiles, "pos")
    got = {(r["source_rank"], r["pos"]): r["detected"] for r in split.collect()}
    assert got == {(0, 1): "en", (0, 2): None, (1, 1): "fr", (1, 2): "fr"}
    plain = langid.detect_language(second, profiles, "pos").collect()
    assert {(r["pos"], r["n_grams"], r["detected"]) for r in plain} == {(1, 5, "fr"), (2, 12, "fr")}


@pytest.mark.parametrize("shared", [langid.SHARED_GRAMS, 0])
@pytest.mark.parametrize("run", [1, 20, 1 << 18])
def test_detection_answers_row_by_row(spark, monkeypatch, profiles, shared, run):
    monkeypatch.setattr(langid, "SHARED_GRAMS", shared)
    texts = ["le chat", "the others", "le chat", None, "", "ab", "zzz", "日本語の", "the house and the river"]
    df = spark.createDataFrame([(i % 2 if i < 7 else None, t) for i, t in enumerate(texts)], "k long, text string").coalesce(1)
    found = langid.detect_language(df, profiles, "k").collect()
    want = [(0, 5, "fr"), (1, 8, "en"), (0, 5, "fr"), (0, 1, None), (None, 2, None), (None, 21, "en")]
    assert sorted(map(str, map(tuple, found))) == sorted(map(str, want))
    named = langid.with_detected_language(df, profiles, "k").collect()
    assert sorted(str((r["k"], r["text"], r["detected"])) for r in named) == sorted(
        str((i % 2 if i < 7 else None, t, {0: "fr", 1: "en", 2: "fr", 8: "en"}.get(i))) for i, t in enumerate(texts)
    )
    # One look-up for many texts gives what each gives alone.
    rows = profiles.table.toPandas()
    codes = langid.np.array([langid._codes(langid._points(g))[0] for g in rows["g"]])
    order = langid.np.argsort(codes)
    weights = rows[["w0", "w1"]].to_numpy()[order]
    plain = [t or "" for t in texts]
    whole = langid._gains(plain, codes[order], weights)
    assert (whole == langid.np.vstack([langid._gains([t], codes[order], weights) for t in plain])).all()
    monkeypatch.setattr(langid, "RUN_CHARS", run)
    assert [t for r in langid._runs(texts) for t in r] == plain


def test_detection_in_the_scan_task_moves_no_text(spark, profiles):
    df = spark.createDataFrame([(1, "le chat")], "pos long, text string")
    plan = langid.with_detected_language(df, profiles, "pos")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_every_line_gets_a_guess_and_teaches(spark):
    texts = ["", " ", "a", "ab", "abc", "abcd", "abcde", "abcdef", "abcdefgh"] * 12
    docs = spark.createDataFrame([(i, "en", t) for i, t in enumerate(texts)], "doc_id long, lang string, text string")
    lines = modelling.evaluation_lines(docs)
    assert lines.count() == 12 * 7
    cut = modelling.prompts(docs).collect()
    assert len(cut) == len(texts)
    for r in cut:
        whole = texts[r["pos"]]
        assert whole.startswith(r["text"] + r["gold"]) and len(r["gold"]) == min(1, len(whole))
    counts = modelling.train_counts(lines, 3)
    guesses = predict.predict(modelling.prompts(docs), predict.byte_model(counts, 3), " .eta", "eta").collect()
    assert len(guesses) == len(texts) and all(len(g["pred"]) == 3 for g in guesses)
    assert {g["pred"] for g in guesses if texts[g["pos"]] == ""} == {"eta"}


def test_null_languages_have_a_quota_of_their_own(spark):
    rows = [(i, None if i % 2 else "en", 1 + i // 10, "x", None) for i in range(20)]
    df = spark.createDataFrame(rows, "pos long, lang string, shard_rank int, text string, register map<string,string>")
    got = quotas.shard_budget_quota(df, 3, 2).groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in got} == {None: 3, "en": 3}


def test_streamed_quota_with_null_languages(spark, tmp_path):
    rows = [(i, None if i % 2 else "en", "x") for i in range(20)]
    spark.createDataFrame(rows, "pos long, lang string, text string").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("pos long, lang string, text string").parquet(f"{tmp_path}/in")
    streams.stream_language_quota(stream, f"{tmp_path}/out", f"{tmp_path}/ckpt", 4).awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").groupBy("lang").count().collect()
    assert {r["lang"]: r["count"] for r in got} == {None: 4, "en": 4}


def test_holdout_with_a_null_key(spark):
    df = spark.range(60).select(F.when(F.col("id") > 0, F.col("id")).alias("k"))
    split = holdout.random_holdout(df, "k", ratio=0.1)
    assert split.where("split = 'test'").count() == 6 and split.count() == 60


def test_positions_on_ingest(spark, tmp_path):
    turns = lambda *xs: [{"from": "human", "value": x} for x in xs]
    (tmp_path / "a.json").write_text(json.dumps([{"id": "1", "conversations": turns("a")}, 5, {"id": "2", "conversations": turns("b")}]))
    (tmp_path / "b.json").write_text(json.dumps([{"id": "3", "conversations": turns("c", "d")}]))
    rows = files.read_conversation_json(spark, [str(tmp_path / "a.json"), str(tmp_path / "b.json")])
    got = [tuple(r) for r in corpora.job_chat_corpus(rows, 0, 9).orderBy("pos").select("pos", "text").collect()]
    assert [t for _, t in got] == ["a", "b", "c d"] and [p for p, _ in got] == sorted({p for p, _ in got})
    (tmp_path / "c.jsonl").write_text("".join(json.dumps({"instruction": f"i{i}", "output": None}) + "\n" for i in range(30)))
    pairs = files.read_instruction_pairs(spark, str(tmp_path / "c.jsonl"))
    assert [r["text"] for r in corpora.job_instruction_corpus(pairs, 4, 2).orderBy("pos").collect()] == ["i4", "i5"]
    spark.range(100).select(F.concat(F.lit("t"), "id").alias("text")).repartition(3).write.parquet(f"{tmp_path}/en")
    one = files.read_language_configs(spark, {"en": f"{tmp_path}/en", "none": f"{tmp_path}/none"})
    assert sorted(r["pos"] for r in one.collect()) == list(range(100))


def test_a_key_of_111_lines_with_42_hits(spark):
    gold = [(i, "X" if i % 3 else "é") for i in range(111)]
    pred = [(i, ("ab" + g.lower()) if i < 42 else "abc" + g) for i, g in gold if i != 110]
    scored = scoring.score_join(
        spark.createDataFrame(gold, "pos long, gold string"), spark.createDataFrame(pred, "pos long, pred string")
    )
    rate = scoring.success_rate(scored).first()
    assert (rate["n"], rate["hits"]) == (111, 42) and rate["success_rate"] == pytest.approx(42 / 111)
