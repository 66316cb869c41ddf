"""Readers, writers, recipes and streams on small generated files."""

from __future__ import annotations

import gzip
import json
from types import SimpleNamespace

import pyarrow as pa
import pytest
import zstandard
from pyspark.sql import functions as F

from charloom.functions import predicates as P
from charloom.operators import ngrams, predict, quotas
from charloom.plans import corpora, table_queries
from charloom.session import stage, staging_root
from charloom.sinks import committed
from charloom.sinks import lines as sinks
from charloom.sources import files
from charloom.streaming import jobs as streams


def lines_of(df, col="text"):
    return [r[col] for r in df.orderBy("pos").collect()]


def test_read_lines_modes(spark, tmp_path):
    raw = b"a\r\n\nb\rc \n  d"
    (tmp_path / "x.txt").write_bytes(raw)
    path = str(tmp_path / "x.txt")
    text = files.read_lines(spark, path)
    assert lines_of(text) == ["a", "", "b", "c ", "  d"]
    assert sorted(r["pos"] for r in text.collect()) == [0, 1, 2, 3, 4]
    assert lines_of(files.read_lines(spark, path, mode="bytes")) == ["a\r", "", "b\rc ", "  d"]
    kept = files.read_corpus_lines(spark, path).orderBy("pos").collect()
    assert [(r["pos"], r["text"]) for r in kept] == [(0, "a"), (2, "b"), (3, "c"), (4, "d")]


def test_read_lines_over_many_files_and_splits(spark, tmp_path):
    sizes = [40, 3, 700, 0, 12]
    want = []
    for i, n in enumerate(sizes):
        lines = [f"{i}-{j}-" + "x" * (j % 50) for j in range(n)]
        (tmp_path / f"part-{i}.txt").write_text("".join(x + "\n" for x in lines))
        want += lines
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        got = files.read_lines(spark, str(tmp_path))
        assert lines_of(got) == want
        per = files.read_lines(spark, str(tmp_path), per_file=True)
        assert per.where("file = 'part-2.txt'").agg(F.max("pos")).first()[0] == 699
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


RECORDS = [
    '{"text":" a ","web-register":{"ID":0.5,"IP":"0.1"}}',
    "{bad",
    '{"text":5}',
    '{"text":"  "}',
    "",
    '{"x":1}',
    "[1]",
    '{"text":"b","web-register":"str"}',
    '{"text":"c\\nd"}',
    '{"text":"e","web-register":{"ID":null,"NA":[1]}}',
]


@pytest.mark.parametrize("kind", ["plain", "gz", "zst"])
def test_read_jsonl_docs(spark, tmp_path, kind):
    data = ("\n".join(RECORDS) + "\n").encode() + b'{"text":"f\xff"}\n'
    if kind == "gz":
        data = gzip.compress(data)
    if kind == "zst":
        data = zstandard.ZstdCompressor().compress(data)
    path = tmp_path / f"s.jsonl{'' if kind == 'plain' else '.' + kind}"
    path.write_bytes(data)
    got = {r["text"]: r for r in files.read_jsonl_docs(spark, str(path)).collect()}
    assert set(got) == {"a", "b", "c\nd", "e", "f�"}
    keep = files.read_jsonl_docs(spark, str(path)).where(P.is_conversational(F.col("register")))
    assert {r["text"] for r in keep.collect()} == {"a", "b", "c\nd", "f�"}
    assert got["a"]["register"] == {"ID": "0.5", "IP": "0.1"}
    assert got["a"]["pos"] == 0


def test_malformed_json(spark):
    df = spark.createDataFrame([(r,) for r in RECORDS], "value string")
    assert files.drop_malformed_json(df).count() == 8


def test_read_conversations(spark, tmp_path):
    chats = [
        {"id": "x", "conversations": [
            {"from": "human", "value": " Hi\nthere "}, {"from": "gpt", "value": None},
            {"from": "gpt", "value": 5}, {"from": "gpt", "value": "  "}, {"from": "gpt", "value": "ok"}]},
        {"id": "y", "conversations": []},
    ]
    (tmp_path / "1.json").write_text(json.dumps(chats))
    (tmp_path / "2.json").write_text(json.dumps([{"id": "z", "conversations": [{"from": "a", "value": "end"}]}]))
    df = files.read_conversation_json(spark, [str(tmp_path / "1.json"), str(tmp_path / "2.json")])
    rank = {"x": 0, "y": 1, "z": 2}
    posed = df.withColumn("pos", F.element_at(F.create_map(*[F.lit(v) for kv in rank.items() for v in kv]), F.col("id")))
    assert lines_of(corpora.job_chat_corpus(posed, 0, 10)) == ["Hi there ok", "end"]
    assert lines_of(corpora.job_chat_corpus(posed, 1, 10)) == ["end"]
    assert {r["id"]: r["file_rank"] for r in df.collect()} == {"x": 0, "y": 0, "z": 1}


def test_instruction_pairs(spark, tmp_path):
    rows = [{"pos": 0, "instruction": "a", "output": "b"}, {"pos": 1}, {"pos": 2, "output": " c\n"}]
    (tmp_path / "p.json").write_text("\n".join(json.dumps(r) for r in rows))
    df = files.read_instruction_pairs(spark, str(tmp_path / "p.json"))
    assert lines_of(corpora.job_instruction_corpus(df, 0, 10)) == ["a b", "c"]
    assert lines_of(corpora.job_instruction_corpus(df, 1, 1)) == []


def test_parallel_text(spark, tmp_path):
    (tmp_path / "Subs.en-hi.en").write_bytes(b"one\n\ntwo \r\nth\xffree\n")
    (tmp_path / "Subs.en-hi.hi").write_bytes("एक\nदो".encode())
    (tmp_path / "README").write_text("no")
    df = files.read_parallel_text(spark, str(tmp_path), "en", "hi")
    en = df.where("lang = 'en'")
    assert lines_of(en) == ["one", "", "two \r", "th�ree"]
    got = corpora.job_pair_corpus(df, ["en", "hi"], 4)
    assert {(r["lang"], r["text"]) for r in got.collect()} == {
        ("en", "one"), ("en", "two"), ("en", "th�ree"), ("hi", "एक")}
    split = corpora.job_pair_splits(df, cap=1)
    assert {(r["split"], r["text"]) for r in split.collect()} == {("english", "two"), ("non_english", "दो")}


def test_language_configs_skip_what_fails(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "en"))
    got = files.read_language_configs(spark, {"xx": str(tmp_path / "no"), "en": str(tmp_path / "en")})
    assert {(r["lang"], r["lang_rank"]) for r in got.collect()} == {("en", 1)}
    assert files.read_language_configs(spark, {"xx": str(tmp_path / "no")}) is None


def test_write_lines_keeps_order_in_parts(spark, tmp_path):
    df = spark.range(1000).select(F.col("id").alias("k"), F.concat(F.lit("a\n"), "id").alias("text"))
    sinks.write_lines(df.orderBy(F.rand(1)), str(tmp_path / "o"), ["k"], partitions=5)
    parts = sorted(p for p in (tmp_path / "o").iterdir() if p.name.startswith("part-"))
    assert len(parts) == 5
    got = "".join(p.read_text() for p in parts).splitlines()
    assert got == [f"a {i}" for i in range(1000)]


def test_language_split_counts(spark, tmp_path):
    df = spark.createDataFrame(
        [(0, " hello there "), (1, "你好世界"), (2, "  "), (3, "ok")], "pos bigint, text string")
    counts = sinks.write_language_split(df, str(tmp_path / "s"), "m", ["pos"])
    assert {r["split"]: r["n"] for r in counts.collect()} == {"m_english": 2, "m_non_english": 1}
    assert lines_of(files.read_lines(spark, str(tmp_path / "s" / "split=m_english"))) == ["hello there", "ok"]
    flipped = sinks.write_language_split(df, str(tmp_path / "f"), "m", ["pos"], english=lambda c: c.contains("世"))
    assert {r["split"]: r["n"] for r in flipped.collect()} == {"m_english": 1, "m_non_english": 2}


def test_predictions_one_per_input(spark, tmp_path):
    inputs = spark.range(5).select(F.col("id").alias("pos"))
    preds = spark.createDataFrame([(0, "abc"), (3, "d e")], "pos bigint, pred string")
    assert committed.write_predictions(inputs, preds, str(tmp_path / "p"), default="eta") == 5
    assert lines_of(files.read_lines(spark, str(tmp_path / "p"))) == ["abc", "eta", "eta", "d e", "eta"]
    with pytest.raises(ValueError):
        committed.write_predictions(inputs, preds.union(preds), str(tmp_path / "q"))


def test_committed_lines_manifest(spark, tmp_path):
    data = [(i, None if i == 5 else f"a\r\n{i}", ["x", "y", None][i % 3]) for i in range(300)]
    df = spark.createDataFrame(data, "pos bigint, text string, side string").repartition(7)
    path = str(tmp_path / "o")
    rows = committed.write_committed(df, path, ["pos"], split=F.col("side"), partitions=4).collect()
    for side in ("", "x", "y"):
        mine = [r for r in rows if r["split"] == side]
        want = [d for d in data if (d[2] or "") == side]
        assert len(mine) == 4 and sum(r["rows"] for r in mine) == len(want)
        text = b"".join((tmp_path / "o" / r["file"]).read_bytes() for r in mine)
        assert text.decode().splitlines() == [(d[1] or "").replace("\r\n", " ") for d in want]
        assert len(text) == sum(r["bytes"] for r in mine)
        edges = [(json.loads(r["first"])["pos"], json.loads(r["last"])["pos"]) for r in mine]
        assert edges[0][0] == want[0][0] and edges[-1][1] == want[-1][0]
        assert all(a[1] < b[0] for a, b in zip(edges, edges[1:]))
    assert (tmp_path / "o" / "_SUCCESS").exists() and not list((tmp_path / "o").glob("_pending*"))
    with pytest.raises(FileExistsError):
        committed.write_committed(df, path, ["pos"])
    empty = str(tmp_path / "e")
    assert committed.write_committed(df.limit(0), empty, ["pos"]).count() == 0
    assert committed.write_committed(df, str(tmp_path / "r"), ["pos"], partitions=3).agg(F.sum("rows")).first()[0] == 300


def test_committed_lines_count_accepted_attempts_only(tmp_path):
    """An attempt that wrote and was not accepted leaves neither rows nor files; an abort leaves nothing."""
    writer = committed.LinesWriter(str(tmp_path / "o"), "j")
    batch = pa.RecordBatch.from_pydict({"split": ["", "b", ""], "key": ["1", "2", "3"], "line": ["u", "v", "w"]})
    old, committed.TaskContext = committed.TaskContext, SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0))
    try:
        writer.write(iter([batch]))
        second = writer.write(iter([batch, batch]))
        other = committed.LinesWriter(str(tmp_path / "a"), "j")
        other.abort([other.write(iter([batch]))])
    finally:
        committed.TaskContext = old
    writer.commit([None, second])
    names = sorted(p.relative_to(tmp_path / "o").as_posix() for p in (tmp_path / "o").rglob("*") if p.is_file())
    assert names == ["_SUCCESS", "_manifest/files.json", "part-000000-j.txt", "split=b/part-000000-j.txt"]
    listed = [json.loads(x) for x in (tmp_path / "o/_manifest/files.json").read_text().splitlines()]
    assert [(e["split"], e["rows"], e["first"], e["last"]) for e in listed] == [("", 4, "1", "3"), ("b", 2, "2", "2")]
    assert (tmp_path / "o/part-000000-j.txt").read_text() == "u\nw\nu\nw\n"
    assert not [p for p in (tmp_path / "a").rglob("*") if p.is_file()]


def test_write_if_absent(spark, tmp_path):
    df = spark.createDataFrame([(0, "a")], "pos bigint, text string")
    assert sinks.write_if_absent(df, str(tmp_path / "w"), ["pos"])
    assert not sinks.write_if_absent(df.withColumn("text", F.lit("b")), str(tmp_path / "w"), ["pos"])
    assert lines_of(files.read_lines(spark, str(tmp_path / "w"))) == ["a"]


def test_register_recipe(spark, tmp_path):
    """Shards to corpus: the budget is spent before the register filter, inner newlines stay."""
    def shard(name, kinds):
        rows = [{"text": f"{name} {i}\nx", "web-register": {"ID": 0.9 if k == "k" else 0.0}} for i, k in enumerate(kinds)]
        (tmp_path / name).write_bytes(zstandard.ZstdCompressor().compress("".join(json.dumps(r) + "\n" for r in rows).encode()))
    shard("en1.jsonl.zst", "kdkdkk")
    shard("en2.jsonl.zst", "dkk")
    shard("en3.jsonl.zst", "kkkk")
    names = spark.createDataFrame([("en", i, f"en{i}.jsonl.zst") for i in (1, 2, 3)], "lang string, pos bigint, shard string")
    chosen = quotas.select_shards(names, 2).select("lang", F.col("shard").alias("file"), "shard_rank")
    paths = [str(tmp_path / r["file"]) for r in chosen.collect()]
    docs = files.read_jsonl_docs(spark, paths).join(chosen, "file")
    got = corpora.job_register_corpus(docs, ["en"], 4).orderBy("shard_rank", "pos").collect()
    assert [r["text"] for r in got] == ["en1.jsonl.zst 0\nx", "en1.jsonl.zst 2\nx", "en2.jsonl.zst 1\nx"]


def test_detected_splits_need_every_pair(spark):
    df = spark.createDataFrame([(0, "a")], "pos bigint, text string")
    assert corpora.job_detected_splits([df, None], None, "pos") is None


def arriving(spark, tmp_path, batches):
    """One parquet file per batch, read one per trigger."""
    schema = "pos bigint, lang string, text string"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


def batches():
    return [[(b * 100 + i, "en" if i % 4 else "fr", f"{'line' if i % 4 else 'élan'} {b} {i} of many") for i in range(20)] for b in range(3)]


def test_stream_clean_equals_batch(spark, tmp_path):
    stream = arriving(spark, tmp_path, batches())
    streams.stream_clean(stream, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    want = streams.web_clean(spark.read.parquet(str(tmp_path / "in")))
    assert sorted(spark.read.parquet(str(tmp_path / "o")).collect()) == sorted(want.collect())


def test_stream_counts_equal_batch(spark, tmp_path):
    stream = arriving(spark, tmp_path, batches())
    counts = streams.stream_split_counts(stream, P.is_english_ascii)
    streams.write_latest(counts, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    got = streams.latest_batch(spark, str(tmp_path / "o")).collect()
    batch = spark.read.parquet(str(tmp_path / "in"))
    want = batch.groupBy("lang", P.is_english_ascii(F.col("text")).alias("e")).count().collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_stream_quota_over_batches(spark, tmp_path):
    stream = arriving(spark, tmp_path, batches())
    streams.stream_language_quota(stream, str(tmp_path / "o"), str(tmp_path / "c"), 23).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "o"))
    assert {r["lang"]: r["count"] for r in got.groupBy("lang").count().collect()} == {"en": 23, "fr": 15}
    by_batch = {(r["batch"], r["lang"]): r["count"] for r in got.groupBy("batch", "lang").count().collect()}
    assert by_batch == {(0, "en"): 15, (0, "fr"): 5, (1, "en"): 8, (1, "fr"): 5, (2, "fr"): 5}


def test_stream_predict_equals_batch(spark, tmp_path):
    stream = arriving(spark, tmp_path, batches())
    counts = ngrams.order_counts(ngrams.full_gram_counts(spark.read.parquet(str(tmp_path / "in")), 3), 3)
    model = predict.NgramModel(stage(ngrams.ngram_topk(counts), "topk"), 3)
    streams.stream_predict(stream, model, str(tmp_path / "o"), str(tmp_path / "c"), " .eta", "eta").awaitTermination()
    want = predict.predict(spark.read.parquet(str(tmp_path / "in")), model, " .eta", "eta").select("pos", "pred")
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "o")).select("pos", "pred").collect())) == sorted(map(tuple, want.collect()))


@pytest.mark.parametrize("n", [1, 2, 4])
def test_stream_predict_replays_without_doubles(spark, tmp_path, n):
    stream = arriving(spark, tmp_path, batches())
    rows = spark.read.parquet(str(tmp_path / "in"))
    model = predict.NgramModel(stage(ngrams.ngram_topk(ngrams.order_counts(ngrams.full_gram_counts(rows, n), n)), "topk"), n)
    where = (str(tmp_path / "o"), str(tmp_path / "c"))
    first = streams.stream_predict(stream, model, *where, " .eta", "eta")
    first.awaitTermination()
    plan = first._jsq.explainInternal(True)
    assert "ForeachBatch" not in plan and "StateStore" not in plan
    # The last batch was written but not committed: it runs again.
    done = sorted((p for p in (tmp_path / "c" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for name in (done[-1].name, f".{done[-1].name}.crc"):
        (tmp_path / "c" / "commits" / name).unlink(missing_ok=True)
    again = streams.stream_predict(stream, model, *where, " .eta", "eta")
    again.awaitTermination()
    assert done[-1].exists()
    want = predict.predict(rows, model, " .eta", "eta").select("pos", "pred")
    got = spark.read.parquet(str(tmp_path / "o")).select("pos", "pred")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_staging_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        assert staging_root(spark) == configured.rstrip("/")
    else:
        assert staging_root(spark) == spark.sparkContext.getCheckpointDir().rstrip("/")


@pytest.mark.parametrize("folder", [True, False])
def test_stream_queries_read_a_table_of_one_file_or_many(spark, tmp_path, folder):
    """The documents arrive alike whether ``documents.parquet`` is one file or a folder of parts."""
    rows = [(pos, lang, "s", text) for part in batches() for pos, lang, text in part]
    df = spark.createDataFrame(rows, "doc_id bigint, lang string, source string, text string")
    sf = tmp_path / "sf"
    if folder:
        df.repartition(3).write.parquet(str(sf / "documents.parquet"))
    else:
        df.coalesce(1).write.parquet(str(tmp_path / "one"))
        sf.mkdir()
        (part,) = (tmp_path / "one").glob("*.parquet")
        (sf / "documents.parquet").write_bytes(part.read_bytes())
    asked = table_queries.all_queries()
    got = {q: asked[q](spark, str(sf)).collect() for q in asked if q.startswith("stream_")}
    want = streams.web_clean(df.select(F.col("doc_id").alias("pos"), "lang", "text"))
    assert sorted(map(tuple, got["stream_clean"])) == sorted(map(tuple, want.collect()))
    assert sum(r["n"] for r in got["stream_split_counts"]) == 60
    assert {r["lang"]: r["n"] for r in got["stream_language_quota"]} == {"en": 45, "fr": 15}
    for name in ("stream_quota_state", "stream_predict"):
        assert sorted(r["pos"] for r in got[name]) == sorted(r[0] for r in rows), name
