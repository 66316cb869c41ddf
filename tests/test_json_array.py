"""JSON-array files in byte ranges: the same objects and positions for every size of range."""

from __future__ import annotations

import json
import random

import pytest

from charloom.plans import corpora
from charloom.sources import files, json_array


def chat(i, r):
    value = "".join(r.choice(['"', "\\", "{", "}", "[", "]", ",", "a", "é", "日", "\n", "🙂", " "]) for _ in range(r.randint(0, 40)))
    return {"id": f"c{i}", "conversations": [{"from": "human", "value": value}, {"from": "gpt", "value": {"x": [{}, [1]]}}]}


def documents():
    r = random.Random(7)
    odd = [5, None, "a {string}", [{"id": "no"}, [{}]], True, "\\", '"', {}, -1.5e3]
    one = [odd[0], *[x for i in range(25) for x in (chat(i, r), r.choice(odd))], odd[3]]
    return [one, [], [7], [chat(90, r), odd[2], chat(91, r)], [{"id": "\\" * 61, "conversations": None}]]


@pytest.fixture
def paths(tmp_path):
    out = []
    for i, doc in enumerate(documents()):
        text = json.dumps(doc, ensure_ascii=i % 2 == 0, indent=3 if i == 3 else None)
        (tmp_path / f"{i}.json").write_text(f" \n{text}\n", encoding="utf-8")
        out.append(str(tmp_path / f"{i}.json"))
    return out


def wanted():
    found = [(rank, x) for rank, doc in enumerate(documents()) for x in doc if isinstance(x, dict)]
    return [(rank, pos, x) for pos, (rank, x) in enumerate(found)]


def test_every_range_size_gives_the_same_objects_in_plain_python(paths):
    """All cuts of a file: states found by both assumptions, folded, and read again."""
    doc = wanted()
    for path, rank in ((paths[0], 0), (paths[3], 3), (paths[4], 4)):
        size = len(open(path, "rb").read())
        for split in (1, 2, 3, 7, 64, 1000, size):
            inside, depth, before, got = False, 0, 0, []
            for start in range(0, size, split):
                r = json_array.Range(path, rank, start, min(start + split, size), size, inside, depth, before)
                got += [(k, n, json.loads(x)) for k, n, x in json_array.objects(r)] if split > 2 or start < 500 else []
                inside, change, _, opened = json_array.scan(path, start, r.end, inside)
                before += opened[1 - depth]
                depth += change
            mine = [x for k, _, x in doc if k == rank]
            assert (before, inside, depth) == (len(mine), False, 0)
            if split > 2:
                assert [(n, x) for _, n, x in got] == list(enumerate(mine))


@pytest.mark.parametrize("chunk", [1, 5, 1 << 20])
def test_chunks_do_not_cut_escapes(paths, monkeypatch, chunk):
    monkeypatch.setattr(json_array, "CHUNK_BYTES", chunk)
    size = len(open(paths[0], "rb").read())
    r = json_array.Range(paths[0], 0, 0, size, size, False, 0, 0)
    assert [json.loads(x) for _, _, x in json_array.objects(r)] == [x for k, _, x in wanted() if k == 0]


@pytest.mark.parametrize("split", [37, 500, 1 << 20])
def test_read_json_array(spark, paths, split):
    df = json_array.read_json_array(spark, paths, split)
    got = sorted((r["file_rank"], r["pos"], r["item"]) for r in df.collect())
    assert [(k, n, json.loads(x)) for k, n, x in got] == wanted()
    assert df.rdd.getNumPartitions() >= (sum(len(open(p, "rb").read()) for p in paths) // split or 1)


@pytest.mark.parametrize("split", [50, 1 << 20])
def test_conversations_count_objects_only(spark, tmp_path, split):
    a, b = ({"id": x, "conversations": [{"from": "human", "value": f"say {x}"}]} for x in "ab")
    for name, doc in (("1", [5, a, 7, b]), ("2", [None]), ("3", ["x", b, [a]])):
        (tmp_path / f"{name}.json").write_text(json.dumps(doc))
    paths = [str(tmp_path / f"{n}.json") for n in "123"]
    df = files.read_conversation_json(spark, paths, split_bytes=split)
    assert sorted((r["pos"], r["file_rank"], r["id"]) for r in df.collect()) == [(0, 0, "a"), (1, 0, "b"), (2, 2, "b")]
    assert [r["text"] for r in corpora.job_chat_corpus(df, 1, 1).collect()] == ["say b"]


def test_conversation_lines_count_objects_only(spark, tmp_path):
    rows = ["5", '{"id":"a"}', "{bad", "", '{"id":"b","conversations":[3,{"from":"x","value":1}]}', "[{}]", '{"id":"c"}']
    (tmp_path / "x.jsonl").write_text("\n".join(rows))
    (tmp_path / "y.jsonl").write_text('null\n{"id":"d"}')
    df = files.read_conversation_json(spark, [str(tmp_path / "x.jsonl"), str(tmp_path / "y.jsonl")], lines=True)
    assert sorted((r["pos"], r["id"]) for r in df.collect()) == [(0, "a"), (1, "b"), (2, "c"), (3, "d")]
    assert [tuple(t) for t in df.where("id = 'b'").first()["conversations"]] == [("x", None)]


@pytest.mark.parametrize("text", ['[{"a":1}', '{"a":1}', '[{"a":1}]]', '[{"a":"x}]', '[{"a":1}] {"b":2}'])
@pytest.mark.parametrize("split", [4, 1 << 20])
def test_files_that_are_no_array_raise(spark, tmp_path, text, split):
    (tmp_path / "x.json").write_text(text)
    with pytest.raises(ValueError, match="x.json"):
        files.read_conversation_json(spark, [str(tmp_path / "x.json")], split_bytes=split)


def test_a_broken_object_raises(spark, tmp_path):
    (tmp_path / "x.json").write_text('[{"id":"a"},{"id" "b"},{"id":"c"}]')
    df = files.read_conversation_json(spark, [str(tmp_path / "x.json")])
    with pytest.raises(Exception, match="malformed JSON object at position 1"):
        df.collect()
