"""Packing: the search against exhaustive optima, the round trip, and edge cases."""

from __future__ import annotations

import random
import zlib
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from charloom.llm import packing


def optimum(items, capacity):
    items = tuple(sorted(items, reverse=True))

    @cache
    def best(left):
        if not left:
            return 0
        first, rest = left[0], left[1:]
        found = 99

        def fill(i, room, taken):
            nonlocal found
            found = min(found, 1 + best(tuple(x for j, x in enumerate(rest) if j not in taken)))
            for j in range(i, len(rest)):
                if rest[j] <= room:
                    fill(j + 1, room - rest[j], taken | {j})

        fill(0, capacity - first, frozenset())
        return found

    return best(items)


@pytest.mark.parametrize("seed", range(25))
def test_search_finds_the_optimum_of_small_sets(seed):
    r = random.Random(seed)
    items = [r.randint(1, 20) for _ in range(r.randint(1, 9))]
    counts = {x: items.count(x) for x in items}
    plan = packing.complete_bins(counts, 20)
    used = {}
    for pattern, times in plan:
        assert sum(pattern) <= 20
        for x in pattern:
            used[x] = used.get(x, 0) + times
    assert used == counts
    bins = sum(t for _, t in plan)
    assert packing.lower_bound(counts, 20) <= optimum(items, 20) == bins


def test_search_without_budget_still_packs_all():
    counts = {x: 3 for x in range(1, 100)}
    used = {}
    for pattern, times in packing.complete_bins(counts, 128, nodes=5):
        for x in pattern:
            used[x] = used.get(x, 0) + times
    assert used == counts and packing.complete_bins({}, 128) == []


def test_ids_equal_those_of_the_json_vocabulary():
    import public_tokenizers
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encode = packing.encoder("byte_bpe_50k")
    texts = ["", " a  b\n\n", "Ünï çødé 天气 don't", "x" * 5000, "stop <|endoftext|> go", "\t1234567"]
    assert [encode(t) for t in texts] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_pack_documents_round_trip(spark):
    r = random.Random(1)
    words = ["alpha", "beta", "über", "天气", "\n", "12"]
    data = [(i % 50, " ".join(r.choice(words) for _ in range(r.randint(0, 900)))) for i in range(60)]
    data += [(None, None), (2**60 + 1, "wide"), (1000, ""), (1001, "word " * 30_000), (1000, "")]
    docs = spark.createDataFrame(data, "doc_id long, text string").withColumn("piece", F.lit("old"))
    packed = packing.pack_documents(docs, capacity=512).cache()
    encode = packing.encoder("byte_bpe_50k")
    got = {}
    for p in packed.collect():
        assert p["ids_crc32"] == zlib.crc32(np.array(p["ids"], "<u4").tobytes()) and len(p["ids"]) == p["length"]
        got.setdefault(p["doc_id"], []).append((p["piece"], p["start"], tuple(p["ids"])))
    for k in {d[0] for d in data}:
        want = []
        for text in [t for i, t in data if i == k]:
            ids = [*encode(text or ""), 0]
            cut = len(ids) % 512 or 512
            starts = [0, *range(cut, len(ids), 512)]
            want += [(n, a, tuple(ids[a : (starts + [len(ids)])[n + 1]])) for n, a in enumerate(starts)]
        assert sorted(got[k]) == sorted(want)
    by = {}
    for p in packed.collect():
        by.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for parts in by.values():
        parts.sort()
        assert parts[0][0] == 0 and sum(n for _, n in parts) <= 512
        assert all(a + n == b for (a, n), (b, _) in zip(parts, parts[1:], strict=False))
    counts = {}
    for _, n in [x for parts in by.values() for x in parts]:
        counts[n] = counts.get(n, 0) + 1
    assert len(by) <= packing.lower_bound(counts, 512) + 1
    assert packing.sequences(packed).count() == len(by)
    packed.unpersist()


def test_hot_lengths_are_salted_and_empty_tables_pack_to_nothing(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 10)
    pieces = spark.range(200).select("id", F.when(F.col("id") < 150, 7).otherwise(F.col("id") % 5 + 1).cast("long").alias("length"))
    got = packing.pack(pieces, order=["id"], capacity=20).collect()
    assert len({(p["sequence_id"], p["offset"]) for p in got}) == 200
    assert packing.pack(pieces.limit(0), order=["id"], capacity=20).count() == 0
    with pytest.raises(ValueError, match="1 to 20"):
        packing.pack(pieces.withColumn("length", F.lit(21)), order=["id"], capacity=20)
