"""Quotas as keyed state: equal to the batch rule, over restarts and replays."""

from __future__ import annotations

import pytest

from charloom.streaming import quota_state

SCHEMA = "pos bigint, lang string, text string"


def rows(batch):
    # One language has most rows, one is NULL, one stays below its quota; positions do not come in order.
    names = ["en"] * 7 + ["fr", None, "de" if batch == 1 else "en"]
    return [(batch * 1000 + (37 * i) % 200, names[i % 10], f"line {batch} {i}") for i in range(200)]


def wanted(quota):
    out, taken = [], {}
    for b in range(3):
        for pos, lang, text in sorted(rows(b)):
            taken[lang] = taken.get(lang, 0) + 1
            if taken[lang] <= quota:
                out.append((pos, lang, text))
    return sorted(out)


@pytest.mark.parametrize("quota, salts", [(25, 4), (170, 1), (330, 8)])
def test_quota_state_equals_batch_after_restarts(spark, tmp_path, quota, salts):
    source, out, check = (str(tmp_path / x) for x in ("in", "o", "c"))
    for b in range(3):
        spark.createDataFrame(rows(b), SCHEMA).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        # A new query each time: what it knows of earlier batches comes from the checkpoint.
        quota_state.stream_quota_state(stream, out, check, quota, salts=salts).awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == wanted(quota)
    # The last batch ran but was not committed: it runs again on the state before it and adds nothing twice.
    done = sorted((p for p in (tmp_path / "c" / "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    for name in (done[-1].name, f".{done[-1].name}.crc"):
        (tmp_path / "c" / "commits" / name).unlink(missing_ok=True)
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
    quota_state.stream_quota_state(stream, out, check, quota, salts=salts).awaitTermination()
    assert done[-1].exists()
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == wanted(quota)
