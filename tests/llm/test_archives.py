"""Archives: round trip, ZIP64, damage, and edge cases."""

from __future__ import annotations

import hashlib
import io
import zipfile

import pytest
from pyspark.sql import functions as F

from charloom.llm import warc

PAGES = "page_id long, url string, html string"


def answers(spark, data, **options):
    pages = spark.createDataFrame(data, PAGES).withColumn("_key", F.lit("other"))
    archives = warc.write_archives(pages, **options)
    return warc.read_records(warc.read_index(archives)).collect(), archives


def test_round_trip_and_revisits(spark):
    big, small = "é" * 600, "s" * 999
    data = [(i, f"http://x/{i}", big) for i in range(40)] + [(100 + i, None, small) for i in range(3)]
    data += [(7, "http://again", "z" * 2000), (8, "a\r\nb", "z" * 2000), (300, "u", None), (301, "u", ""), (None, "n", "q")]
    data += [(9, "http://same", "t" * 1500)] * 2 + [(2**60 + 1, "wide", "w")]
    got, archives = answers(spark, data, archive_bytes=2000)
    assert len(got) == len(data) and archives.count() > 1
    by = {}
    for r in got:
        by.setdefault(r["page_id"], []).append(r)
    for i in range(40):
        r = next(x for x in by[i] if x["payload_bytes"] == 1200)
        assert r["payload_digest"] == hashlib.sha1(big.encode()).hexdigest()
        assert (r["record_type"], r["refers_to"]) == (("response", None) if i == 39 else ("revisit", 39))
        assert r["payload"].decode() == (big if i == 39 else "")
    assert all(by[100 + i][0]["record_type"] == "response" and by[100 + i][0]["refers_to"] is None for i in range(3))
    again = next(x for x in by[7] if x["payload_bytes"] == 2000)
    assert again["refers_to"] == 8 and by[300][0]["payload_bytes"] == by[301][0]["payload_bytes"] == 0
    assert by[None][0]["payload"] == b"q" and by[100][0]["url"] is None
    assert by[2**60 + 1][0]["payload"] == b"w"
    same = sorted((x["record_type"], x["refers_to"]) for x in by[9] if x["payload_bytes"] == 1500)
    assert same == [("response", None), ("revisit", 9)]


def test_a_selection_of_records_and_a_listing(spark, tmp_path):
    data = [(i, f"u{i}", f"text {i} " * 50) for i in range(30)]
    pages = spark.createDataFrame(data, PAGES)
    root = f"file://{tmp_path}/archives"
    warc.write_archives(pages, root=root)
    listed = warc.list_archives(spark, root)
    index = warc.read_index(listed)
    digest = hashlib.sha1(data[4][2].encode()).hexdigest()
    one = warc.read_records(index.where(F.col("digest") == f"sha1:{digest}")).collect()
    assert [(r["page_id"], r["payload"].decode()) for r in one] == [(4, data[4][2])]


def test_empty_table_writes_nothing(spark):
    got, archives = answers(spark, [])
    assert got == [] and archives.count() == 0


def zipped(prefix=b"", comment=b"", **options):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for i in range(3):
            with z.open(f"archive/é{i}", "w", **options) as f:
                f.write(b"abc" * i)
        z.comment = comment
    return prefix + out.getvalue()


@pytest.mark.parametrize("prefix", [b"", b"stub" * 9])
@pytest.mark.parametrize("comment", [b"", b"PK\x05\x06 in a comment of some length"])
@pytest.mark.parametrize("wide", [False, True])
def test_directory_with_stub_comment_and_wide_members(prefix, comment, wide):
    data = zipped(prefix, comment, force_zip64=wide)
    found = warc.directory(io.BytesIO(data), len(data))
    assert [m.name for m in found] == ["archive/é0", "archive/é1", "archive/é2"]
    f = io.BytesIO(data)
    for i, m in enumerate(found):
        at = warc.stored_at(f, m)
        assert data[at : at + m.size] == b"abc" * i


def test_zip64_directory(monkeypatch):
    monkeypatch.setattr(zipfile, "ZIP64_LIMIT", 10)
    monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 1)
    data = zipped()
    assert b"PK\x06\x06" in data and b"PK\x06\x07" in data
    found = warc.directory(io.BytesIO(data), len(data))
    f = io.BytesIO(data)
    assert [data[(a := warc.stored_at(f, m)) : a + m.size] for m in found] == [b"", b"abc", b"abcabc"]


def test_damage_is_told(spark):
    with pytest.raises(ValueError, match="no end"):
        warc.directory(io.BytesIO(b"nothing"), 7)
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("archive/a", "x" * 100)
    data = out.getvalue()
    with pytest.raises(ValueError, match="compressed"):
        warc.stored_at(io.BytesIO(data), warc.directory(io.BytesIO(data), len(data))[0])
