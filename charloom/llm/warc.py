"""WARC records in ZIP-packaged archives, written and read by byte ranges (operator 1).

An archive is a ZIP file whose members are stored, not compressed: ``archive/*.warc.gz`` holds the records, each
its own gzip member, and ``indexes/*.cdxj`` one line per record with its place. Because members are stored, a
record is one byte range of the ZIP file, and nothing is extracted to read it.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import json
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator
from types import SimpleNamespace
from typing import NamedTuple

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from charloom.session import stage, staging_path

ARCHIVE_BYTES = 128 << 20
RECORDS, INDEX = "archive/data.warc.gz", "indexes/index.cdxj"
#: Range reads of neighbouring records are joined up to this size.
READ_BYTES = 4 << 20

# --- the ZIP directory ------------------------------------------------------------------------------


class Member(NamedTuple):
    name: str
    method: int
    crc32: int
    packed: int
    size: int
    header: int  # offset of the local header


def _at(f, offset: int, size: int) -> bytes:
    f.seek(offset)
    return f.read(size)


def directory(f, size: int) -> list[Member]:
    """Members of a ZIP file from its central directory; follows the ZIP64 records where a field is full.

    Reads the tail with the end record and the directory itself, nothing else. Bytes before the archive (a
    prefixed stub) shift all offsets and are allowed for. Raises ``ValueError`` if there is no directory.
    """
    tail_at = max(0, size - (1 << 16) - 22 - 20)
    tail = _at(f, tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    while end >= 0 and end + 22 + int.from_bytes(tail[end + 20 : end + 22], "little") != len(tail):
        end = tail.rfind(b"PK\x05\x06", 0, end)  # the mark may also stand in the comment
    if end < 0:
        raise ValueError("no end of a ZIP directory")
    count, length, start = struct.unpack("<HII", tail[end + 10 : end + 20])
    stop = tail_at + end
    if end >= 20 and tail[end - 20 : end - 16] == b"PK\x06\x07" and (count, length, start).count(0) < 3:
        told = struct.unpack("<Q", tail[end - 12 : end - 4])[0]
        # The record has no comment in practice, so it also stands right before its locator.
        for at in (told, tail_at + end - 20 - 56):
            record = _at(f, at, 56) if 0 <= at <= size - 56 else b""
            if record[:4] == b"PK\x06\x06":
                count, length, start = struct.unpack("<QQQ", record[32:56])
                stop = at
                break
        else:
            raise ValueError("no ZIP64 end record")
    shift = stop - length - start
    data, found, at = _at(f, start + shift, length), [], 0
    for _ in range(count):
        if data[at : at + 4] != b"PK\x01\x02":
            raise ValueError("broken ZIP directory")
        flags, method = struct.unpack("<HH", data[at + 8 : at + 12])
        crc, packed, full, n, m, k = struct.unpack("<IIIHHH", data[at + 16 : at + 34])
        header = struct.unpack("<I", data[at + 42 : at + 46])[0]
        raw = data[at + 46 : at + 46 + n]
        extra, i = data[at + 46 + n : at + 46 + n + m], 0
        while i + 4 <= len(extra):
            tag, width = struct.unpack("<HH", extra[i : i + 4])
            if tag == 1:  # only the fields that are full are here, in this order
                wide = io.BytesIO(extra[i + 4 : i + 4 + width])
                full = int.from_bytes(wide.read(8), "little") if full == 0xFFFFFFFF else full
                packed = int.from_bytes(wide.read(8), "little") if packed == 0xFFFFFFFF else packed
                header = int.from_bytes(wide.read(8), "little") if header == 0xFFFFFFFF else header
            i += 4 + width
        name = raw.decode("utf-8" if flags & 0x800 else "cp437")
        found.append(Member(name, method, crc, packed, full, header + shift))
        at += 46 + n + m + k
    return found


def stored_at(f, member: Member) -> int:
    """Offset of a stored member's bytes, from its local header."""
    if member.method != 0:
        raise ValueError(f"{member.name} is compressed; its records have no place of their own")
    local = _at(f, member.header, 30)
    if local[:4] != b"PK\x03\x04":
        raise ValueError("broken ZIP member")
    n, m = struct.unpack("<HH", local[26:30])
    return member.header + 30 + n + m


# --- records ----------------------------------------------------------------------------------------


def record(fields: dict[str, str], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items())
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Named fields (lower case) and block of one record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8").split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError("no WARC record")
    fields = {}
    for line in lines:
        k, _, v = line.partition(":")
        fields[k.strip().lower()] = v.strip()
    return fields, rest[: int(fields["content-length"])]


def _line(text: str | None) -> str:
    return " ".join((text or "").split())  # a field is one line


class _Archive:
    """One ZIP file being written, in one pass and without seeking."""

    def __init__(self, root: str):
        self.path = f"{root}/{uuid.uuid4().hex}.wacz"
        store, path = fs.FileSystem.from_uri(self.path)
        self.out = store.open_output_stream(path)
        self.zip = zipfile.ZipFile(_Forward(self.out), "w", zipfile.ZIP_STORED)
        self.member = self.zip.open(RECORDS, "w", force_zip64=True)
        self.size, self.index = 0, io.BytesIO()

    def add(self, row, date: str, level: int) -> None:
        payload = row._payload.encode("utf-8", "surrogatepass") if isinstance(row._payload, str) else b""
        http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {row._bytes}\r\n\r\n"
        name = f"<urn:uuid:{uuid.uuid4()}>"
        fields = {"WARC-Type": row._type, "WARC-Record-ID": name, "WARC-Date": date}
        if isinstance(row._url, str):
            fields["WARC-Target-URI"] = _line(row._url)
        if isinstance(row._key, str):
            fields["WARC-Page-ID"] = row._key
        fields["WARC-Payload-Digest"] = f"sha1:{row._digest}"
        fields["Content-Type"] = "application/http;msgtype=response"
        block = http.encode() + payload
        if row._type == "revisit":
            fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
            if isinstance(row._refers, str):
                fields["WARC-Refers-To-Page-ID"] = row._refers
        data = gzip.compress(record(fields, block), level, mtime=0)
        self.member.write(data)
        told = {"offset": str(self.size), "length": str(len(data)), "digest": f"sha1:{row._digest}", "recordId": name}
        line = f"{_line(row._url) or '-'} {date} {json.dumps({'filename': RECORDS.split('/')[1], **told})}\n"
        self.index.write(line.encode("utf-8", "surrogatepass"))
        self.size += len(data)

    def close(self) -> tuple[str, int]:
        self.member.close()
        with self.zip.open(INDEX, "w") as f:
            f.write(self.index.getvalue())
        self.zip.close()
        self.out.close()
        return self.path, self.size


class _Forward(io.RawIOBase):
    """Lets ``zipfile`` see a stream that only goes forward."""

    def __init__(self, out):
        self.out = out

    def writable(self) -> bool:
        return True

    def write(self, data) -> int:
        self.out.write(bytes(data))
        return len(data)


def write_archives(
    pages: DataFrame,
    *,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_revisit_bytes: int = 1000,
    date: str = "2000-01-01T00:00:00Z",
    archive_bytes: int = ARCHIVE_BYTES,
    level: int = 3,
    root: str | None = None,
) -> DataFrame:
    """Write one record per row; returns ``(path, bytes)`` of the archives, which is itself stored.

    Of rows with equal payloads of ``min_revisit_bytes`` or more, the one with the largest key is the response
    and the others are revisits without a payload. NULL payloads are empty; a NULL key counts as the smallest and
    leaves out its field, so a revisit of a response without a key names none. Rows that tie for the largest
    key have one response among them, the last one read; the input is read twice, so it should be a table.
    An empty table writes no archive.

    The payloads are shuffled once, beside one row per payload that occurs more than once; a payload that very
    many rows share is a skewed join, which adaptive execution splits. A task writes archives of about
    ``archive_bytes`` under names of its own; a repeated attempt writes others, and only those of the attempt
    that counts are in the result.
    """
    spark = pages.sparkSession
    root = root or staging_path(spark, "warc")
    body = F.coalesce(F.col(payload), F.lit("")).cast("binary")
    read = pages.select(
        F.col(key).alias("_key"),
        F.col(url).alias("_url"),
        F.col(payload).alias("_payload"),
        F.octet_length(body).cast("long").alias("_bytes"),
        F.sha1(body).alias("_digest"),
        F.monotonically_increasing_id().alias("_row"),
    )
    response = (
        read.where(F.col("_bytes") >= min_revisit_bytes)
        .groupBy("_digest")
        .agg(F.max(F.struct("_key", "_row")).alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    again = F.col("_first").isNotNull() & (F.col("_row") != F.col("_first._row"))
    # Keys travel as text, for pandas turns whole numbers beside NULLs into floating ones.
    told = read.join(response, "_digest", "left").select(
        F.col("_key").cast("string").alias("_key"),
        "_url",
        F.when(~again, F.col("_payload")).alias("_payload"),
        "_bytes",
        "_digest",
        F.when(again, "revisit").otherwise("response").alias("_type"),
        F.when(again, F.col("_first._key").cast("string")).alias("_refers"),
    )

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        store, path = fs.FileSystem.from_uri(root)
        store.create_dir(path, recursive=True)
        archive = None
        for batch in batches:
            for row in _rows(batch):
                archive = archive or _Archive(root)
                archive.add(row, date, level)
                if archive.size >= archive_bytes:
                    yield pd.DataFrame([archive.close()], columns=["path", "bytes"])
                    archive = None
        if archive:
            yield pd.DataFrame([archive.close()], columns=["path", "bytes"])

    return stage(told.mapInPandas(write, "path string, bytes long"), "archives")


def _rows(batch: pd.DataFrame) -> Iterator[SimpleNamespace]:
    columns = list(batch.columns)
    for values in zip(*(batch[c] for c in columns), strict=True):
        yield SimpleNamespace(**dict(zip(columns, values, strict=True)))


# --- reading ----------------------------------------------------------------------------------------


def _open(path: str):
    store, inner = fs.FileSystem.from_uri(path)
    f = store.open_input_file(inner)
    return f, f.size()


def read_index(archives: DataFrame) -> DataFrame:
    """Index lines of each archive: ``(path, member, at, length, digest)``, ``at`` in bytes of the ZIP file.

    Reads the directory and the index members only. One task per archive.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch["path"]:
                f, size = _open(path)
                with f:
                    members = {m.name: m for m in directory(f, size)}
                    starts = {n.split("/")[-1]: stored_at(f, m) for n, m in members.items() if n.startswith("archive/")}
                    for name, m in members.items():
                        if not name.startswith("indexes/"):
                            continue
                        data = _at(f, stored_at(f, m), m.size)
                        if zlib.crc32(data) != m.crc32:
                            raise ValueError(f"{path}: {name} is damaged")
                        data = gzip.decompress(data) if name.endswith(".gz") else data
                        lines = [json.loads(x[x.index(" {") :]) for x in data.decode("utf-8", "surrogatepass").splitlines()]
                        yield pd.DataFrame(
                            {
                                "path": path,
                                "member": [x["filename"] for x in lines],
                                "at": [starts[x["filename"]] + int(x["offset"]) for x in lines],
                                "length": [int(x["length"]) for x in lines],
                                "digest": [x["digest"] for x in lines],
                            }
                        )

    # A few archives per task at most, whatever the size of the list.
    parts = max(1, min(archives.count(), 10_000))
    listed = archives.repartition(parts, "path")
    return listed.mapInPandas(run, "path string, member string, at long, length long, digest string")


def read_records(index: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """The records that the index lines name, by range reads: one row per line, in any selection of lines.

    Returns ``(page_id, url, record_type, payload_bytes, payload_digest, refers_to, path, at[, payload])``. The
    payload of a response is checked against its digest; a revisit has none and takes the length from the
    headers that it keeps. Neighbouring records of an archive share a read.
    """
    fields = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, refers_to long, "
    fields += "path string, at long" + (", payload binary" if with_payload else "")
    names = [x.split()[0] for x in fields.split(", ")]

    def rows(part: pd.DataFrame) -> Iterator[tuple]:
        part = part.sort_values("at")
        path = part["path"].iloc[0]
        f, _ = _open(path)
        with f:
            data, start = b"", 0
            for at, length in zip(part["at"].tolist(), part["length"].tolist(), strict=True):
                if not start <= at <= at + length <= start + len(data):
                    data, start = _at(f, at, max(length, READ_BYTES)), at
                head, block = parse(gzip.decompress(data[at - start : at - start + length]))
                http, _, body = block.partition(b"\r\n\r\n")
                told = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length"))
                digest = head["warc-payload-digest"].removeprefix("sha1:")
                if head["warc-type"] == "response" and (len(body) != told or hashlib.sha1(body).hexdigest() != digest):
                    raise ValueError(f"{path}: the record at {at} is damaged")
                page, refers = head.get("warc-page-id"), head.get("warc-refers-to-page-id")
                row = (page and int(page), head.get("warc-target-uri"), head["warc-type"], told, digest)
                row = (*row, refers and int(refers), path, at)
                yield (*row, body) if with_payload else row

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, part in batch.groupby("path", sort=False):
                out: list[tuple] = []
                for row in rows(part):
                    out.append(row)
                    if len(out) == 2000:
                        yield _typed(out, names)
                        out = []
                if out:
                    yield _typed(out, names)

    return index.mapInPandas(run, fields)


def _typed(rows: list[tuple], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names, dtype=object)
    return out.astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64", "at": "int64"})


def list_archives(spark: SparkSession, folder: str) -> DataFrame:
    """``(path, bytes)`` of all archives below a folder that Spark can read."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.wacz").option("recursiveFileLookup", "true")
    return found.load(folder).select("path", F.col("length").alias("bytes"))
