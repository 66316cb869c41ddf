"""A data source for files that are one JSON array each: byte ranges in parallel, no task with a whole file.

A byte range does not know whether it starts inside a string, or how deep. A first pass therefore reads each range under both
assumptions and reports where either ends; folding these reports in order gives the true state at each range's start,
and how many objects of the array start before it. The reader then takes the objects that start in its range.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SPLIT_BYTES, CHUNK_BYTES = 64 << 20, 1 << 20
#: What matters to the structure: escapes, which hide a quote, then quotes and brackets.
_MARK = re.compile(rb'\\.|["{}\[\]]', re.DOTALL)


def _open(path: str):
    """A random-access file of any store that ``pyarrow.fs`` reaches."""
    store, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return store.open_input_file(name)


def _bytes(f, start: int, end: int) -> Iterator[bytes]:
    """Chunks of ``start .. end`` that end before no escaped byte: a trailing escape waits for the next chunk."""
    held, at = b"", start
    while at < end:
        f.seek(at)
        data = f.read(min(CHUNK_BYTES, end - at))
        if not data:
            break
        at += len(data)
        data = held + data
        odd = (len(data) - len(data.rstrip(b"\\"))) % 2
        held = data[-1:] if odd else b""
        yield data[:-1] if odd else data
    if held:
        yield held


def _escaped(f, start: int) -> bool:
    """Whether the byte at ``start`` follows an odd run of backslashes."""
    run, at = 0, start
    while at > 0:
        low = max(0, at - 4096)
        f.seek(low)
        data = f.read(at - low)
        own = len(data) - len(data.rstrip(b"\\"))
        run, at = run + own, at - own
        if own < len(data):
            break
    return run % 2 == 1


def scan(path: str, start: int, end: int, inside: bool) -> tuple[bool, int, int, Counter[int]]:
    """State at the end of a range that starts inside a string or not: ``(inside, depth, lowest, objects)``.

    Depths count from the range's start; ``objects`` has how many objects open at each of them.
    """
    depth = lowest = 0
    objects: Counter[int] = Counter()
    with _open(path) as f:
        first = start + _escaped(f, start)
        for chunk in _bytes(f, first, end):
            for m in _MARK.finditer(chunk):
                c = m[0]
                if c == b'"':
                    inside = not inside
                elif not inside and len(c) == 1:
                    if c in b"{[":
                        objects[depth] += c == b"{"
                        depth += 1
                    else:
                        depth -= 1
                        lowest = min(lowest, depth)
    return inside, depth, lowest, objects


@dataclass
class Range(InputPartition):
    """A byte range with the state at its start, and how many objects of the file come before it."""

    path: str
    rank: int
    start: int
    end: int
    size: int
    inside: bool
    depth: int
    first: int


def objects(r: Range) -> Iterator[tuple[int, int, str]]:
    """``(rank, pos, item)`` of the objects of the array that start in a range; the last may end behind it."""
    inside, depth, pos = r.inside, r.depth, r.first
    at, held, taken = r.start, None, b""
    with _open(r.path) as f:
        at += _escaped(f, r.start)
        for chunk in _bytes(f, at, r.size):
            begin = 0
            for m in _MARK.finditer(chunk):
                c = m[0]
                if c == b'"':
                    inside = not inside
                elif inside or len(c) != 1:
                    continue
                elif c in b"{[":
                    if c == b"{" and depth == 1:
                        if at + m.start() >= r.end:
                            return
                        held, taken, begin = pos, b"", m.start()
                        pos += 1
                    depth += 1
                else:
                    depth -= 1
                    if depth == 1 and held is not None:
                        yield r.rank, held, (taken + chunk[begin : m.end()]).decode("utf-8", "replace")
                        held = None
                        if at + m.end() >= r.end:
                            return
            at += len(chunk)
            if held is not None:
                taken += chunk[begin:]
            elif at >= r.end:
                return


class JsonArrayReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.ranges = [Range(**x) for x in json.loads(options["ranges"])]

    def partitions(self) -> Sequence[InputPartition]:
        return self.ranges

    def read(self, partition: Range) -> Iterator[tuple]:
        yield from objects(partition)


class JsonArraySource(DataSource):
    """Objects of JSON-array files as text; use :func:`read_json_array`, which finds the ranges."""

    @classmethod
    def name(cls) -> str:
        return "json_array"

    def schema(self) -> str:
        return "file_rank int, pos bigint, item string"

    def reader(self, schema) -> DataSourceReader:
        return JsonArrayReader(dict(self.options))


def _files(path: str) -> list[tuple[str, int]]:
    store, name = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    info = store.get_file_info(name)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    listed = [info] if info.is_file else store.get_file_info(fs.FileSelector(name))
    prefix = path[: len(path) - len(name)] if path.endswith(name) else ""
    return sorted((prefix + i.path, i.size) for i in listed if i.is_file and i.base_name[0] not in "._")


def find_ranges(spark: SparkSession, paths: Sequence[str], split_bytes: int = SPLIT_BYTES) -> list[Range]:
    """Byte ranges of all files with the state at their starts: one pass in parallel, one report per range to the driver.

    A file that is no whole array raises ``ValueError``. ``pos`` counts objects over all files in the given order.
    """
    rows = [
        (rank, path, start, min(start + split_bytes, size), size)
        for rank, given in enumerate(paths)
        for path, size in _files(given)
        for start in range(0, max(size, 1), split_bytes)
    ]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                both = [scan(r.path, r.start, r.end, inside) for inside in (False, True)]
                ends = json.dumps([[i, d, low, list(o.items())] for i, d, low, o in both])
                yield pd.DataFrame({"n": [r.n], "ends": [ends]})

    named = [(n, *r) for n, r in enumerate(rows)]
    if not named:
        return []
    asked = spark.createDataFrame(named, "n int, rank int, path string, start bigint, end bigint, size bigint")
    asked = asked.repartition(min(len(named), 10_000), "n")
    reports = {r["n"]: json.loads(r["ends"]) for r in asked.mapInPandas(run, "n int, ends string").collect()}
    found, before = [], 0
    inside, depth = False, 0
    for n, (rank, path, start, end, size) in enumerate(rows):
        if start == 0:
            inside, depth = False, 0
        found.append(Range(path, rank, start, end, size, inside, depth, before))
        ends_inside, change, lowest, opened = reports[n][inside]
        opened = dict(map(tuple, opened))
        if opened.get(-depth) or depth + lowest < 0:
            raise ValueError(f"{path} is not one JSON array")
        before += opened.get(1 - depth, 0)
        inside, depth = ends_inside, depth + change
        if end == size and (inside or depth):
            raise ValueError(f"{path} ends inside a JSON value")
    return found


def read_json_array(spark: SparkSession, paths: Sequence[str], split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """``(file_rank, pos, item)``: the objects of JSON-array files as text, other items left out.

    ``pos`` counts the objects of all files in order, whatever the ranges. A range and the rest of its last object are all
    that a task reads, and one object all that it holds.
    """
    ranges = find_ranges(spark, paths, split_bytes)
    if not ranges:
        return spark.createDataFrame([], JsonArraySource.schema(None))
    spark.dataSource.register(JsonArraySource)
    return spark.read.format("json_array").option("ranges", json.dumps([vars(r) for r in ranges])).load()
