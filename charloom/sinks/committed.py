"""Line files written under a commit protocol: what the tasks report is counted, nothing is read again.

A task writes below ``_pending-<job>`` under a name that no other attempt has, and its commit message carries files, rows,
bytes, first and last keys. Only the messages of attempts that Spark accepted reach the commit, so a retried or
speculative task counts once. The commit moves their files in place, then writes the manifest, then ``_SUCCESS``; an
output without ``_SUCCESS`` is unfinished.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from charloom.functions.predicates import is_english_ascii, non_blank
from charloom.functions.text import strip_ws
from charloom.session import stage
from charloom.sinks.lines import _in_order, one_line, path_exists

MANIFEST = "split string, file string, rows bigint, bytes bigint, first string, last string"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    """The store of a path, any that ``pyarrow.fs`` reaches, and the path in it."""
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


@dataclass
class Written(WriterCommitMessage):
    """The files of one task attempt, one for each split that it met: the rows of ``MANIFEST``."""

    files: list[dict] = field(default_factory=list)


class LinesWriter(DataSourceArrowWriter):
    """Rows ``(split, key, line)`` to one file a split and task."""

    def __init__(self, path: str, job: str):
        self.path, self.job = path.rstrip("/"), job

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, root = _store(self.path)
        task = TaskContext.get()
        attempt = f"{task.partitionId():06d}-{uuid.uuid4().hex}"
        sinks, entries = {}, {}
        try:
            for batch in iterator:
                split, key, line = (batch.column(i).to_pylist() for i in range(3))
                parts: dict[str, list[int]] = {}
                for i, s in enumerate(split):
                    parts.setdefault(s, []).append(i)
                for s, at in parts.items():
                    if s not in sinks:
                        folder = f"{root}/_pending-{self.job}/{s}"
                        store.create_dir(folder, recursive=True)
                        sinks[s] = store.open_output_stream(f"{folder}/{attempt}")
                        entries[s] = {"split": s, "file": attempt, "rows": 0, "bytes": 0, "first": key[at[0]]}
                    data = "".join(f"{line[i] or ''}\n" for i in at).encode("utf-8", "replace")
                    sinks[s].write(data)
                    entry = entries[s]
                    entry["rows"] += len(at)
                    entry["bytes"] += len(data)
                    entry["last"] = key[at[-1]]
        finally:
            for sink in sinks.values():
                sink.close()
        return Written(list(entries.values()))

    def commit(self, messages: list[Written | None]) -> None:
        store, root = _store(self.path)
        files = []
        for entry in (e for m in messages if m is not None for e in m.files):
            folder = f"{root}/split={entry['split']}" if entry["split"] else root
            name = f"part-{entry['file'].partition('-')[0]}-{self.job}.txt"
            store.create_dir(folder, recursive=True)
            store.move(f"{root}/_pending-{self.job}/{entry['split']}/{entry['file']}", f"{folder}/{name}")
            files.append(entry | {"file": f"split={entry['split']}/{name}" if entry["split"] else name})
        files.sort(key=lambda e: (e["split"], e["file"]))
        store.create_dir(f"{root}/_manifest", recursive=True)
        with store.open_output_stream(f"{root}/_manifest/files.json") as out:
            out.write("".join(json.dumps(e) + "\n" for e in files).encode())
        self._drop_pending(store, root)
        with store.open_output_stream(f"{root}/_SUCCESS"):
            pass

    def abort(self, messages: list[Written | None]) -> None:
        self._drop_pending(*_store(self.path))

    def _drop_pending(self, store: fs.FileSystem, root: str) -> None:
        """Remove what attempts left that were not accepted."""
        if store.get_file_info(f"{root}/_pending-{self.job}").type != fs.FileType.NotFound:
            store.delete_dir(f"{root}/_pending-{self.job}")


class CommittedLines(DataSource):
    """Sink of :func:`write_committed`."""

    @classmethod
    def name(cls) -> str:
        return "committed_lines"

    def schema(self) -> str:
        return "split string, key string, line string"

    def writer(self, schema, overwrite: bool) -> LinesWriter:
        return LinesWriter(self.options["path"], self.options["job"])


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per committed file: split, file, rows, bytes, first and last key as JSON."""
    return spark.read.schema(MANIFEST).json(f"{path.rstrip('/')}/_manifest")


def write_committed(
    df: DataFrame,
    path: str,
    order: Sequence[str],
    text: str = "text",
    split: Column | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """One sample per line in the given order, each split in a folder of its own; returns the manifest.

    ``path`` must not exist. Line breaks in a sample become spaces; NULL texts become empty lines and rows with a NULL
    split go without one. The rows that Spark observed on their way to the sink must be those of the manifest.
    An empty table gives an empty manifest.
    """
    spark = df.sparkSession
    if path_exists(df, path):
        raise FileExistsError(path)
    side = F.lit("") if split is None else F.coalesce(split, F.lit(""))
    rows = df.select(*order, side.alias("_split"), one_line(F.col(text)).alias("_line"))
    # Observed behind the exchange: the sample that its ranges are drawn from is evaluated apart and would count too.
    seen = Observation()
    ready = _in_order(rows, order, partitions).observe(seen, F.count(F.lit(1)).alias("rows"))
    key = F.to_json(F.struct(*order), {"ignoreNullFields": "false"})
    spark.dataSource.register(CommittedLines)
    ready.select(F.col("_split").alias("split"), key.alias("key"), F.col("_line").alias("line")).write.format(
        "committed_lines"
    ).mode("append").options(path=path, job=uuid.uuid4().hex).save()
    manifest = read_manifest(spark, path)
    committed = manifest.agg(F.sum("rows")).first()[0] or 0
    if committed != seen.get["rows"]:
        raise RuntimeError(f"{committed} rows committed of {seen.get['rows']} observed")
    return manifest


def write_predictions(
    inputs: DataFrame, preds: DataFrame, path: str, key: str = "pos", default: str = ""
) -> int:
    """One guess per input line in input order; fails unless as many lines as inputs were written.

    Inputs are counted while they meet their guesses, and lines by the manifest, so neither is read again. Only if
    the two differ are the inputs counted apart: a stage that Spark had to repeat is observed twice.
    """
    seen = Observation()
    asked = inputs.select(key).observe(seen, F.count(F.lit(1)).alias("rows"))
    rows = asked.join(preds.select(key, "pred"), key, "left")
    met = stage(rows.withColumn("pred", F.coalesce("pred", F.lit(default))), "predictions")
    written = write_committed(met, path, [key], text="pred").agg(F.sum("rows")).first()[0] or 0
    if written != seen.get["rows"]:
        expected = inputs.count()
        if written != expected:
            raise ValueError(f"{written} predictions written for {expected} inputs")
    return written


def write_language_split(
    df: DataFrame,
    directory: str,
    prefix: str,
    order: Sequence[str],
    english: Callable[[Column], Column] = is_english_ascii,
    text: str = "text",
) -> DataFrame:
    """English and non-English lines as two splits under the commit protocol; returns the manifest."""
    lines = df.where(non_blank(F.col(text))).withColumn(text, strip_ws(F.col(text)))
    side = F.when(english(F.col(text)), F.lit(f"{prefix}_english")).otherwise(F.lit(f"{prefix}_non_english"))
    return write_committed(lines, directory, order, text, split=side)
