"""Readers for line files, JSON lines, conversations, pairs and per-language inputs."""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from charloom.functions.predicates import non_blank
from charloom.functions.text import decode_utf8_lossy, strip_ws
from charloom.operators.positions import with_rank
from charloom.session import stage
from charloom.sources.json_array import SPLIT_BYTES, read_json_array

log = logging.getLogger(__name__)

CONVERSATION_SCHEMA = "id string, conversations array<struct<`from`: string, value: string>>"
INSTRUCTION_SCHEMA = "instruction string, output string"


def read_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    mode: str = "text",
    per_file: bool = False,
    file: Column | None = None,
) -> DataFrame:
    """``(pos, file, text)``: one row per physical line.

    ``text`` mode also ends lines at a carriage return, ``bytes`` mode at a newline only. Files count in
    name order; ``per_file`` restarts ``pos`` in each. ``file`` names the input from its path when a folder
    of part files stands for one file. The lines are staged with their path, split and place, and ``pos`` is
    the place plus the lines of earlier splits: nothing is sorted, no task holds more than its split, and a
    lost executor cannot renumber anything.
    """
    reader = spark.read
    if mode == "bytes":
        reader = reader.option("lineSep", "\n")
    raw = reader.text(list(paths) if not isinstance(paths, str) else paths)
    placed = stage(
        raw.select(
            F.col("_metadata.file_path").alias("_path"),
            F.col("_metadata.file_block_start").alias("_split"),
            F.monotonically_increasing_id().alias("_place"),
            "value",
        ),
        "lines",
    )
    name = F.regexp_extract("_path", r"([^/]+)$", 1) if file is None else file
    splits = (
        placed.groupBy("_path", "_split")
        .agg(F.count(F.lit(1)).alias("_n"), F.min("_place").alias("_first"))
        .withColumn("file", name)
    )
    # One row per input split.
    w = Window.partitionBy("file").orderBy("_path", "_split")
    if not per_file:
        w = Window.orderBy("file", "_path", "_split")
    offsets = splits.withColumn("_before", F.sum("_n").over(w) - F.col("_n")).drop("_n")
    return placed.join(offsets, ["_path", "_split"]).select(
        (F.col("_before") + F.col("_place") - F.col("_first")).alias("pos"),
        "file",
        F.col("value").alias("text"),
    )


def read_corpus_lines(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``read_lines`` stripped and without blank lines; ``pos`` still counts physical lines."""
    lines = read_lines(spark, paths)
    return lines.where(non_blank(F.col("text"))).withColumn("text", strip_ws(F.col("text")))


def parse_json_docs(lines: DataFrame, value: str = "value") -> DataFrame:
    """Web documents from JSON text: ``text`` and ``register`` replace ``value``.

    Dropped: blank lines, malformed JSON, records whose ``text`` is missing, not a string or blank. A
    register that is not an object counts as missing.
    """
    line = F.col(value)
    doc = F.try_parse_json(line)
    others = [c for c in lines.columns if c != value]
    parsed = lines.where(non_blank(line)).select(
        *others,
        F.try_variant_get(doc, "$.text", "string").alias("text"),
        F.schema_of_variant(F.try_variant_get(doc, "$.text", "variant")).alias("_text_type"),
        F.try_variant_get(doc, "$['web-register']", "map<string,variant>").alias("_register"),
    )
    # Scores keep their JSON text so that numbers and numeric strings both work.
    register = F.transform_values("_register", lambda _, v: F.try_variant_get(v, "$", "string"))
    return parsed.where((F.col("_text_type") == "STRING") & non_blank(F.col("text"))).select(
        *others, strip_ws(F.col("text")).alias("text"), register.alias("register")
    )


def read_jsonl_docs(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``(pos, file, text, register)`` from JSON-lines shards, compressed or not.

    Invalid bytes are replaced before parsing. A compressed shard is one task, so supply many shards.
    ``pos`` counts physical lines per shard.
    """
    lines = read_lines(spark, paths, mode="bytes", per_file=True)
    decoded = lines.withColumn("value", decode_utf8_lossy(F.col("text"))).drop("text")
    return parse_json_docs(decoded)


def drop_malformed_json(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines that parse as JSON."""
    return lines.where(F.try_parse_json(F.col(value)).isNotNull())


def _turns(item: Column) -> list[Column]:
    """``id`` and ``conversations`` of an object; values that are not strings become NULL."""
    turns = F.try_variant_get(item, "$.conversations", "array<variant>")
    named = F.transform(
        F.filter(turns, lambda t: F.startswith(F.schema_of_variant(t), F.lit("OBJECT"))),
        lambda t: F.struct(*[_string_or_null(F.try_variant_get(t, f"$.{x}", "variant")).alias(x) for x in ("from", "value")]),
    )
    return [F.try_variant_get(item, "$.id", "string").alias("id"), named.alias("conversations")]


def read_conversation_json(
    spark: SparkSession, paths: Sequence[str], lines: bool = False, split_bytes: int = SPLIT_BYTES
) -> DataFrame:
    """``(pos, file_rank, id, conversations)`` from files given in order; ``pos`` counts their objects over all of them.

    Files are JSON arrays, read in byte ranges of ``split_bytes`` by the ``json_array`` source, or JSON lines (``lines=True``).
    Items that are no objects are left out and not counted; values and turns of another kind become NULL or are dropped. A file
    that is no whole array, and an object that does not parse, raise an error; of JSON lines, malformed ones are left out.
    """
    if not lines:
        items = read_json_array(spark, paths, split_bytes)
        broken = F.raise_error(F.concat(F.lit("malformed JSON object at position "), F.col("pos").cast("string")))
        sound = F.when(F.try_parse_json("item").isNull(), broken.cast("string")).otherwise(F.col("item"))
        parsed = items.select("pos", "file_rank", F.try_parse_json(sound).alias("_item"))
        return parsed.select("pos", "file_rank", *_turns(F.col("_item")))
    parts = [
        read_lines(spark, path).select("pos", F.lit(rank).alias("file_rank"), F.try_parse_json("text").alias("_item"))
        for rank, path in enumerate(paths)
    ]
    merged = reduce(lambda a, b: a.unionByName(b), parts).where(F.startswith(F.schema_of_variant("_item"), F.lit("OBJECT")))
    ranks = with_rank(merged.select("file_rank", "pos"), [], ["file_rank", "pos"], name="_n")
    return merged.join(ranks, ["file_rank", "pos"]).select(F.col("_n").alias("pos"), "file_rank", *_turns(F.col("_item")))


def _string_or_null(v: Column) -> Column:
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def read_instruction_pairs(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """``(pos, instruction, output)`` from JSON lines, both texts nullable; ``pos`` counts physical lines."""
    lines = read_lines(spark, path)
    return lines.select("pos", F.from_json("text", INSTRUCTION_SCHEMA).alias("_row")).select("pos", "_row.*")


def read_parallel_text(spark: SparkSession, directory: str, l1: str, l2: str) -> DataFrame:
    """``(pair, lang, file, pos, text)`` from ``*.{l1}`` and ``*.{l2}``, language from the suffix.

    A side is a file or a folder of part files. ``pos`` counts its lines; invalid bytes are replaced. Order
    the sides by name for the splits recipe or by any list for ``head_lines``.
    """
    side = F.regexp_extract("_path", rf"([^/]+\.(?:{l1}|{l2}))(?:/[^/]+)?$", 1)
    lines = read_lines(
        spark,
        [f"{directory}/*.{l1}", f"{directory}/*.{l2}"],
        mode="bytes",
        per_file=True,
        file=side,
    )
    return lines.select(
        F.lit(f"{l1}-{l2}").alias("pair"),
        F.regexp_extract("file", r"\.([A-Za-z_]+)$", 1).alias("lang"),
        "file",
        "pos",
        decode_utf8_lossy(F.col("text")).alias("text"),
    )


def read_language_configs(
    spark: SparkSession, sources: Mapping[str, str], fmt: str = "parquet"
) -> DataFrame | None:
    """Union of one parquet source per language, tagged ``lang``, ``lang_rank`` and ``pos``.

    ``pos`` counts a language's rows by file and place in it; it comes from the row numbers that the reader knows
    and one row per file, so no text is staged for it. A language whose source cannot be read is skipped with a warning and keeps its place in the order.
    None when no language can be read.
    """
    parts = []
    for rank, (lang, path) in enumerate(sources.items()):
        try:
            df = spark.read.format(fmt).load(path)
            df.schema  # resolve now, so that a missing source fails here
        except AnalysisException as e:
            log.warning("skipping %s: %s", lang, e.getMessage() if hasattr(e, "getMessage") else e)
            continue
        at = df.select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_row"))
        files = at.groupBy("_path").agg((F.max("_row") + 1).alias("_n"))
        before = F.sum("_n").over(Window.orderBy("_path")) - F.col("_n")
        numbered = at.join(files.select("_path", before.alias("_before")), "_path")
        numbered = numbered.withColumn("pos", F.col("_before") + F.col("_row")).drop("_path", "_row", "_before")
        parts.append(numbered.withColumn("lang", F.lit(lang)).withColumn("lang_rank", F.lit(rank)))
    return reduce(lambda a, b: a.unionByName(b), parts) if parts else None
