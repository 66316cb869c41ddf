"""Writers for line files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from charloom.functions.predicates import is_english_ascii, non_blank
from charloom.functions.text import strip_ws


def _in_order(df: DataFrame, order: Sequence[str], partitions: int | None) -> DataFrame:
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def one_line(text: Column) -> Column:
    """Line breaks become spaces, so that one row is one line."""
    return F.regexp_replace(text, r"\r\n|[\r\n]", " ")


def write_lines(
    df: DataFrame,
    path: str,
    order: Sequence[str],
    text: str = "text",
    mode: str = "errorifexists",
    keep_breaks: bool = False,
    partitions: int | None = None,
) -> None:
    """One sample per line in part files whose names follow the order; never one single file.

    ``keep_breaks`` writes samples with inner newlines as they are, several lines each.
    """
    value = F.col(text) if keep_breaks else one_line(F.col(text))
    _in_order(df.select(*order, value.alias("_line")), order, partitions).select(
        F.col("_line").alias("value")
    ).write.mode(mode).text(path)


def write_if_absent(df: DataFrame, path: str, order: Sequence[str], text: str = "text") -> bool:
    """Write unless ``path`` already holds a finished output; True when written.

    The check comes first, so an existing output costs no job.
    """
    if path_exists(df, f"{path}/_SUCCESS"):
        return False
    write_lines(df, path, order, text, mode="overwrite")
    return True


def path_exists(df: DataFrame, path: str) -> bool:
    jvm = df.sparkSession.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    conf = df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    return target.getFileSystem(conf).exists(target)


def write_language_split(
    df: DataFrame,
    directory: str,
    prefix: str,
    order: Sequence[str],
    english: Callable[[Column], Column] = is_english_ascii,
    text: str = "text",
) -> DataFrame:
    """English and non-English lines in ``split={prefix}_english`` / ``split={prefix}_non_english``.

    Returns ``(split, n)`` counted from the files written: accumulators of a job can count a retried
    task twice, the committed files cannot.
    """
    lines = df.where(non_blank(F.col(text)))
    side = F.when(english(F.col(text)), F.lit(f"{prefix}_english")).otherwise(F.lit(f"{prefix}_non_english"))
    tagged = lines.select(*order, side.alias("split"), strip_ws(F.col(text)).alias("text"))
    return write_splits(tagged, directory, order)


def write_splits(
    df: DataFrame, directory: str, order: Sequence[str], split: str = "split", text: str = "text"
) -> DataFrame:
    """The lines of each split in a folder of its own, in order; ``(split, n)`` counted from the files."""
    rows = df.select(*order, F.col(split).alias("split"), one_line(F.col(text)).alias("value"))
    _in_order(rows, order, None).select("split", "value").write.mode("errorifexists").partitionBy("split").text(
        directory
    )
    written = df.sparkSession.read.schema("value string, split string").text(directory)
    return written.groupBy("split").agg(F.count(F.lit(1)).alias("n"))
