"""Corpus pipeline over ``documents``: toxic texts out, repeated lines out, near-duplicates out, mix, pack.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet and read again as
the next stage's ``docs``. All but the last return the columns of ``documents``.

NULL ids and sources and further columns of any name are values like others; an empty table gives an empty one. Texts that
are NULL or have no word are no duplicates of anything; they go at mixing, which takes words and finds none. Rows that
repeat both id and text are treated alike, so both dedup stages keep all of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from charloom.llm import line_dedup, minhash, mixing, packing, toxicity
from charloom.llm.common import table
from charloom.session import stage

#: Word shingles and similarity of near-duplicates in this pipeline.
SHINGLE_WORDS, SIMILARITY = 5, 0.8


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger does not reject (operator 10), as they are."""
    scored = toxicity.score_toxicity(docs, table(spark, sf_dir, "labels"))
    return scored.where("_predicted = 0").select(*docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their later repeated runs of lines (operator 4).

    A document of which nothing is left was a repeat altogether and goes; its length follows the text.
    """
    left = line_dedup.line_dedup(docs)
    kept = left.where(~((F.col("_removed") > 0) & (F.col("_removed") == F.col("_lines"))))
    length = F.when(F.col("_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return kept.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (operator 7), the one with the smallest id."""
    groups = minhash.near_duplicates(docs, words=SHINGLE_WORDS, threshold=SIMILARITY)
    going = groups.where(~F.col("kept")).select(F.col("doc_id").alias("_id"), F.col("_text")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & F.xxhash64("text").eqNullSafe(F.col("_text"))
    return docs.join(going, same, "left_anti").select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it (operator 3): not at all, or one to three times."""
    taken = mixing.mix(docs)
    times = F.when(F.col("_size") > 0, F.col("_taken") / F.col("_size")).otherwise(0).cast("int")
    return (
        taken.withColumn("_times", times)
        .where("_times > 0")
        .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times"))))
        .select(*docs.columns)
    )


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents with their sequence and their place in it (operator 2)."""
    return packing.pack_documents(docs.select("doc_id", "text"), with_ids=False)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", drop_near_duplicates),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: The tagger, near-dedup and packing are beyond SQL; the tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, step) in enumerate(STAGES):
        docs = step(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stage(docs, name)
    return docs
