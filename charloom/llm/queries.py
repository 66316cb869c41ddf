"""The corpus operators as queries over the given tables: ``opN_<name>``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from charloom.llm import align, hnsw, itq, langcodes, line_dedup, minhash, mixing, packing, phrases, ppm, quality, toxicity, warc
from charloom.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


@query
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"),
        F.col("_target").alias("target"),
        F.col("_taken").alias("taken"),
    )


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.line_dedup(docs).select(
        "doc_id",
        F.col("_lines").cast("long").alias("n_lines"),
        F.col("_removed").cast("long").alias("n_removed"),
        "text",
    )


@query
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack_documents(docs, with_ids=False)


@query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    found = warc.read_records(warc.read_index(archives), with_payload=False)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return toxicity.score_toxicity(docs, table(spark, sf_dir, "labels")).select(
        "doc_id",
        F.col("_held_out").alias("held_out"),
        F.col("_score").alias("score"),
        F.col("_predicted").alias("predicted"),
        F.col("_spans").alias("spans"),
    )


@query
def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return minhash.near_duplicates(docs, words=2).drop("_text")


@query
def op9_ppm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_texts(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op5_hnsw_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hnsw.nearest(table(spark, sf_dir, "embeddings"))


@query
def op6_itq_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq.near_vectors(table(spark, sf_dir, "embeddings"))


@query
def op13_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.mine_phrases(table(spark, sf_dir, "documents").select("lang", "text"))


@query
def op11_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langcodes.identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))


@query
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align_tokens(table(spark, sf_dir, "documents").select("doc_id", "text"))
