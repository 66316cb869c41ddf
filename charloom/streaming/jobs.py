"""The stateless recipes, counters, quotas and predictions on arriving files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import LongType, StructField, StructType

from charloom.functions.predicates import min_chars, non_blank
from charloom.operators.positions import group_stats, rank_window_filter
from charloom.operators.predict import NgramModel, fill_guesses
from charloom.plans.corpora import WEB_MIN_CHARS, capped_text

Recipe = Callable[[DataFrame], DataFrame]


def web_clean(df: DataFrame) -> DataFrame:
    """The row rules of the web recipe."""
    return capped_text(df.where(min_chars(F.col("text"), WEB_MIN_CHARS)))


def stream_clean(stream: DataFrame, path: str, checkpoint: str, recipe: Recipe = web_clean) -> StreamingQuery:
    """Clean whatever has arrived and append it to parquet files, then stop."""
    return (
        recipe(stream)
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def stream_split_counts(
    stream: DataFrame, english: Callable[[Column], Column], by: Sequence[str] = ("lang",)
) -> DataFrame:
    """Running counts for ``complete`` mode; one state row per group."""
    return (
        stream.where(non_blank(F.col("text")))
        .groupBy(*by, english(F.col("text")).alias("is_english"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def write_latest(counts: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Replace ``path/batch=N`` by the full counts of each batch; the last batch holds the result."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        counts.writeStream.outputMode("complete")
        .foreachBatch(save)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def latest_batch(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the last batch folder."""
    batches = spark.read.parquet(path)
    return batches.where(F.col("batch") == batches.agg(F.max("batch")).scalar()).drop("batch")


def stream_language_quota(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    quota: int,
    lang: str = "lang",
    pos: str = "pos",
) -> StreamingQuery:
    """Accept rows of each language in arrival order until its quota is full.

    A language may be most of the stream, so no task owns one: each batch takes what the earlier batches
    left of the quota by a rank cut-off. The state is a row per language and batch, counted from what the batch
    wrote; a replayed batch overwrites its own folders and reads only the counts of earlier ones.
    """
    kind = stream.schema[lang].dataType
    counts = StructType([StructField(f, t) for f, t in (("g", kind), ("count", LongType()), ("batch", LongType()))])

    def accept(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        by, key = F.col(lang), F.col(pos)
        taken: dict[object, int] = {}
        if batch_id > 0:
            earlier = spark.read.schema(counts).parquet(f"{path}/_taken").where(F.col("batch") < batch_id)
            taken = {r["g"]: r["n"] for r in earlier.groupBy("g").agg(F.sum("count").alias("n")).collect()}
        stats = group_stats(batch, by, key)
        spans = {g: (0, quota - taken.get(g, 0)) for g in stats}
        own = f"{path}/batch={batch_id}"
        rank_window_filter(batch, by, key, spans, stats).write.mode("overwrite").parquet(own)
        written = spark.read.schema(stream.schema).parquet(own).groupBy(by.alias("g")).count()
        written.coalesce(1).write.mode("overwrite").parquet(f"{path}/_taken/batch={batch_id}")

    return (
        stream.writeStream.foreachBatch(accept)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_answers(
    stream: DataFrame, model: NgramModel, fallback: str, when_empty: str, text: str = "text"
) -> DataFrame:
    """The arriving lines without their text, with ``pred``: stream-static joins and nothing else, so no state.

    A line is joined with the ranked characters of each of its suffixes, one left join per suffix length. The
    static side has one row per context. Contexts of one character are bounded by Unicode and broadcast, the empty context
    is one row and comes in as a literal; the others carry no hint, so the size of the model decides.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    others = [c for c in stream.columns if c != text]
    none = F.array().cast("array<string>")
    rows = stream.select(*others, F.right(value, F.lit(model.n - 1)).alias("_key"), (value == "").alias("_empty"))
    tops = []
    for o in range(model.n - 1, 0, -1):
        known = model.topk.where(F.length("ctx") == o).select(F.col("ctx").alias(f"_ctx{o}"), F.col("tops").alias(f"_tops{o}"))
        suffix = F.when(F.length("_key") >= o, F.right("_key", F.lit(o)))
        rows = rows.join(F.broadcast(known) if o == 1 else known, suffix == F.col(f"_ctx{o}"), "left")
        tops.append(F.coalesce(f"_tops{o}", none))
    base = model.topk.where("ctx = ''").select("tops").first()
    tops.append(F.array(*[F.lit(c) for c in base["tops"]]) if base else none)
    pred = F.when(F.col("_empty"), F.lit(when_empty)).otherwise(fill_guesses(F.concat(*tops), fallback))
    return rows.select(*others, pred.alias("pred"))


def stream_predict(
    stream: DataFrame,
    model: NgramModel,
    path: str,
    checkpoint: str,
    fallback: str,
    when_empty: str,
) -> StreamingQuery:
    """One guess per arriving line, appended to parquet files: a plain append query.

    The file sink logs what each batch has written, so a batch that runs again after a failure adds nothing twice.
    """
    return (
        stream_answers(stream, model, fallback, when_empty)
        .select("pos", "pred")
        .writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
