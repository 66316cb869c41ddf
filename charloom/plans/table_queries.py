"""Every operator as a query over the test tables.

Each callable takes ``(spark, sf_dir)``. The reading and writing operators first write the tables in the
format they handle and read that back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from charloom.functions import hooks
from charloom.functions import predicates as P
from charloom.functions import text as T
from charloom.operators import corpus, holdout, langid, ngrams, predict, quotas, scoring, smoothing, tokens, topics
from charloom.operators.positions import with_rank
from charloom.plans import corpora, modelling
from charloom.session import dealt, stage, staging_path
from charloom.sinks import committed
from charloom.sinks import lines as sinks
from charloom.sources import files
from charloom.streaming import jobs as streams
from charloom.streaming import quota_state

Query = Callable[[SparkSession, str], DataFrame]

LANGS = ["en", "es", "fr", "de"]
TOPIC_WORDS = ["module", "payload", "telemetry", "oxygen", "airlock", "retion", "belich", "thatin"]
#: Strings of varying length in the vocabulary of the token queries.
TOKEN_VOCABULARY = 300
#: Everyday phrases of the languages at hand, some within others.
TOPIC_PHRASES = {
    "place": ["in the", "on the", "at the", "in"],
    "origin": ["of the", "from the", "de la", "of"],
    "copula": ["it is", "is the", "el es", "elle est"],
}
TOPIC_WEIGHTS = {"place": 0.5, "origin": 0.25, "copula": 0.75}
MAX_TOTAL = 390
SHARD_TOTAL = 42
LEARNING_ROUNDS = 5
CHATS_PER_FILE = 1000
PAIRS = {"en-es": ("en", "es"), "fr-de": ("fr", "de")}

_QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    _QUERIES[f.__name__] = f
    return f


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


# --- inputs ---------------------------------------------------------------------------------------


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def docs(spark: SparkSession, sf: str) -> DataFrame:
    return dealt(table(spark, sf, "documents").select("doc_id", "lang", "source", "text"))


def corpus_rows(spark: SparkSession, sf: str) -> DataFrame:
    return docs(spark, sf).select(F.col("doc_id").alias("pos"), "lang", "source", "text")


def decomposed(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with some accented letters taken apart, so that NFC has work to do."""
    text = F.replace(F.col("text"), F.lit("\u00e9"), F.lit("e\u0301"))
    text = F.replace(text, F.lit("\u00fc"), F.lit("u\u0308"))
    return docs(spark, sf).withColumn("text", text)


def pair_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = corpus_rows(spark, sf)
    parts = [
        rows.where(F.col("lang").isin(*langs)).withColumn("pair", F.lit(pair))
        for pair, langs in PAIRS.items()
    ]
    return corpus.union_sources(parts)


def with_register(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with a register made from their labels; unlabelled ones have none."""
    labels = table(spark, sf, "labels").select("doc_id", "quality", "toxic")
    register = F.when(
        F.col("quality").isNotNull(),
        F.create_map(
            F.lit("ID"),
            (F.col("quality") * 0.5).cast("string"),
            F.lit("IP"),
            (F.col("toxic") * 0.1).cast("string"),
        ),
    )
    return (
        docs(spark, sf).join(labels, "doc_id", "left").withColumn("register", register)
    )


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    return (
        docs(spark, sf)
        .groupBy("lang", F.col("source").alias("shard"))
        .agg(F.min("doc_id").alias("pos"))
    )


def sharded(spark: SparkSession, sf: str) -> DataFrame:
    """Documents of the first two sources of each language as two shards."""
    chosen = quotas.select_shards(manifest(spark, sf), 2).select(
        "lang", F.col("shard").alias("source"), "shard_rank"
    )
    rows = with_register(spark, sf).join(chosen, ["lang", "source"])
    return rows.select(F.col("doc_id").alias("pos"), "lang", "shard_rank", "text", "register")


def instruction_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Each user turn with the assistant turn after it; without one the output is NULL."""
    turns = table(spark, sf, "conversations")
    asked = turns.where(F.col("role") == "user").select(
        "conv_id", "turn", F.col("text").alias("instruction")
    )
    answered = turns.where(F.col("role") == "assistant").select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("output")
    )
    return asked.join(answered, ["conv_id", "turn"], "left")


def instruction_pairs(spark: SparkSession, sf: str) -> DataFrame:
    rows = instruction_rows(spark, sf)
    ranks = with_rank(rows.select("conv_id", "turn"), [], ["conv_id", "turn"])
    return rows.join(ranks, ["conv_id", "turn"]).select("pos", "instruction", "output")


def answers(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """An answer key and guesses with gaps, both cut from the documents."""
    rows = corpus_rows(spark, sf)
    text, pos = F.col("text"), F.col("pos")
    gold = rows.select("pos", "lang", F.substr(text, (pos % 5 + 3).cast("int"), F.lit(1)).alias("gold"))
    pred = rows.where(pos % 5 != 0).select(
        "pos", F.substr(text, (pos % 7 + 1).cast("int"), F.lit(4)).alias("pred")
    )
    return gold, pred


def document_prompts(spark: SparkSession, sf: str) -> DataFrame:
    """A prompt of every document, blank ones too: each input line gets a guess."""
    rows = docs(spark, sf).select("doc_id", "lang", "text")
    return modelling.prompts(rows.withColumn("text", T.collapse_ws(F.coalesce("text", F.lit("")))))


def model_counts(spark: SparkSession, sf: str, n: int) -> DataFrame:
    return modelling.train_counts(docs(spark, sf), n)


def profiles(spark: SparkSession, sf: str) -> langid.LanguageProfiles:
    return langid.train_language_profiles(docs(spark, sf), LANGS)


# --- sources --------------------------------------------------------------------------------------


@query
def read_lines(spark, sf):
    path = staging_path(spark, "text")
    sinks.write_lines(docs(spark, sf).withColumn("text", T.collapse_ws(F.col("text"))), path, ["doc_id"])
    return files.read_lines(spark, path).select("pos", "text")


@query
def read_corpus_lines(spark, sf):
    path = staging_path(spark, "text")
    sinks.write_lines(docs(spark, sf), path, ["doc_id"], keep_breaks=True)
    return files.read_corpus_lines(spark, path).select("pos", "text")


@query
def read_jsonl_docs(spark, sf):
    path = staging_path(spark, "jsonl")
    rows = with_register(spark, sf)
    good = F.to_json(F.struct("text", F.col("register").alias("web-register")))
    number = F.to_json(F.struct(F.col("doc_id").alias("text")))
    kind = F.col("doc_id") % 10
    line = F.when(kind == 0, F.lit("{bad")).when(kind == 1, number).otherwise(good)
    rows.select(line.alias("value")).write.option("compression", "gzip").text(path)
    return files.read_jsonl_docs(spark, path).select(
        "text", F.col("register")["ID"].try_cast("double").alias("id_score")
    )


def _write_json(rows: DataFrame, path: str) -> None:
    """Rows as JSON lines in the order of their first two columns, which are left out."""
    order = rows.columns[:2]
    line = F.to_json(F.struct(*rows.columns[2:]), {"ignoreNullFields": "false"})
    sinks.write_lines(rows.select(*order, line.alias("text")), path, order)


def _conversation_items(spark: SparkSession, sf: str, path: str) -> DataFrame:
    turn = F.struct(F.col("role").alias("from"), F.col("text").alias("value"))
    chats = (
        table(spark, sf, "conversations")
        .groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(F.struct("turn", turn.alias("t")))).alias("turns"))
        .select(
            "conv_id",
            F.lit(0).alias("_"),
            F.col("conv_id").cast("string").alias("id"),
            F.transform("turns", lambda x: x["t"]).alias("conversations"),
        )
    )
    _write_json(chats, path)
    return files.read_conversation_json(spark, [path], lines=True)


@query
def read_conversation_json(spark, sf):
    rows = _conversation_items(spark, sf, staging_path(spark, "chat"))
    return rows.select(
        "pos", "id", T.strip_ws(corpus.flatten_turns(F.col("conversations"))).alias("text")
    )


@query
def read_conversation_array(spark, sf):
    """The conversations as JSON-array files, read in byte ranges; the numbers between the objects do not count."""
    turn = F.struct(F.col("role").alias("from"), F.col("text").alias("value"))
    turns = F.array_sort(F.collect_list(F.struct("turn", turn.alias("t"))))
    chats = table(spark, sf, "conversations").groupBy("conv_id").agg(F.transform(turns, lambda x: x["t"]).alias("conversations"))
    item = F.to_json(F.struct(F.col("conv_id").cast("string").alias("id"), "conversations"))
    ordered = F.array_sort(F.collect_list(F.struct("conv_id", item.alias("item"))))
    boxes = chats.groupBy(F.floor(F.col("conv_id") / CHATS_PER_FILE).alias("box")).agg(
        F.concat(F.lit("[0, "), F.array_join(F.transform(ordered, lambda x: x["item"]), ", 0, "), F.lit("]")).alias("value")
    )
    path = staging_path(spark, "arrays")
    stored = stage(boxes, "boxes")
    stored.repartition("box").write.partitionBy("box").text(path)
    names = [f"{path}/box={r['box']}" for r in stored.select("box").orderBy("box").collect()]
    rows = files.read_conversation_json(spark, names)
    return rows.select("pos", "id", T.strip_ws(corpus.flatten_turns(F.col("conversations"))).alias("text"))


@query
def read_instruction_pairs(spark, sf):
    path = staging_path(spark, "pairs")
    _write_json(instruction_rows(spark, sf).select("conv_id", "turn", "instruction", "output"), path)
    return files.read_instruction_pairs(spark, path)


@query
def read_parallel_text(spark, sf):
    folder = staging_path(spark, "sides")
    rows = docs(spark, sf)
    for side in LANGS:
        sinks.write_lines(rows.where(F.col("lang") == side), f"{folder}/pair.{side}", ["doc_id"])
    parts = [files.read_parallel_text(spark, folder, a, b) for a, b in (("en", "fr"), ("es", "de"))]
    return corpus.union_sources(parts).select("pair", "lang", "pos", "text")


@query
def read_language_configs(spark, sf):
    path = staging_path(spark, "configs")
    docs(spark, sf).write.partitionBy("lang").parquet(path)
    sources = {x: f"{path}/lang={x}" for x in ["en", "missing", "es", "fr", "de"]}
    rows = files.read_language_configs(spark, sources)
    return rows.groupBy("lang", "lang_rank").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.length("text")).alias("chars"),
        F.min("pos").alias("first_pos"),
        F.max("pos").alias("last_pos"),
        F.count_distinct("pos").alias("positions"),
    )


@query
def select_shards(spark, sf):
    return quotas.select_shards(manifest(spark, sf), 2).select("lang", "shard", "shard_rank")


@query
def concat_corpora(spark, sf):
    rows = docs(spark, sf)
    parts = [rows.where(F.col("lang") == x) for x in ("fr", "en", "de", "es")]
    return corpus.concat_corpora(parts).select("source_rank", "doc_id", "text")


# --- sinks ----------------------------------------------------------------------------------------


@query
def write_lines(spark, sf):
    path = staging_path(spark, "out")
    sinks.write_lines(docs(spark, sf), path, ["lang", "doc_id"])
    return files.read_lines(spark, path).select("pos", "text")


@query
def write_language_split(spark, sf):
    return sinks.write_language_split(docs(spark, sf), staging_path(spark, "split"), "docs", ["doc_id"])


@query
def write_split_manifest(spark, sf):
    """Rows, bytes and first and last document of each split, as the commit recorded them."""
    manifest = committed.write_language_split(docs(spark, sf), staging_path(spark, "split"), "docs", ["doc_id"])
    first, last = (F.get_json_object(c, "$.doc_id").cast("bigint") for c in ("first", "last"))
    return manifest.groupBy("split").agg(
        F.sum("rows").alias("n"),
        F.sum("bytes").alias("n_bytes"),
        F.min(first).alias("first_doc"),
        F.max(last).alias("last_doc"),
    )


@query
def write_predictions(spark, sf):
    path = staging_path(spark, "preds")
    _, pred = answers(spark, sf)
    pred = pred.withColumn("pred", F.translate("pred", "\r\n", "__"))
    committed.write_predictions(corpus_rows(spark, sf).select("pos"), pred, path, default="eta")
    return files.read_lines(spark, path).select("pos", F.col("text").alias("pred"))


@query
def write_if_absent(spark, sf):
    path = staging_path(spark, "once")
    rows = docs(spark, sf).select("doc_id", T.collapse_ws(F.col("text")).alias("text"))
    sinks.write_if_absent(rows, path, ["doc_id"])
    sinks.write_if_absent(rows.withColumn("text", F.lit("second")), path, ["doc_id"])
    return files.read_lines(spark, path).select("pos", "text")


# --- projections ----------------------------------------------------------------------------------


@query
def strip_ws(spark, sf):
    padded = F.concat(F.lit("\u3000\u00a0 \t"), F.col("text"), F.lit("\n\u2003 \x1f"))
    return docs(spark, sf).select("doc_id", T.strip_ws(padded).alias("text"))


@query
def collapse_ws(spark, sf):
    return docs(spark, sf).select("doc_id", T.collapse_ws(F.col("text")).alias("text"))


@query
def nfc(spark, sf):
    return decomposed(spark, sf).select("doc_id", T.nfc(F.col("text")).alias("text"))


@query
def cap_chars(spark, sf):
    return docs(spark, sf).select(
        "doc_id", T.cap_chars(T.collapse_ws(F.col("text")), 8000).alias("text")
    )


@query
def decode_utf8_lossy(spark, sf):
    broken = F.concat(F.encode("text", "UTF-8"), F.unhex(F.lit("FF")), F.encode("lang", "UTF-8"))
    return docs(spark, sf).select("doc_id", T.decode_utf8_lossy(broken).alias("text"))


@query
def concat_instruction_output(spark, sf):
    text = T.concat_instruction_output(F.col("instruction"), F.col("output"))
    return instruction_rows(spark, sf).select("conv_id", "turn", text.alias("text"))


@query
def byte_tokens(spark, sf):
    rows = docs(spark, sf)
    tokens = rows.select(F.explode(T.byte_tokens(F.col("text"))).alias("token"))
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


@query
def truncate_tokens(spark, sf):
    kept = docs(spark, sf).select(
        "doc_id", T.first_byte_tokens(F.col("text"), 1024, 256).alias("tokens")
    )
    return kept.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.element_at("tokens", -1).cast("bigint").alias("last_token"),
    )


@query
def next_char_pairs(spark, sf):
    pairs = ngrams.next_char_pairs(docs(spark, sf), 3, keep=["lang"])
    return pairs.groupBy("lang", "ch").agg(F.count(F.lit(1)).alias("n"))


@query
def fold_guess(spark, sf):
    return docs(spark, sf).select("doc_id", T.fold_guess(F.col("text")).alias("guess"))


# --- predicates -----------------------------------------------------------------------------------


@query
def non_blank(spark, sf):
    rows = docs(spark, sf).select("doc_id", F.explode(F.split("text", "\n")).alias("line"))
    return rows.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.count_if(P.non_blank(F.col("line"))).alias("n_non_blank"),
    )


@query
def min_chars(spark, sf):
    text = F.col("text")
    return docs(spark, sf).select(
        "doc_id",
        P.min_chars(text, corpora.WEB_MIN_CHARS).alias("web"),
        P.min_chars(text, corpora.ENCYCLOPEDIA_MIN_CHARS).alias("encyclopedia"),
    )


@query
def min_chars_after_nfc(spark, sf):
    rows = corpora.min_chars_after_nfc(decomposed(spark, sf), 20)
    return rows.select("doc_id", F.length("text").alias("chars"))


@query
def is_conversational(spark, sf):
    register = F.from_json("props", "map<string,string>")
    rows = table(spark, sf, "events").select(
        "event_type", P.is_conversational(register, 50.0, ["k"]).alias("keep")
    )
    return rows.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("keep").alias("n_keep")
    )


@query
def drop_malformed_json(spark, sf):
    cut = F.expr("substring(props, 1, length(props) - 1)")
    rows = table(spark, sf, "events").select(
        "event_type", F.when(F.col("event_id") % 7 == 0, cut).otherwise(F.col("props")).alias("value")
    )
    return files.drop_malformed_json(rows).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query
def is_english_ascii(spark, sf):
    return docs(spark, sf).select("doc_id", P.is_english_ascii(F.col("text")).alias("is_english"))


@query
def detect_language(spark, sf):
    rows = docs(spark, sf)
    return langid.detect_language(rows, profiles(spark, sf), "doc_id")


@query
def is_english(spark, sf):
    rows = docs(spark, sf)
    found = langid.with_detected_language(rows, profiles(spark, sf), "doc_id")
    verdict = P.is_english(F.col("text"), F.col("detected"))
    return found.groupBy("lang", verdict.alias("is_english")).agg(F.count(F.lit(1)).alias("n"))


@query
def printable_candidate(spark, sf):
    counts = ngrams.ngram_counts(docs(spark, sf), 1)
    return counts.where(P.printable_candidate(F.col("ch"))).select("ch", "cnt")


@query
def single_byte_candidate(spark, sf):
    byte = T.token_byte(F.col("token"))
    return (
        byte_tokens(spark, sf)
        .select(byte.cast("bigint").alias("byte"), "n")
        .where(P.single_byte_candidate(F.col("byte")))
    )


@query
def utf8_audit(spark, sf):
    return corpus.utf8_audit(docs(spark, sf), "lang")


@query
def domain_filter(spark, sf):
    return corpus.domain_filter(docs(spark, sf), TOPIC_WORDS).select("doc_id", "lang")


@query
def domain_weight(spark, sf):
    rows = corpus.domain_filter(docs(spark, sf), TOPIC_WORDS, mode="weight", weight=0.25)
    return rows.select("doc_id", "weight")


@query
def topic_hits(spark, sf):
    """Documents and occurrences per language and topic, for topics of several words."""
    found = topics.topic_hits(docs(spark, sf), TOPIC_PHRASES)
    return (
        found.select("lang", F.explode("topic_hits").alias("topic", "n"))
        .groupBy("lang", "topic")
        .agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_hits"))
    )


@query
def topic_weight(spark, sf):
    rows = topics.topic_filter(docs(spark, sf), TOPIC_PHRASES, mode="weight", weights=TOPIC_WEIGHTS)
    return rows.select("doc_id", "weight")


# --- joins ----------------------------------------------------------------------------------------


@query
def domain_semi(spark, sf):
    terms = spark.createDataFrame([(w,) for w in TOPIC_WORDS], "word string")
    return corpus.domain_semi(docs(spark, sf), terms, "doc_id").select("doc_id", "lang")


@query
def domain_anti(spark, sf):
    terms = spark.createDataFrame([(w,) for w in TOPIC_WORDS], "word string")
    return corpus.domain_anti(docs(spark, sf), terms, "doc_id").select("doc_id", "lang")


@query
def score_join(spark, sf):
    return scoring.score_join(*answers(spark, sf)).select("pos", "gold", "pred", "hit")


@query
def align_pairs(spark, sf):
    rows = corpus.align_pairs(pair_rows(spark, sf))
    return rows.select(
        "pair", "rank", "pos_1", "pos_2", F.length("text_1").alias("len_1"), F.length("text_2").alias("len_2")
    )


@query
def route_predict(spark, sf):
    inputs = document_prompts(spark, sf).withColumn("is_english", P.is_english_ascii(F.col("text")))
    rows = docs(spark, sf).withColumn("english", F.col("lang") == "en")
    sides = modelling.train_counts(rows, 4, by=["english"])
    english = predict.byte_model(sides.where("english"), 3)
    others = predict.token_model(sides.where("not english"), 3)
    return predict.route_predict(inputs, english, others).select("pos", "is_english", "pred")


@query
def ngram_backoff_lookup(spark, sf):
    topk = ngrams.ngram_topk(model_counts(spark, sf, 3))
    keys = document_prompts(spark, sf).select(F.right("text", F.lit(2)).alias("key"))
    found = ngrams.ngram_backoff_lookup(keys, topk, 3)
    return found.select("key", F.array_join("guesses", "").alias("guesses"))


# --- aggregations ---------------------------------------------------------------------------------


@query
def split_counts(spark, sf):
    return corpus.split_counts(docs(spark, sf))


@query
def split_counts_python(spark, sf):
    """The same operator with a plain Python detector."""
    return corpus.split_counts(docs(spark, sf), hooks.detector_from(str.isascii))


@query
def tokenize_batches(spark, sf):
    """A Python tokenizer over batches: the bytes of each text."""
    rows = docs(spark, sf).select("doc_id", "text")
    kept = hooks.tokenize_batches(rows, lambda texts: [t.encode() for t in texts], max_len=1024)
    return kept.select(
        "doc_id", F.size("tokens").cast("bigint").alias("n_tokens"), F.element_at("tokens", -1).cast("bigint").alias("last_token")
    )


@query
def line_count_non_blank(spark, sf):
    """A source is a file and its documents are the lines; each file loses its head."""
    filled = F.when(P.non_blank(F.col("text")), F.lit("x")).otherwise(F.lit(""))
    lines = corpus_rows(spark, sf).select(F.col("source").alias("file"), "pos", filled.alias("text"))
    numbered = with_rank(lines, ["file"], ["pos"], name="line")
    return corpus.line_count_non_blank(numbered, pos="line", skip_head=10)


@query
def pair_min_count(spark, sf):
    return quotas.pair_min_count(pair_rows(spark, sf))


@query
def token_batch_stats(spark, sf):
    return corpus.token_batch_stats(docs(spark, sf), "lang")


@query
def flatten_conversation(spark, sf):
    return corpus.flatten_conversation(table(spark, sf, "conversations"))


@query
def success_rate(spark, sf):
    rates = scoring.success_rate(scoring.score_join(*answers(spark, sf)), ["lang"])
    return rates.withColumn("success_rate", F.round("success_rate", 6))


@query
def top1_accuracy(spark, sf):
    rates = scoring.top1_accuracy(scoring.score_join(*answers(spark, sf)), ["lang"])
    return rates.withColumn("top1_accuracy", F.round("top1_accuracy", 6))


@query
def marginalise_first_char(spark, sf):
    counts = model_counts(spark, sf, 4)
    cands = predict.token_candidates(counts, 2, 2)
    rows = ngrams.marginalise_first_char(cands, ["ctx"])
    # Adding zero turns a rounded -0.0 into 0.0.
    return rows.select("ctx", "ch", (F.round("logprob", 6) + F.lit(0.0)).alias("logprob"))


def _document_tokens(spark: SparkSession, sf: str) -> DataFrame:
    chosen = tokens.token_vocabulary(model_counts(spark, sf, 4), TOKEN_VOCABULARY)
    return tokens.token_counts(docs(spark, sf), [r["token"] for r in chosen.collect()], 3)


@query
def token_vocabulary(spark, sf):
    return tokens.token_vocabulary(model_counts(spark, sf, 4), TOKEN_VOCABULARY)


@query
def token_counts(spark, sf):
    """Tokens by longest match after contexts of up to two characters."""
    return _document_tokens(spark, sf)


@query
def marginalise_tokens(spark, sf):
    """First characters after each context, summed over tokens of varying length."""
    counts = stage(_document_tokens(spark, sf), "tokens")
    rows = ngrams.marginalise_first_char(tokens.token_logprobs(counts), ["ctx"])
    return rows.select("ctx", "ch", (F.round("logprob", 6) + F.lit(0.0)).alias("logprob"))


@query
def ngram_counts_3(spark, sf):
    return ngrams.ngram_counts(docs(spark, sf), 3)


@query
def ngram_counts_5(spark, sf):
    return ngrams.ngram_counts(docs(spark, sf), 5)


def _probs(spark, sf, method):
    counts = model_counts(spark, sf, 3)
    size = ngrams.vocabulary_size(counts)
    probs = ngrams.ngram_probs(counts, 3, size, method)
    return probs.select("g", F.round("p", 6).alias("p"))


@query
def ngram_probs_addk(spark, sf):
    counts = model_counts(spark, sf, 3)
    gram = F.col("g")
    top = counts.where(F.length("g") == 3).select(
        ngrams.context(gram).alias("ctx"), ngrams.last_char(gram).alias("ch"), "cnt"
    )
    probs = ngrams.add_k_probs(top, ngrams.vocabulary_size(counts))
    return probs.select("ctx", "ch", F.round("p", 6).alias("p"))


@query
def ngram_probs_interp(spark, sf):
    return _probs(spark, sf, "interp")


@query
def ngram_probs_backoff(spark, sf):
    return _probs(spark, sf, "backoff")


@query
def ngram_probs_kneser_ney(spark, sf):
    """Seen grams of three characters under modified Kneser-Ney smoothing."""
    counts = model_counts(spark, sf, 3)
    model = smoothing.kneser_ney(counts, 3)
    probs = smoothing.kneser_ney_probs(model, counts.where(F.length("g") == 3))
    return probs.select("g", F.round("p", 6).alias("p"))


def learnt_weights(spark, sf, counts):
    """Weights of the orders, learnt on the benchmark texts in a set number of rounds."""
    held = ngrams.full_gram_counts(table(spark, sf, "benchmark"), 3)
    return smoothing.deleted_interpolation(held, counts, 3, rounds=LEARNING_ROUNDS, tolerance=-1)


@query
def interpolation_weights(spark, sf):
    """Learnt weight of each order (0: uniform) per bucket of evidence."""
    learnt = learnt_weights(spark, sf, model_counts(spark, sf, 3)).weights
    rows = [(b, o, w) for b, each in sorted(learnt.items()) for o, w in enumerate(each)]
    return spark.createDataFrame(rows, "bucket int, o int, weight double").withColumn("weight", F.round("weight", 6))


@query
def cross_entropy(spark, sf):
    """Loss of the benchmark texts under the model of the documents."""
    counts = model_counts(spark, sf, 3)
    held = stage(ngrams.full_gram_counts(table(spark, sf, "benchmark"), 3), "heldout")
    probs = ngrams.ngram_probs(
        counts, 3, ngrams.vocabulary_size(counts), "interp", queries=held
    )
    losses = ngrams.cross_entropy(held.join(probs, "g", "left"))
    return losses.select("n", F.round("loss", 6).alias("loss"))


# --- ranking --------------------------------------------------------------------------------------


@query
def language_quota(spark, sf):
    return quotas.language_quota(corpus_rows(spark, sf), LANGS, MAX_TOTAL).select("lang", "pos")


@query
def shard_budget_quota(spark, sf):
    q = quotas.quota_per_language(SHARD_TOTAL, len(LANGS))
    return quotas.shard_budget_quota(sharded(spark, sf), q, 2).select("lang", "shard_rank", "pos")


@query
def trim_from_top(spark, sf):
    return quotas.trim_from_top(pair_rows(spark, sf), cap=90).select("pair", "lang", "pos")


@query
def line_index(spark, sf):
    rows = with_rank(corpus_rows(spark, sf).select("source", "pos"), ["source"], ["pos"], name="line")
    return rows.select("source", "line", "pos")


@query
def topk_per_row(spark, sf):
    counts = ngrams.ngram_counts(docs(spark, sf), 3)
    return ngrams.topk_per_row(counts, ["ctx"], "cnt", [F.col("ch")], 3).select(
        "ctx", "ch", "cnt", "rank"
    )


# --- slices, hold-outs, mixing --------------------------------------------------------------------


@query
def global_cut(spark, sf):
    return quotas.global_cut(corpus_rows(spark, sf), LANGS, MAX_TOTAL).select("lang", "pos")


@query
def quota_and_cut(spark, sf):
    return quotas.quota_and_cut(corpus_rows(spark, sf), LANGS, MAX_TOTAL - 1).select("lang", "pos")


def gapped(spark: SparkSession, sf: str) -> DataFrame:
    """Every third document blank."""
    blank = F.when(F.col("pos") % 3 == 0, F.lit(" \t")).otherwise(F.col("text"))
    return corpus_rows(spark, sf).withColumn("text", blank)


@query
def slice_raw(spark, sf):
    return quotas.slice_raw(gapped(spark, sf), 50, 100).select("pos", "lang")


@query
def slice_non_blank(spark, sf):
    return quotas.slice_non_blank(gapped(spark, sf), 50, 100).select("pos", "lang")


@query
def head_lines(spark, sf):
    rows = corpus_rows(spark, sf).withColumnRenamed("lang", "file")
    return quotas.head_lines(rows, ["es", "de", "fr"], 200).select("file", "pos")


@query
def head_holdout(spark, sf):
    rows = holdout.head_holdout(gapped(spark, sf), 120).where(P.non_blank(F.col("text")))
    return rows.select("pos", "split")


@query
def random_holdout(spark, sf):
    return holdout.random_holdout(docs(spark, sf), "doc_id").select("doc_id", "split")


@query
def mix_sources(spark, sf):
    rows = docs(spark, sf)
    topical = corpus.domain_filter(rows, TOPIC_WORDS, mode="keep")
    general = rows.where(F.col("lang") == "en")
    mixed = holdout.mix_sources({"general": (general, 1.0), "topical": (topical, 0.3)}, "doc_id")
    return mixed.select("mix_source", "doc_id")


# --- sets and guesses -----------------------------------------------------------------------------


@query
def union_sources(spark, sf):
    documents = docs(spark, sf).select(F.col("text"), F.lit("documents").alias("origin"))
    items = table(spark, sf, "benchmark").select("text", F.lit("benchmark").alias("origin"))
    turns = table(spark, sf, "conversations").select("text", F.lit("conversations").alias("origin"))
    return corpus.union_sources([documents, items, turns]).groupBy("origin").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")
    )


@query
def fill_guesses(spark, sf):
    top = F.array_compact(
        F.array(*[F.when(F.length("text") > F.col("doc_id") % 3 + i, F.substring("text", i, 1)) for i in (1, 2)])
    )
    return docs(spark, sf).select(
        "doc_id",
        predict.fill_guesses(top, predict.TOKEN_FALLBACK).alias("token_path"),
        predict.fill_guesses(top, predict.BYTE_FALLBACK).alias("byte_path"),
    )


@query
def empty_input_guess(spark, sf):
    text = F.when(F.col("doc_id") % 4 == 0, F.lit("")).when(F.col("doc_id") % 4 == 1, F.lit(" "))
    text = text.otherwise(F.col("text"))
    guess = F.lit("xyz")
    return docs(spark, sf).select(
        "doc_id",
        predict.empty_input_guess(text, guess, predict.BYTE_EMPTY_GUESS).alias("byte_path"),
        predict.empty_input_guess(text, guess, predict.TOKEN_EMPTY_GUESS).alias("token_path"),
    )


# --- streams --------------------------------------------------------------------------------------


def document_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The documents as arriving files, whether the table is one file or a folder of them."""
    schema = table(spark, sf, "documents").schema
    return (
        spark.readStream.schema(schema)
        .parquet(f"{sf}/documents*.parquet")
        .select(F.col("doc_id").alias("pos"), "lang", "text")
    )


@query
def stream_clean(spark, sf):
    path = staging_path(spark, "stream")
    streams.stream_clean(document_stream(spark, sf), f"{path}/out", f"{path}/ckpt").awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query
def stream_split_counts(spark, sf):
    path = staging_path(spark, "stream")
    counts = streams.stream_split_counts(document_stream(spark, sf), P.is_english_ascii)
    streams.write_latest(counts, f"{path}/out", f"{path}/ckpt").awaitTermination()
    return streams.latest_batch(spark, f"{path}/out")


@query
def stream_language_quota(spark, sf):
    path = staging_path(spark, "stream")
    streams.stream_language_quota(
        document_stream(spark, sf), f"{path}/out", f"{path}/ckpt", 60
    ).awaitTermination()
    accepted = spark.read.parquet(f"{path}/out")
    return accepted.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_quota_state(spark, sf):
    """The accepted rows of the quota kept as keyed state."""
    path = staging_path(spark, "stream")
    rows = document_stream(spark, sf).select("pos", "lang")
    quota_state.stream_quota_state(rows, f"{path}/out", f"{path}/ckpt", 60).awaitTermination()
    return spark.read.parquet(f"{path}/out")


@query
def stream_predict(spark, sf):
    path = staging_path(spark, "stream")
    model = predict.NgramModel(stage(ngrams.ngram_topk(model_counts(spark, sf, 3)), "topk"), 3)
    rows = document_stream(spark, sf).select(
        F.col("pos").alias("doc_id"), "lang", T.collapse_ws(F.coalesce("text", F.lit(""))).alias("text")
    )
    prompts = modelling.prompts(rows)
    streams.stream_predict(
        prompts, model, f"{path}/out", f"{path}/ckpt", predict.BYTE_FALLBACK, predict.BYTE_EMPTY_GUESS
    ).awaitTermination()
    return spark.read.parquet(f"{path}/out").select("pos", "pred")


# --- jobs -----------------------------------------------------------------------------------------


@query
def job_web_corpus(spark, sf):
    return corpora.job_web_corpus(corpus_rows(spark, sf), LANGS, MAX_TOTAL).select("lang", "pos", "text")


@query
def job_encyclopedia_corpus(spark, sf):
    rows = corpora.job_encyclopedia_corpus(corpus_rows(spark, sf), LANGS, MAX_TOTAL)
    return rows.select("lang", "pos", "text")


@query
def job_clean_corpus(spark, sf):
    rows = decomposed(spark, sf).withColumnRenamed("doc_id", "pos")
    return corpora.job_clean_corpus(rows, LANGS, MAX_TOTAL).select("lang", "pos", "text")


@query
def job_register_corpus(spark, sf):
    rows = corpora.job_register_corpus(sharded(spark, sf), LANGS, SHARD_TOTAL)
    return rows.select("lang", "shard_rank", "pos", "text")


@query
def job_instruction_corpus(spark, sf):
    return corpora.job_instruction_corpus(instruction_pairs(spark, sf), 20, 100)


@query
def job_chat_corpus(spark, sf):
    return corpora.job_chat_corpus_long(table(spark, sf, "conversations"), 15, 90)


@query
def job_chat_corpus_read(spark, sf):
    """From the conversations file to the corpus: the reader numbers the items."""
    rows = _conversation_items(spark, sf, staging_path(spark, "chat"))
    return corpora.job_chat_corpus(rows, 15, 90)


@query
def job_instruction_corpus_read(spark, sf):
    path = staging_path(spark, "pairs")
    _write_json(instruction_rows(spark, sf).select("conv_id", "turn", "instruction", "output"), path)
    return corpora.job_instruction_corpus(files.read_instruction_pairs(spark, path), 20, 100)


@query
def job_pair_corpus(spark, sf):
    rows = corpus_rows(spark, sf).where(F.col("lang").isin("en", "es"))
    return corpora.job_pair_corpus(rows, ["es", "en"], 150).select("lang", "pos", "text")


@query
def job_pair_splits(spark, sf):
    rows = corpora.job_pair_splits(pair_rows(spark, sf), cap=90)
    return rows.select("pair", "split", "pos", "text")


@query
def job_pair_splits_written(spark, sf):
    rows = corpora.job_pair_splits(pair_rows(spark, sf), cap=90)
    return sinks.write_splits(rows, staging_path(spark, "splits"), ["pair", "lang", "pos"])


def detected_splits(spark: SparkSession, sf: str) -> DataFrame:
    rows = docs(spark, sf)
    pairs = [rows.where(F.col("lang").isin("en", "es")), rows.where(F.col("lang").isin("fr", "de"))]
    return corpora.job_detected_splits(pairs, profiles(spark, sf), "doc_id")


@query
def job_detected_splits_written(spark, sf):
    side = F.when(F.col("is_english"), F.lit("english")).otherwise(F.lit("non_english"))
    rows = detected_splits(spark, sf).withColumn("split", side)
    return sinks.write_splits(rows, staging_path(spark, "splits"), ["source_rank", "doc_id"])


@query
def job_detected_splits(spark, sf):
    split = detected_splits(spark, sf)
    return split.groupBy("source_rank", "is_english").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("text")).alias("chars")
    )


@query
def job_train_eval(spark, sf):
    return _evaluated(modelling.job_train_eval(docs(spark, sf)))


@query
def job_train_eval_head(spark, sf):
    """The same with the head of the corpus held out and interpolated probabilities."""
    return _evaluated(modelling.job_train_eval(docs(spark, sf), method="interp", eval_size=100))


@query
def job_train_eval_loss(spark, sf):
    """The same with a loss of the caller's own: the probability missed."""
    return _evaluated(modelling.job_train_eval(docs(spark, sf), loss=lambda p: F.lit(1.0) - p))


def _evaluated(rows: DataFrame) -> DataFrame:
    numbers = [F.round("loss", 6).alias("loss"), F.round("ppl", 5).alias("ppl"), F.round("accuracy", 6).alias("accuracy")]
    return rows.select("lang", "n", *numbers)


@query
def job_predict_grade(spark, sf):
    graded = modelling.job_predict_grade(docs(spark, sf), LANGS, staging_path(spark, "guesses"), 3)
    return graded.select("pos", "lang", "is_english", "gold", "pred", "hit")


@query
def heldout_success(spark, sf):
    return modelling.heldout_success(docs(spark, sf))


@query
def dense_success(spark, sf):
    return modelling.dense_success(docs(spark, sf))


@query
def dense_routed_success(spark, sf):
    """Every held-out position along the routed path, whose token side has tokens of varying length."""
    return modelling.dense_routed_success(docs(spark, sf), vocabulary=TOKEN_VOCABULARY)


@query
def perplexity(spark, sf):
    """Perplexity of the conversations under the interpolated model of the documents, per role."""
    counts = model_counts(spark, sf, 3)
    turns = table(spark, sf, "conversations")
    held = stage(ngrams.full_gram_counts(turns, 3, by=["role"]), "heldout")
    probs = ngrams.ngram_probs(
        counts, 3, ngrams.vocabulary_size(counts), "interp", queries=held
    )
    return _role_perplexity(held, probs)


def _role_perplexity(held, probs):
    rows = ngrams.perplexity(ngrams.cross_entropy(held.join(probs, "g", "left"), ["role"]))
    return rows.select("role", "n", F.round("loss", 6).alias("loss"), F.round("ppl", 5).alias("ppl"))


@query
def perplexity_kneser_ney(spark, sf):
    """The same under modified Kneser-Ney smoothing."""
    model = smoothing.kneser_ney(model_counts(spark, sf, 3), 3)
    held = stage(ngrams.full_gram_counts(table(spark, sf, "conversations"), 3, by=["role"]), "heldout")
    return _role_perplexity(held, smoothing.kneser_ney_probs(model, held))


@query
def perplexity_learnt_weights(spark, sf):
    """The same under interpolation with weights learnt on the benchmark texts."""
    counts = model_counts(spark, sf, 3)
    held = stage(ngrams.full_gram_counts(table(spark, sf, "conversations"), 3, by=["role"]), "heldout")
    return _role_perplexity(held, smoothing.interpolated_probs(counts, 3, learnt_weights(spark, sf, counts), held))
