"""End-to-end corpus recipes. The order of the steps is part of each recipe.

Every recipe takes rows with a position and returns rows; ``charloom.sinks.lines`` writes them. Cuts are
counted on the cheap filters only, and the costly text functions run on the rows that survive them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from charloom.functions.predicates import (
    is_conversational,
    is_english,
    min_chars,
    min_nfc_chars,
    non_blank,
)
from charloom.functions.text import (
    cap_chars,
    collapse_ws,
    concat_instruction_output,
    decode_utf8_lossy,
    nfc,
    strip_ws,
)
from charloom.operators.corpus import concat_corpora, flatten_conversation, flatten_turns
from charloom.operators.langid import LanguageProfiles, with_detected_language
from charloom.operators.quotas import (
    PAIR_CAP,
    global_cut,
    head_lines,
    quota_and_cut,
    quota_per_language,
    shard_budget_quota,
    slice_non_blank,
    trim_from_top,
)
from charloom.session import stage

WEB_MIN_CHARS = 10
ENCYCLOPEDIA_MIN_CHARS = 20
CLEAN_MIN_CHARS = 2
TEXT_CAP = 8000


def _with_text(df: DataFrame, f: Callable[[Column], Column]) -> DataFrame:
    return df.withColumn("text", f(F.col("text")))


def capped_text(df: DataFrame) -> DataFrame:
    """NFC, one line, at most 8000 code points."""
    return _with_text(df, lambda t: cap_chars(collapse_ws(nfc(t)), TEXT_CAP))


def job_web_corpus(
    df: DataFrame, lang_order: Sequence[str], max_total: int = 200_000, shortest: int = WEB_MIN_CHARS
) -> DataFrame:
    """Length rule on the stripped raw text, quota and cut, then NFC, collapse and cap."""
    rows = df.where(min_chars(F.col("text"), shortest))
    return capped_text(quota_and_cut(rows, lang_order, max_total))


def job_encyclopedia_corpus(
    df: DataFrame, lang_order: Sequence[str], max_total: int = 200_000
) -> DataFrame:
    """The web recipe with the longer minimum."""
    return job_web_corpus(df, lang_order, max_total, ENCYCLOPEDIA_MIN_CHARS)


def min_chars_after_nfc(df: DataFrame, n: int = CLEAN_MIN_CHARS) -> DataFrame:
    """Stripped NFC text of at least ``n`` code points."""
    rows = df.where(min_nfc_chars(F.col("text"), n))
    return _with_text(rows, lambda t: nfc(strip_ws(t)))


def job_clean_corpus(
    df: DataFrame, lang_order: Sequence[str], max_total: int = 200_000
) -> DataFrame:
    """Length rule after NFC, no length cap. The cut is counted without normalising."""
    rows = df.where(min_nfc_chars(F.col("text"), CLEAN_MIN_CHARS))
    kept = quota_and_cut(rows, lang_order, max_total)
    return _with_text(kept, lambda t: collapse_ws(nfc(strip_ws(t))))


def job_register_corpus(
    docs: DataFrame,
    lang_order: Sequence[str],
    max_total: int = 100_000,
    shards: int = 2,
) -> DataFrame:
    """Parsed documents of the chosen shards under the shard budget; inner newlines stay.

    ``docs`` has ``lang, shard_rank, pos, text, register``. The budget is spent on parsed rows before the
    register filter, so a language may end below its quota. The cut goes by language order, then shard,
    then position. The few chosen shards are staged once, so they are not decompressed and parsed again
    for every count.
    """
    q = quota_per_language(max_total, len(lang_order))
    parsed = docs.where(F.col("lang").isin(list(lang_order)) & (F.col("shard_rank") <= shards))
    parsed = stage(_with_text(parsed.where(non_blank(F.col("text"))), strip_ws), "shards")
    keep = is_conversational(F.col("register")) & min_nfc_chars(F.col("text"), CLEAN_MIN_CHARS)
    kept = shard_budget_quota(parsed, q, shards, keep)
    unit = F.concat_ws("\x1f", "lang", F.col("shard_rank").cast("string"))
    order = [f"{lang}\x1f{s}" for lang in lang_order for s in range(1, shards + 1)]
    final = global_cut(kept.withColumn("_unit", unit), order, max_total, lang="_unit")
    return _with_text(final.drop("_unit"), nfc)


def job_instruction_corpus(df: DataFrame, offset: int = 0, n: int = 20_000) -> DataFrame:
    """A window of raw rows, both texts on one line, blank lines dropped."""
    pos = F.col("pos")
    window = df.where((pos >= offset) & (pos < offset + n))
    lines = window.select("pos", concat_instruction_output(F.col("instruction"), F.col("output")).alias("text"))
    return lines.where(non_blank(F.col("text")))


def job_chat_corpus(df: DataFrame, offset: int = 0, n: int = 20_000) -> DataFrame:
    """``(pos, text)`` from conversations in array form, ``pos`` dense over all raw rows."""
    lines = df.select("pos", flatten_turns(F.col("conversations")).alias("text"))
    return slice_non_blank(lines, offset, n)


def job_chat_corpus_long(
    df: DataFrame, offset: int = 0, n: int = 20_000, by: str = "conv_id", order: str = "turn"
) -> DataFrame:
    """The same from one row per turn, where ``by`` is the dense position of the conversation.

    Turns of skipped conversations go before they are joined.
    """
    lines = flatten_conversation(df.where(F.col(by) >= offset), by, order)
    return slice_non_blank(lines.withColumnRenamed(by, "pos"), 0, n)


def job_pair_corpus(
    df: DataFrame, file_order: Sequence[str], max_lines: int = 20_000, file: str = "lang"
) -> DataFrame:
    """Lossy decode, collapse, then the head over files in archive order."""
    lines = _with_text(df, lambda t: collapse_ws(decode_utf8_lossy(t)))
    return head_lines(lines.where(non_blank(F.col("text"))), file_order, max_lines, file=file)


def job_pair_splits(df: DataFrame, max_lines: int = 0, cap: int = PAIR_CAP) -> DataFrame:
    """All pairs trimmed from the top and tagged by the language of their file."""
    lines = df.where(non_blank(F.col("text")))
    kept = _with_text(
        trim_from_top(lines, max_lines, cap), lambda t: collapse_ws(decode_utf8_lossy(t))
    )
    return kept.withColumn(
        "split", F.when(F.col("lang") == "en", F.lit("english")).otherwise(F.lit("non_english"))
    )


def job_detected_splits(
    pairs: Sequence[DataFrame | None], profiles: LanguageProfiles, key: str
) -> DataFrame | None:
    """Concatenated pairs, stripped, split by the detector."""
    merged = concat_corpora(pairs)
    if merged is None:
        return None
    lines = _with_text(merged, strip_ws)
    # Positions restart in each corpus, so the corpus is part of the key.
    detected = with_detected_language(lines, profiles, ["source_rank", key])
    return detected.withColumn("is_english", is_english(F.col("text"), F.col("detected")))

