"""Removing repeated runs of lines by winnowing over line hashes (operator 4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from charloom.llm.common import WORD, shield, unshield
from charloom.session import stage


def _trimmed(line: Column) -> Column:
    return F.btrim(line, F.lit(" \t\n\x0b\f\r"))


def _reach(counts: Column, min_words: int) -> Column:
    """Words and lines from the start of ``counts`` until ``min_words`` words are reached."""
    start = F.struct(F.lit(0).alias("sum"), F.lit(0).alias("n"))

    def step(acc: Column, words: Column) -> Column:
        more = F.struct((acc["sum"] + words).alias("sum"), (acc["n"] + 1).alias("n"))
        return F.when(acc["sum"] >= min_words, acc).otherwise(more)

    return F.aggregate(counts, start, step)


def _window(first: Column, n: Column) -> Column:
    """``(s, n, m)``: first line, number of lines, and the line whose hash is the least of the window."""
    part = F.slice("_hashes", first, n)
    least = first + F.array_position(part, F.array_min(part)).cast("int") - 1
    return F.struct(first.alias("s"), n.alias("n"), least.alias("m"))


def _winnow(cut: DataFrame, min_words: int) -> DataFrame:
    """The selected lines of each text: ``(_at, _print, _from, _context, _windows)``.

    ``cut`` has the hashes and word counts of a text's lines. A window is a smallest run with ``min_words`` words, from
    a line on (``_fwd``) or up to a line (``_bwd``); every line has a word at least, so none is longer than
    ``min_words`` lines. A window selects the first of its least hashes. A selected line is one row, with the lines
    that its windows reach over (``_context``, from line ``_from``) and those windows as ``(s, n)``.
    """
    at = F.sequence(F.lit(1), F.size("_words"))

    def ahead(i: Column) -> Column:
        return _reach(F.slice("_words", i, min_words), min_words)

    def behind(i: Column) -> Column:
        low = F.greatest(i - min_words + 1, F.lit(1))
        return _reach(F.reverse(F.slice("_words", low, i - low + 1)), min_words)

    def forward(r: Column, i: Column) -> Column:
        return F.when(r["sum"] >= min_words, _window(i + 1, r["n"]))

    def backward(r: Column, i: Column) -> Column:
        # Most runs up to a line are also the run from their own first line.
        first = i + 2 - r["n"]
        twice = F.element_at("_ahead", first)["n"] == r["n"]
        return F.when((r["sum"] >= min_words) & ~twice, _window(first, r["n"]))

    def selected(i: Column) -> Column:
        # The windows that hold line i start or end less than ``min_words`` lines away.
        low = F.greatest(i - min_words + 1, F.lit(1))
        before = F.slice("_fwd", low, F.least(i, F.size("_fwd")) - low + 1)
        after = F.slice("_bwd", i, F.least(F.lit(min_words), F.size("_bwd")))
        mine = F.filter(F.concat(before, after), lambda w: w["m"] == i)
        return F.struct(i.alias("at"), F.transform(mine, lambda w: F.struct(w["s"].alias("s"), w["n"].alias("n"))).alias("w"))

    def with_context(x: Column) -> Column:
        start = F.array_min(F.transform(x["w"], lambda w: w["s"]))
        end = F.array_max(F.transform(x["w"], lambda w: w["s"] + w["n"] - 1))
        return F.struct(
            x["at"].alias("_at"),
            F.element_at("_hashes", x["at"]).alias("_print"),
            start.alias("_from"),
            F.slice("_hashes", start, end - start + 1).alias("_context"),
            x["w"].alias("_windows"),
        )

    both = cut.withColumn("_ahead", F.transform(at, ahead)).withColumn("_behind", F.transform(at, behind))
    both = both.withColumn("_fwd", F.transform("_ahead", forward)).withColumn("_bwd", F.transform("_behind", backward))
    chosen = F.transform(F.concat("_fwd", "_bwd"), lambda w: w["m"])
    lines = F.array_distinct(F.filter(chosen, lambda m: m.isNotNull()))
    picked = both.withColumn("_picked", F.transform(F.transform(lines, selected), with_context))
    # ``explode`` would have the whole expression evaluated once more below, as a filter for texts with any selected line.
    placed = picked.select("_key", "_text", F.explode_outer("_picked").alias("_p"))
    return placed.where(F.col("_p").isNotNull()).select("_key", "_text", "_p.*")


def line_dedup(docs: DataFrame, *, key: str = "doc_id", text: str = "text", min_words: int = 50) -> DataFrame:
    """Delete each run of whole lines with ``min_words`` words or more that came before.

    A text is cut at line feeds; lines are compared without white space at their ends, and blank lines are no
    part of runs. Order: by key (NULL first), then by line. Of every repeated run the first place stays, in
    whichever document it is; later places lose the lines of the run, but for lines that belong to the first
    place itself when the two overlap. Shorter repeats stay.

    * *Winnowing.* Each smallest window of ``min_words`` words selects the line with the least hash. Neighbouring
      windows mostly select the same line, so only every few lines are stored. Two texts that share a run of that
      many words share a whole window, and so its selected line: a fingerprint that occurs at one place only rules
      out its windows, and most lines of a corpus go with that one count.
    * *Positions.* The places of a shared fingerprint are met by what surrounds them: one minimum per window with
      map-side combine, then a join back. A passage that a third of all documents share gives one row per place and
      window and no pairs, and a line that is frequent in itself matches nothing unless its surroundings agree.
    * *Extension.* A selected line is compared together with the lines before and after it, in every window that
      selected it. The windows reach forward from each line and backward to each line, so those of one match join up
      and cover all lines of its run, whatever its length; the lines of all of them are deleted together.

    Returns the columns of ``docs`` with the new text, and ``_lines`` and ``_removed`` (non-blank lines before,
    lines deleted). A changed text is its remaining lines joined by line feeds. NULL and empty texts stay as
    they are with 0 lines. Rows that repeat both key and text count as one place and are treated alike; rows that
    repeat the key alone are ordered by a hash of the text. Other columns pass through.
    """
    docs, moved = shield(docs, {"_digest", "_k", "_t", "_gone", "_pieces", "_filled"}, {"_lines", "_removed"})
    lines = F.filter(F.transform(F.split(F.col(text), "\n"), _trimmed), lambda x: x != "")
    digest = F.xxhash64(F.col(text))
    cut = (
        docs.select(F.col(key).alias("_key"), digest.alias("_text"), lines.alias("_all"))
        .where(F.size("_all") > 0)
        .withColumn("_words", F.transform("_all", lambda x: F.regexp_count(x, F.lit(WORD))))
        .withColumn("_hashes", F.transform("_all", lambda x: F.xxhash64(x)))
    )
    selected = stage(_winnow(cut, min_words), "fingerprints")
    # A fingerprint that has one place in the whole corpus rules out its windows.
    print_place = F.struct("_key", "_text", "_at")
    prints = (
        selected.groupBy("_print")
        .agg(F.min(print_place).alias("_first"), F.max(print_place).alias("_last"))
        .where(~F.col("_first").eqNullSafe(F.col("_last")))
        .select("_print")
    )
    # Two hashes of the window make a chance match of different windows as rare as with 96 bits.
    part = F.slice("_context", F.col("_w.s") - F.col("_from") + 1, F.col("_w.n"))
    windows = (
        selected.join(prints, "_print", "left_semi")
        .withColumn("_w", F.explode("_windows"))
        .select(
            "_key",
            "_text",
            F.col("_w.s").alias("_s"),
            F.col("_w.n").alias("_n"),
            F.xxhash64(part).alias("_h1"),
            F.hash(part).alias("_h2"),
        )
    )
    place = F.struct("_key", "_text", "_s")
    shared = (
        windows.groupBy("_h1", "_h2")
        .agg(F.min(place).alias("_first"), F.max(place).alias("_last"))
        .where(~F.col("_first").eqNullSafe(F.col("_last")))
        .select("_h1", "_h2", "_first")
    )
    met = windows.join(shared, ["_h1", "_h2"]).where(~place.eqNullSafe(F.col("_first")))
    same_doc = F.col("_key").eqNullSafe(F.col("_first._key")) & (F.col("_text") == F.col("_first._text"))
    start = F.when(same_doc, F.greatest(F.col("_s"), F.col("_first._s") + F.col("_n"))).otherwise(F.col("_s"))
    runs = (
        met.select("_key", "_text", start.alias("s"), (F.col("_s") + F.col("_n") - 1).alias("e"))
        .distinct()
        .groupBy("_key", "_text")
        .agg(F.collect_list(F.struct("s", "e")).alias("_runs"))
    )
    # Lines of all runs of one document, as a set of line numbers.
    gone = F.array_distinct(F.flatten(F.transform("_runs", lambda r: F.sequence(r["s"], r["e"]))))
    drops = runs.select(F.col("_key").alias("_k"), F.col("_text").alias("_t"), gone.alias("_gone"))
    joined = docs.withColumn("_digest", digest).join(
        drops, F.col(key).eqNullSafe(drops["_k"]) & (F.col("_digest") == drops["_t"]), "left"
    )
    # Columns of their own, so that no lambda below splits the text again for each line.
    joined = joined.withColumn("_pieces", F.split(F.col(text), "\n"))
    # Runs count non-blank lines; blank ones stay, so the numbers are carried over to all lines.
    full = F.transform("_pieces", lambda x, i: F.when(_trimmed(x) != "", i + 1))
    joined = joined.withColumn("_filled", F.filter(full, lambda i: i.isNotNull()))
    dropped = F.transform("_gone", lambda n: F.element_at("_filled", n))
    left = F.array_except(F.sequence(F.lit(1), F.size("_pieces")), dropped)
    kept = F.array_join(F.transform(left, lambda i: F.element_at("_pieces", i)), "\n")
    changed = F.when(F.col("_gone").isNull(), F.col(text)).otherwise(kept)
    count = F.when(F.col(text).isNull(), 0).otherwise(F.size("_filled"))
    out = joined.select(
        *[changed.alias(c) if c == text else F.col(c) for c in docs.columns],
        count.alias("_lines"),
        F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).alias("_removed"),
    )
    return unshield(out, moved)
