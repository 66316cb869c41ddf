"""Row predicates as ``Column -> Column`` functions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from charloom.functions.text import NFC_STABLE_RANGES, WS_RANGES, nfc, strip_ws, words

# Register keys of interactive text, and the score that keeps a document.
CONVERSATIONAL_KEYS = ("ID", "IP", "IN")
CONVERSATIONAL_THRESHOLD = 0.2

NON_ASCII = r"[^\x{0}-\x{7f}]"


def non_blank(text: Column) -> Column:
    """At least one character that is not whitespace; the match stops at the first one."""
    return F.coalesce(text.rlike(f"[^{WS_RANGES}]"), F.lit(False))


def min_chars(text: Column, n: int) -> Column:
    """Stripped length of at least ``n`` code points.

    Looks for a character that is not whitespace ``n - 1`` or more places after the first such one, so it
    reads only as much of the text as it needs.
    """
    if n <= 1:
        return non_blank(text) if n == 1 else text.isNotNull()
    ink = f"[^{WS_RANGES}]"
    found = text.rlike(rf"(?s)\A[{WS_RANGES}]*+{ink}.{{{n - 2},}}?{ink}")
    return F.coalesce(found, F.lit(False))


def min_collapsed_chars(text: Column, n: int) -> Column:
    """At least ``n`` (one or more) code points once whitespace is collapsed, read the same way."""
    ink, gap = f"[^{WS_RANGES}]", f"[{WS_RANGES}]"
    unit = f"(?:{ink}|{gap}++(?={ink}))"
    return F.coalesce(text.rlike(rf"\A{gap}*+{ink}{unit}{{{n - 1}}}"), F.lit(False))


def min_nfc_chars(text: Column, n: int) -> Column:
    """Stripped NFC length of at least ``n`` code points.

    A character that NFC leaves alone stays a character, so ``n`` of those settle the question inside the
    JVM; only the remaining texts are normalised.
    """
    s = strip_ws(text)
    settled = s.rlike(rf"\A(?:[^{NFC_STABLE_RANGES}]*+[{NFC_STABLE_RANGES}]){{{n}}}")
    open_case = F.length(nfc(F.when(~settled, s))) >= n
    return F.coalesce(settled | open_case, F.lit(False))


def is_conversational(
    register: Column,
    threshold: float = CONVERSATIONAL_THRESHOLD,
    keys: Sequence[str] = CONVERSATIONAL_KEYS,
) -> Column:
    """Any of ``keys`` scores at least ``threshold``; a missing or empty register keeps the row."""

    def reaches(key: str) -> Column:
        score = register[key].try_cast("double")
        return F.coalesce(score >= F.lit(threshold), F.lit(False))

    keep = F.coalesce(F.size(register), F.lit(0)) <= 0
    for key in keys:
        keep = keep | reaches(key)
    return keep


def is_english_ascii(text: Column) -> Column:
    """Share of ASCII above 0.9; below three characters all of them must be ASCII."""
    s = strip_ws(text)
    n = F.length(s)
    other = F.regexp_count(s, F.lit(NON_ASCII))
    return F.when(n < 3, other == 0).otherwise((n - other) / n > F.lit(0.9))


def is_english(text: Column, detected: Column) -> Column:
    """The detector's verdict, with the exact rule for texts under three characters."""
    s = strip_ws(text)
    short = ~F.coalesce(s, F.lit("")).rlike(NON_ASCII)
    return F.when(F.coalesce(F.length(s), F.lit(0)) < 3, short).otherwise(
        F.coalesce(detected == "en", is_english_ascii(s))
    )


def printable_candidate(token: Column) -> Column:
    """The stripped token starts with neither a control character nor U+FFFD."""
    return strip_ws(token).rlike(r"\A[^\x{0}-\x{1f}\x{fffd}]")


def single_byte_candidate(byte: Column) -> Column:
    """Bytes that are a whole character and not a control character; 0x7F stays in."""
    return byte.between(32, 127)


def has_keyword(text: Column, keywords: Sequence[str]) -> Column:
    """The text holds one of ``keywords`` as a word. Decided inside the row: no join, no shuffle."""
    return F.arrays_overlap(words(text), F.array(*[F.lit(k.lower()) for k in keywords]))
