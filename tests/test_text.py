"""Text functions and predicates against plain definitions and fixture rows."""

from __future__ import annotations

import sys
import tracemalloc
import unicodedata

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from charloom.functions import predicates as P
from charloom.functions import text as T

SAMPLES = [
    "",
    " ",
    "  a\tb\n\nc  ",
    "　今天\u00a0\u2003天 气\u001f",
    "a\u200bb",
    " \u0085 ",
    "e\u0301tude",
    "か\u3099",
    "\u1112\u1161\u11ab",
    "\u1100\u1161",
    "\uac00\u11a8",
    "\u212b\u2126",
    "x" * 9,
    "x" * 10,
    "a" + " " * 18 + "b",
    "😀" * 8001,
    "a😀\n\r\n b",
    "abcdefghi" + "é",
    "abcdefghij" + "é",
    "\u0344",
    "\uf900",
]

texts = st.text(
    alphabet=st.one_of(
        st.sampled_from(list(T.WS_CHARS)),
        st.sampled_from(list("aé今😀e\u0301\u3099か\u1100\u1161\u11a8\u200b\ufffd")),
        st.characters(exclude_categories=["Cs"]),
    ),
    max_size=30,
)
batches = st.lists(texts, min_size=40, max_size=60)


def check(col, f, plain, values):
    got = col(f, values)
    assert got == [plain(v) for v in values]


def test_whitespace_is_what_python_strips():
    assert set(T.WS_CHARS) == {chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()}


CASES = {
    "strip_ws": (T.strip_ws, str.strip),
    "collapse_ws": (T.collapse_ws, lambda s: " ".join(s.split())),
    "nfc": (T.nfc, lambda s: unicodedata.normalize("NFC", s)),
    "cap": (lambda c: T.cap_chars(c, 8000), lambda s: s[:8000]),
    "bytes": (T.byte_tokens, lambda s: [4 + b for b in s.encode()]),
    "non_blank": (P.non_blank, lambda s: bool(s.strip())),
    "min_chars_10": (lambda c: P.min_chars(c, 10), lambda s: len(s.strip()) >= 10),
    "min_chars_2": (lambda c: P.min_chars(c, 2), lambda s: len(s.strip()) >= 2),
    "min_collapsed_6": (
        lambda c: P.min_collapsed_chars(c, 6),
        lambda s: len(" ".join(s.split())) >= 6,
    ),
    "min_nfc_2": (
        lambda c: P.min_nfc_chars(c, 2),
        lambda s: len(unicodedata.normalize("NFC", s.strip())) >= 2,
    ),
    "ascii": (
        P.is_english_ascii,
        lambda s: (
            s.strip().isascii()
            if len(s.strip()) < 3
            else sum(c < "\x80" for c in s.strip()) / len(s.strip()) > 0.9
        ),
    ),
    "printable": (
        P.printable_candidate,
        lambda s: bool(s.strip()) and ord(s.strip()[0]) >= 32 and s.strip()[0] != "\ufffd",
    ),
}


@pytest.mark.parametrize("name", CASES)
def test_samples(col, name):
    check(col, *CASES[name], SAMPLES)


@pytest.mark.parametrize("name", CASES)
@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(values=batches)
def test_generated(col, name, values):
    check(col, *CASES[name], values)


def test_stable_ranges_are_stable():
    import re

    stable = re.compile("[" + re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: f"\\U{m[1]:0>8}", T.NFC_STABLE_RANGES) + "]")
    seconds = set()
    for c in range(sys.maxunicode + 1):
        d = unicodedata.decomposition(chr(c))
        if d and not d.startswith("<") and len(d.split()) == 2:
            seconds.add(chr(int(d.split()[1], 16)))
    for c in range(sys.maxunicode + 1):
        if 0xD800 <= c <= 0xDFFF or not stable.match(chr(c)):
            continue
        assert unicodedata.normalize("NFC", chr(c)) == chr(c)
        assert unicodedata.combining(chr(c)) == 0
        assert chr(c) not in seconds


def test_length_rules(col):
    values = ["x" * 9, "x" * 10, "a" + " " * 18 + "b", "😀" * 8001]
    assert col(lambda c: P.min_chars(c, 10), values) == [False, True, True, True]
    assert col(lambda c: P.min_chars(c, 20), values) == [False, False, True, True]
    capped = col(lambda c: T.cap_chars(T.collapse_ws(c)), values)
    assert capped[2] == "a b"
    assert capped[3] == "😀" * 8000


def test_nfc_before_length(col):
    assert col(lambda c: P.min_nfc_chars(c, 2), ["e\u0301", "e\u0301x"]) == [False, True]
    assert col(lambda c: P.min_chars(c, 2), ["e\u0301"]) == [True]


def test_is_conversational(spark):
    rows = [
        (0, None, True),
        (1, {}, True),
        (2, {"ID": "0.2"}, True),
        (3, {"ID": "0.19", "IP": "0.1", "NA": "0.9"}, False),
        (4, {"ID": "abc", "IN": "0.5"}, True),
        (5, {"ID": None}, False),
    ]
    df = spark.createDataFrame(rows, "i int, r map<string,string>, want boolean")
    got = df.where(P.is_conversational(F.col("r")) != F.col("want")).count()
    assert got == 0


def test_decode_utf8_lossy(col):
    got = col(T.decode_utf8_lossy, [bytearray.fromhex("41FFE4B842C0AF"), bytearray(b"ok")], "binary")
    assert got == ["A\ufffd\ufffdB\ufffd\ufffd", "ok"]


def test_byte_tokens(col):
    assert col(T.byte_tokens, ["A", "é", ""]) == [[69], [199, 173], []]
    assert col(T.token_byte, [3, 4, 259, 260], "int") == [None, 0, 255, None]
    assert col(lambda c: F.size(T.truncate_tokens(T.byte_tokens(c), 10)), ["x" * 300]) == [256]


def test_concat_instruction_output(spark):
    df = spark.createDataFrame([(" a\n", None), (None, None), ("a", " b ")], "x string, y string")
    got = [r[0] for r in df.select(T.concat_instruction_output(F.col("x"), F.col("y"))).collect()]
    assert got == ["a", "", "a b"]


def test_fold_guess_lowers_before_it_cuts(col):
    assert col(T.fold_guess, ["xAyZ", "İab"]) == ["xay", "İab".lower()[:3]]
    assert col(lambda c: T.fold_guess(c, None), ["ABCDE"]) == ["abcde"]


def test_single_byte_candidates(col):
    assert col(P.single_byte_candidate, [31, 32, 127, 128], "int") == [False, True, True, False]


def test_has_keyword(col):
    values = ["The Module.", "modules", "x|oxygen|y", ""]
    assert col(lambda c: P.has_keyword(c, ["module", "oxygen"]), values) == [True, False, True, False]


def test_python_hooks(spark):
    from charloom.functions.hooks import detector_from, tokenize_batches
    from charloom.operators.corpus import split_counts

    df = spark.createDataFrame([(0, "abc"), (1, "é"), (2, " "), (3, None)], "id int, text string")
    got = {r["is_english"]: r["n"] for r in split_counts(df, detector_from(str.isascii)).collect()}
    assert got == {True: 1, False: 1}
    tokens = tokenize_batches(df, lambda texts: [t.encode() for t in texts])
    assert tokens.columns == ["id", "tokens"]
    assert [r["tokens"] for r in tokens.orderBy("id").collect()] == [[97, 98, 99], [195, 169], [32], []]
    long = spark.createDataFrame([("x" * 900,)], "text string")
    assert len(tokenize_batches(long, lambda texts: [t.encode() for t in texts], max_len=10).first()["tokens"]) == 256


def test_nfc_holds_a_small_part_of_a_batch_as_python_strings():
    """A batch may be thousands of long texts; its strings are made and dropped a part at a time."""
    texts = [None, "", "e\u0301", *["e\u0301\u4e00 " * 2000] * 1500, None]
    batch = pa.array(texts, pa.string())
    tracemalloc.start()
    got = [len(part) for part in T._nfc_batch.func(iter([batch, pa.array([], pa.string())]))]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(got) == len(texts) and len(got) > 10 and peak < batch.nbytes / 2
    parts = [t for part in T._nfc_batch.func(iter([batch])) for t in part.to_pylist()]
    assert parts == [None if t is None else unicodedata.normalize("NFC", t) for t in texts]


def test_nfc_of_batches_that_come_back_in_parts(spark):
    """Every row keeps its own text where a batch is answered in parts."""
    text = F.concat(F.repeat(F.lit("e\u0301"), F.lit(3000)), F.col("id"))
    rows = spark.range(0, 2000, 1, 2).select("id", F.when(F.col("id") % 5 > 0, text).alias("t"))
    got = rows.select("id", T.nfc(F.col("t")).alias("c")).collect()
    assert len(got) == 2000 and all(r["c"] == ("\u00e9" * 3000 + str(r["id"]) if r["id"] % 5 else None) for r in got)
