"""Text normalisation as ``Column -> Column`` functions, shared by batch and stream plans."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# The 29 code points that count as whitespace, as characters and as a regex class.
WS_CHARS = "".join(
    chr(c)
    for lo, hi in (
        (0x09, 0x0D),
        (0x1C, 0x20),
        (0x85, 0x85),
        (0xA0, 0xA0),
        (0x1680, 0x1680),
        (0x2000, 0x200A),
        (0x2028, 0x2029),
        (0x202F, 0x202F),
        (0x205F, 0x205F),
        (0x3000, 0x3000),
    )
    for c in range(lo, hi + 1)
)
WS_RANGES = (
    r"\x{9}-\x{d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
# A single U+0020 is already in its final form, so the collapse pattern does not match it. The look-ahead
# turns most characters away with one range test.
_WS_TO_COLLAPSE = (
    r"(?![!-~])[\x{9}-\x{d}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
    rf"[{WS_RANGES}]*+|\x{{20}}[{WS_RANGES}]++"
)

# Characters that NFC never changes and that never join the character before them.
NFC_STABLE_RANGES = (
    r"\x{0}-\x{2ff}\x{400}-\x{482}\x{48a}-\x{52f}\x{2010}-\x{2027}\x{3001}-\x{3029}"
    r"\x{3041}-\x{3096}\x{30a1}-\x{30fa}\x{4e00}-\x{9fff}\x{ac00}-\x{d7a3}\x{ff01}-\x{ff5e}"
)

# Bytes of a batch that are Python strings at a time.
NFC_BYTES = 1 << 20

# Byte token ids start after the special ids.
BYTE_TOKEN_OFFSET = 4


def strip_ws(text: Column) -> Column:
    """Remove leading and trailing whitespace (all 29 code points, not only U+0020)."""
    return F.btrim(text, F.lit(WS_CHARS))


def collapse_ws(text: Column) -> Column:
    """Turn every whitespace run into one space and strip the ends."""
    return F.trim(F.regexp_replace(text, _WS_TO_COLLAPSE, " "))


def _composed(text: pa.Array) -> Iterator[pa.Array]:
    """A batch in NFC, in parts: about ``NFC_BYTES`` of it at a time become Python strings, however large it is."""
    # Not Arrow's own utf8_normalize: its NFC form leaves the letters taken apart.
    start = size = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)):
        size += int(n)
        if size >= NFC_BYTES or i + 1 == len(text):
            part = text.slice(start, i + 1 - start).to_pylist()
            yield pa.array([None if t is None else unicodedata.normalize("NFC", t) for t in part], pa.string())
            start, size = i + 1, 0


@F.arrow_udf(StringType())
def _nfc_batch(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for text in batches:
        yield from _composed(text)


def nfc(text: Column) -> Column:
    """Unicode NFC. Only values with a character that NFC could change travel to Python."""
    # Most Latin text ends at the first, cheap test.
    beyond_latin = text.rlike(r"[^\x{0}-\x{2ff}]")
    needs = F.when(beyond_latin & text.rlike(f"[^{NFC_STABLE_RANGES}]"), text)
    return F.coalesce(_nfc_batch(needs), text)


def cap_chars(text: Column, n: int = 8000) -> Column:
    """The first ``n`` code points."""
    return F.substring(text, 1, n)


def decode_utf8_lossy(data: Column) -> Column:
    """Bytes to text; every invalid sequence becomes U+FFFD."""
    return F.make_valid_utf8(data.cast("string"))


def concat_instruction_output(instruction: Column, output: Column) -> Column:
    """``instruction`` and ``output`` on one line; a missing side counts as empty."""
    return collapse_ws(F.concat_ws(" ", instruction, output))


def byte_tokens(text: Column) -> Column:
    """UTF-8 bytes as token ids."""
    pairs = F.regexp_extract_all(F.hex(text), F.lit(".."), F.lit(0))
    return F.transform(pairs, lambda p: F.conv(p, 16, 10).cast("int") + F.lit(BYTE_TOKEN_OFFSET))


def first_byte_tokens(text: Column, max_len: int = 2048, floor: int = 256) -> Column:
    """``truncate_tokens(byte_tokens(text))`` without making the tokens that would be cut off."""
    return byte_tokens(F.substring(F.encode(text, "UTF-8"), 1, max(floor, max_len)))


def token_byte(token: Column) -> Column:
    """The byte of a token id, NULL for ids that are not byte tokens."""
    byte = token - F.lit(BYTE_TOKEN_OFFSET)
    return F.when(byte.between(0, 255), byte)


def truncate_tokens(tokens: Column, max_len: int = 2048, floor: int = 256) -> Column:
    """At most ``max(floor, max_len)`` tokens."""
    return F.slice(tokens, 1, max(floor, max_len))


def fold_guess(line: Column, limit: int | None = 3) -> Column:
    """Lower-case first, then cut: the scorer's view of a line."""
    lowered = F.lower(line)
    return lowered if limit is None else F.substring(lowered, 1, limit)


def words(text: Column) -> Column:
    """Lower-case words of letters and digits; may hold empty strings at the ends."""
    return F.split(F.lower(text), r"[^\p{L}\p{N}]+")
