"""Words, lines, trimming, masking and text formatting."""

from __future__ import annotations

import sys
from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Fixed values. UNICODE_WORD stands for Python's [\w']+ on str: Java's \w is
# ASCII only and (?U)\w also takes combining marks; ``words`` adds what the JVM
# does not know yet. SPACE is what str.isspace() accepts: Unicode white space
# and the four separators 1C-1F.
UNICODE_WORD = r"[\p{L}\p{N}_']+"
ASCII_WORD = r"[A-Za-z']+"
_PLAIN_WORD = r"[0-9A-Za-z_']+"
SPACE = r"[\s\x1c-\x1f]"
SHORT_WORD_LENGTH = 3
MASK = "[MASK]"


@lru_cache(maxsize=1)
def _newer_characters() -> str:
    """Word characters of this Python whose Unicode version the JVM does not know, as ranges of a class."""
    known = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isalnum())
    session = SparkSession.getActiveSession()
    jvm = session._jvm if session else None
    left = jvm.java.util.regex.Pattern.compile(r"[\p{L}\p{N}]").matcher(known).replaceAll("") if jvm else ""
    ranges: list[list[int]] = []
    for c in map(ord, left):
        if ranges and ranges[-1][1] == c - 1:
            ranges[-1][1] = c
        else:
            ranges.append([c, c])
    return "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in ranges)


def words(text: Column, pattern: str = UNICODE_WORD) -> Column:
    """Array of the words of a text; no word gives an empty array.

    With ``UNICODE_WORD`` a word is a run of what Python's ``\\w`` takes, in
    the Unicode version of the Python that makes the plan, and apostrophes.
    """
    if pattern != UNICODE_WORD:
        return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    full = UNICODE_WORD.replace("]+", f"{_newer_characters()}]+")
    # Most texts need the short class only.
    plain = F.regexp_extract_all(text, F.lit(_PLAIN_WORD), F.lit(0))
    return F.when(F.octet_length(text) == F.length(text), plain).otherwise(F.regexp_extract_all(text, F.lit(full), F.lit(0)))


def lines_of(text: Column) -> Column:
    """Array of the lines of a text."""
    return F.split(text, "\n")


def is_short(word: Column, limit: int = SHORT_WORD_LENGTH) -> Column:
    return F.length(word) <= limit


def strip(text: Column) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.regexp_replace(text, f"(?U)^{SPACE}+|{SPACE}+$", "")


def has_text(text: Column) -> Column:
    return text.rlike(r"(?U)[^\s\x1c-\x1f]")


def tokens(text: Column) -> Column:
    """White-space separated tokens; a blank text gives an empty array."""
    # Only white space at either end leaves an empty piece.
    return F.array_remove(F.split(text, f"(?U){SPACE}+"), "")


def mask_token(text: Column, keep_last: int = 1, mask: str = MASK) -> Column:
    """Replace the token before the last ``keep_last`` ones by ``mask``.

    White space between tokens collapses to one blank. A text with no token
    before the kept ones gets the mask put in front.
    """
    parts = tokens(text)
    head = F.slice(parts, F.lit(1), F.greatest(F.size(parts) - (keep_last + 1), F.lit(0)))
    kept = F.least(F.size(parts), F.lit(keep_last))
    tail = F.slice(parts, F.size(parts) - kept + 1, kept)
    return F.array_join(F.concat(head, F.array(F.lit(mask)), tail), " ")


def count_line(word: Column, count: Column) -> Column:
    """``word: count`` as text; a missing word is ``None``."""
    return F.concat(F.coalesce(word.cast("string"), F.lit("None")), F.lit(": "), count.cast("string"))


def whole_number(value: Column) -> Column:
    """A double as text without decimals, halves to even; no value is ``nan``."""
    value = value.cast("double")
    infinite = F.when(value > 0, "inf").otherwise("-inf")
    return (
        F.when(value.isNull() | F.isnan(value), "nan")
        .when(F.abs(value) == float("inf"), infinite)
        .otherwise(F.format_string("%.0f", F.bround(value, 0)))
    )


def decode(value: Column) -> Column:
    return F.decode(value, "UTF-8")


def encode(text: Column) -> Column:
    return F.encode(text, "UTF-8")
