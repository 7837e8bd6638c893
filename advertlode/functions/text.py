"""Text helpers shared by the parsers.

Regexes spell their character classes out instead of using the (?U) flag or a bare word boundary: what those mean has
changed between Java versions, and the results must not.
"""

from __future__ import annotations

import sys
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Every Unicode whitespace character, as text for trimming and as a class body for Java regexes.
WHITESPACE = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if c.isspace())
SPACE = r"[\s\x1C-\x1F\x85\p{Z}]"
DIGIT = r"\p{Nd}"
NOT_AFTER_WORD = r"(?<![\p{L}\p{N}_])"
NOT_BEFORE_WORD = r"(?![\p{L}\p{N}_])"

# Unicode decimal digits other than ASCII, and the ASCII digits they stand for.
_OTHER_DIGITS = "".join(c for c in map(chr, range(128, sys.maxunicode + 1)) if unicodedata.category(c) == "Nd")
_AS_ASCII = "".join(str(unicodedata.decimal(c)) for c in _OTHER_DIGITS)


def bind(value: Column, body) -> Column:
    """`body(value)` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Trim all Unicode whitespace from both ends."""
    return F.btrim(text, F.lit(WHITESPACE))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def digits_to_long(text: Column, drop: str) -> Column:
    """Text of digits in any script to BIGINT, ignoring the characters of `drop`; NULL when out of range."""
    return F.translate(text, _OTHER_DIGITS + drop, _AS_ASCII).try_cast("bigint")


def extract_all(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


@F.arrow_udf(StringType())
def _fold(texts: pa.Array) -> pa.Array:
    def fold(text):
        return "".join(c for c in unicodedata.normalize("NFKD", text) if unicodedata.category(c) != "Mn")

    return pa.array([None if t is None else fold(t) for t in texts.to_pylist()], pa.string())


def fold_accents(text: Column) -> Column:
    """Compatibility-decompose and drop combining marks.

    Spark has no Unicode normaliser, so this is an Arrow UDF; plain ASCII rows are sent as NULL and stay in the JVM.
    """
    ascii_only = text.rlike(r"^\p{ASCII}*\z")
    return F.coalesce(_fold(F.when(~ascii_only, text)), text)
