"""Text helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The characters that count as white space when a cell is trimmed.
WHITE_SPACE = (
    "\t\n\u000b\f\r \u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)


ASCII_BLANKS = [char for char in WHITE_SPACE if ord(char) < 128]
WIDE_BLANKS = [char for char in WHITE_SPACE if ord(char) >= 128]


def trim_cell(cell: Column) -> Column:
    """Both ends trimmed of every Unicode space, not only of U+0020."""
    return F.trim(cell, F.lit(WHITE_SPACE))


def plain_number(value: Column) -> Column:
    """A float as the shortest decimal text: ``42`` not ``42.0``, ``12345678`` not ``1.2345678E7``.

    Exponents appear from 1e21 upwards and below 1e-6.
    """
    text = value.cast("string")
    size = F.abs(value)
    # below 2**53 a double that equals its integer part is that integer
    whole = (size < 2.0**53) & (value == value.cast("bigint"))
    common = ((size >= 1e-3) & (size < 1e7)) | F.isnan(value) | (size == float("inf"))
    scientific = F.regexp_replace(F.regexp_replace(text, r"(\.0)?E", "e+"), r"e\+-", "e-")
    return (
        F.when(whole, value.cast("bigint").cast("string"))
        .when(common, text)
        .when((size >= 1e-6) & (size < 1e21), F.call_function("format_number", text.cast("double"), F.lit(_PLAIN)))
        .otherwise(scientific)
    )


def json_number(value: Column) -> Column:
    """``plain_number``, but whole numbers may keep their ``.0``; most values are only cast."""
    size = F.abs(value)
    return F.when((size >= 1e-3) & (size < 1e7), value.cast("string")).otherwise(plain_number(value))


# the shortest digits of a double need at most 17 + 6 places after the point here
_PLAIN = "0." + "#" * 23


def quoted(value: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(value, F.lit('"'), F.lit('""')), F.lit('"'))
