"""The length of a value as the literal that would be written for it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Which characters a literal escapes, by the length of what stands for them.
_TWO = r"[\\\n\r\t]"
_FOUR = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\xA0\xAD]"
_SIX = r"[[\p{C}\p{Z}]&&[Ā-￿]]"
_TEN = r"[[\p{C}\p{Z}]&&[\x{10000}-\x{10FFFF}]]"
_ANY = r"[\\'\x00-\x1F\x7F-\xA0\xAD]|[[\p{C}\p{Z}]&&[^\x00-\xFF]]"


def quoted_length(text: Column) -> Column:
    """Length of a text as a quoted literal, escapes written out.

    Single quotes stand around it, double ones where it holds single quotes and no double ones; a single quote within
    single quotes, a backslash and \\n, \\r, \\t take two characters, other characters that do not print four, six or ten.
    Text without any of those, nearly all, is one match and its length.
    """

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern))

    quotes = F.when(text.contains('"'), count("'")).otherwise(0)
    longer = count(_TWO) + 3 * count(_FOUR) + 5 * count(_SIX) + 9 * count(_TEN) + quotes
    return F.length(text) + 2 + F.when(text.rlike(_ANY), longer).otherwise(0)
