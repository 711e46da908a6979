"""Attributes derived for a customer."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bound of each income class; above the last comes the top class.
INCOME_CLASSES = [
    (521, "Classe E"),
    (1042, "Classe D"),
    (4427, "Classe C"),
    (8856, "Classe B"),
]
TOP_INCOME_CLASS = "Classe A"

# Fixed value: mean length of a year in days.
DAYS_PER_YEAR = 365.25

HASH_CHARS = 64
"""Length of a hashed document number."""

WHOLE = "decimal(38,0)"

_WHOLE_AND_FRACTION = r"^\s*(?<sign>[+-]?)(?<digits>[0-9]*)\.[0-9]*\s*$"


_NOT_WHOLE = r"[!-*,./:-~]"


def _tried(text: Column) -> Column:
    """``try_cast`` to a long. One that fails builds an error and drops it, so text with a printable ASCII character that
    is neither digit nor sign, which no long has, is kept from it."""
    return F.when(~text.rlike(_NOT_WHOLE), text.try_cast("long"))


def whole_number(text: Column) -> Column:
    """Text as an integer, fraction cut off; null when it is no plain decimal number.

    Most values are whole, so the expression that drops a fraction only runs after the plain
    cast has failed, and the one for numbers beyond 64 bits after both.
    """
    without_fraction = F.regexp_replace(text, _WHOLE_AND_FRACTION, "${sign}0${digits}")
    wide = F.when(without_fraction.rlike(r"^\s*[+-]?[0-9]+\s*$"), without_fraction.try_cast(WHOLE))
    return F.coalesce(_tried(text), _tried(without_fraction), wide)


def income_class(income: Column, unparsed: str | None = TOP_INCOME_CLASS) -> Column:
    """Class of an income given as text. ``unparsed`` is the class of null or malformed text."""
    amount = whole_number(income)
    bands = F.when(amount.isNull(), F.lit(unparsed))
    for upper, name in INCOME_CLASSES:
        bands = bands.when(amount <= upper, name)
    return bands.otherwise(TOP_INCOME_CLASS)


def age_years(birth: Column, as_of: date) -> Column:
    """Whole years from the birth date text to ``as_of``, as text."""
    days = F.datediff(F.lit(as_of), birth.try_cast("date"))
    return F.floor(days / F.lit(DAYS_PER_YEAR)).cast("string")


def hash_document(document: Column, salt: str = "") -> Column:
    """SHA-256 of a document number in hexadecimal; null stays null."""
    return F.sha2(F.concat(F.lit(salt), document) if salt else document, 256)
