"""Money held as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EXACT = "decimal(28,2)"


def amount(text: Column) -> Column:
    """Text as an exact amount with two decimals, half up; null when malformed."""
    return text.try_cast(EXACT)


def total_amount(text: Column) -> Column:
    """Sum of amounts. Exact inside, so the result does not depend on the order of the rows."""
    return F.sum(amount(text)).cast("double")


def rounded(text: Column, decimals: int = 2) -> Column:
    """Text as a double with that many decimals."""
    return F.round(text.try_cast("double"), decimals)
