"""Types of a load beside those of its table: which widen, which cast without loss, which are refused."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.text import sql_name

KEEP, CAST, WIDEN, CHECK = "keep", "cast", "widen", "check"

#: Decimal digits of whole numbers, from the narrowest type to the widest.
_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
_MOST_DIGITS = 38


@dataclass(frozen=True)
class Merge:
    """How a column of a load meets the stored one.

    ``keep``: one type. ``cast``: every value has its place in the stored type. ``widen``: the table takes ``kind``,
    which holds both. ``check``: values may be lost, so they are counted first.
    """

    action: str
    kind: T.DataType


def _digits(kind: T.DataType) -> tuple[int, int] | None:
    """Digits before and after the point that a type of exact numbers holds."""
    if isinstance(kind, T.DecimalType):
        return kind.precision - kind.scale, kind.scale
    found = _WHOLE.get(type(kind))
    return None if found is None else (found, 0)


def _exact(before: int, after: int) -> T.DataType | None:
    return T.DecimalType(before + after, after) if before + after <= _MOST_DIGITS else None


def merged(stored: T.DataType, incoming: T.DataType) -> Merge:
    """The place of a type in the order of types: whole numbers, then decimals that hold them; float below double;
    date below timestamp. Text holds a value of any plain type. Types with no common one above them are checked.
    """
    if stored == incoming:
        return Merge(KEEP, stored)
    if isinstance(stored, T.StringType) and isinstance(incoming, T.AtomicType):
        return Merge(CAST, stored)
    old, new = _digits(stored), _digits(incoming)
    if old and new:
        if type(stored) in _WHOLE and type(incoming) in _WHOLE:
            wider = max(stored, incoming, key=lambda k: _WHOLE[type(k)])
        else:
            wider = _exact(max(old[0], new[0]), max(old[1], new[1]))
        if wider == stored or (old[0] >= new[0] and old[1] >= new[1]):
            return Merge(CAST, stored)
        if wider is not None:
            return Merge(WIDEN, wider)
    if isinstance(stored, T.DoubleType) and (isinstance(incoming, T.FloatType) or (new and sum(new) <= 10)):
        return Merge(CAST, stored)
    if isinstance(stored, T.FloatType) and isinstance(incoming, T.DoubleType):
        return Merge(WIDEN, incoming)
    if isinstance(stored, T.TimestampType) and isinstance(incoming, T.DateType):
        return Merge(CAST, stored)
    return Merge(CHECK, stored)


def merges(stored: T.StructType, incoming: T.StructType) -> dict[str, Merge]:
    """The merge of every column both sides have, by its stored name."""
    known = {f.name.lower(): f for f in stored.fields}
    both = [(known[f.name.lower()], f) for f in incoming.fields if f.name.lower() in known]
    return {old.name: merged(old.dataType, new.dataType) for old, new in both}


def is_lost(name: str, kind: T.DataType) -> Column:
    """Whether a value does not come back from a type as it was: null there, or another value."""
    value = F.col(sql_name(name))
    there = value.try_cast(kind)
    text = F.trim(value.cast("string"))
    same = there.isNotNull()
    if _digits(kind):
        # Compared as numbers, so that 1.50 is 1.5 and 1.25 is no whole number.
        same &= F.coalesce(there == text.try_cast("decimal(38,10)"), F.lit(False))
    return value.isNotNull() & ~same


def lost_counts(rows: DataFrame, found: dict[str, Merge]) -> dict[str, int]:
    """How many values of each column to check would be lost, in one pass over those columns; none: no pass."""
    checks = {name: merge.kind for name, merge in found.items() if merge.action == CHECK}
    if not checks:
        return {}
    counts = rows.agg(*[F.count_if(is_lost(n, k)).alias(n) for n, k in checks.items()]).first().asDict()
    return {name: n for name, n in counts.items() if n}
