"""Text cleaning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratalake.errors import BadInput


def sql_name(name: str) -> str:
    """A column name as it stands in SQL, dots and spaces included."""
    return "`" + name.replace("`", "``") + "`"


def sql_text(text: str) -> str:
    """A single-quoted SQL literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def null_marker_to_null(name: str, markers: Sequence[str] = ("NULL", "null")) -> Column:
    """Null when the trimmed text of a column is one of the markers, otherwise the text as it was.

    Written as one SQL expression, since wide tables build it for each of their columns.
    """
    column, listed = sql_name(name), ", ".join(map(sql_text, markers))
    return F.expr(f"CASE WHEN trim({column}) IN ({listed}) THEN NULL ELSE {column} END")


def trimmed_names(names: Sequence[str]) -> list[str]:
    """Column names without outer white space; raises when two become the same.

    Spark resolves names without regard to case, so the comparison does too.
    """
    trimmed = [name.strip() for name in names]
    seen: dict[str, int] = {}
    for place, after in enumerate(trimmed):
        other = seen.setdefault(after.lower(), place)
        if other != place:
            raise BadInput(
                f"columns {names[other]!r} and {names[place]!r} have the same name once trimmed"
            )
    return trimmed
