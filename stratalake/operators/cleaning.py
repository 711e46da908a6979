"""Projections that clean a load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.text import null_marker_to_null, sql_name, trimmed_names


def _cleaned(field: T.StructField, markers: Sequence[str]) -> Column:
    if isinstance(field.dataType, T.StringType):
        return null_marker_to_null(field.name, markers)
    return F.col(sql_name(field.name))


def cleaned_columns(
    df: DataFrame, markers: Sequence[str] = ("NULL", "null")
) -> dict[str, Column]:
    """All columns by their trimmed names, null markers of text columns made null."""
    names = trimmed_names(df.columns)
    return {name: _cleaned(field, markers) for name, field in zip(names, df.schema.fields)}


def clean(df: DataFrame, markers: Sequence[str] = ("NULL", "null")) -> DataFrame:
    """Null markers and column names in one projection."""
    return df.select(*[c.alias(name) for name, c in cleaned_columns(df, markers).items()])


def null_markers_to_null(
    df: DataFrame, markers: Sequence[str] = ("NULL", "null")
) -> DataFrame:
    """Null markers of text columns made null, names kept."""
    return df.select(*[_cleaned(f, markers).alias(f.name) for f in df.schema.fields])


def trim_column_names(df: DataFrame) -> DataFrame:
    """Column names without outer white space; raises when two collide."""
    return df.toDF(*trimmed_names(df.columns))
