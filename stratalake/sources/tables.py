"""Readers of catalog tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.config import Lake, LakeTable
from stratalake.schemas import LOAD_DATE


def scan_table(spark: SparkSession, lake: Lake, table: LakeTable) -> DataFrame:
    return spark.table(table.full_name(lake))


def slice_of(df: DataFrame, load_date: str) -> DataFrame:
    """Rows of one load date. On a partitioned table only that partition is read."""
    return df.where(F.col(LOAD_DATE) == load_date)


def slice_scan(
    spark: SparkSession,
    lake: Lake,
    table: LakeTable,
    load_date: str,
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """One load date of a table, and only the columns asked for."""
    rows = slice_of(scan_table(spark, lake, table), load_date)
    return rows.select(*columns) if columns else rows
