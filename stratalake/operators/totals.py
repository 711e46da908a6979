"""Sums by product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from stratalake.functions.amounts import total_amount


def product_totals(
    sales: DataFrame, extra_keys: Sequence[str] = (), *others: Column
) -> DataFrame:
    """Contracted value and credit limit by product name.

    Products of one name are one row, unless ``extra_keys`` tell them apart. ``others`` are
    further aggregates. Each task sums its own rows before the shuffle, so a product with most of
    the rows costs no more than another.
    """
    return sales.groupBy("prod_contratado", *extra_keys).agg(
        total_amount(sales["valor_prod_contratado"]).alias("valor_total_prod_contratado"),
        total_amount(sales["limite_credito"]).alias("valor_total_limite_credito"),
        *others,
    )
