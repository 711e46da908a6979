"""Totals by product kept up to date from batches, without reading a slice again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake import config
from stratalake.config import Lake, LakeTable
from stratalake.functions.amounts import amount
from stratalake.operators.joins import find_hot_keys, lookup_join
from stratalake.operators.profile import row_chars
from stratalake.plans.silver import credit_products
from stratalake.schemas import LOAD_DATE
from stratalake.sinks.tables import create_database, drop_partition, write_slices
from stratalake.sources.tables import slice_scan

BATCH = "lote"
"""Second partition column of the partial sums: the batch they are of."""

_SUM = T.DecimalType(38, 2)

PARTIALS = LakeTable(
    "g_vend",
    "prod_contrat_parciais",
    T.StructType([
        T.StructField("prod_contratado", T.StringType(), True, {"comment": "product bought"}),
        T.StructField("valor", _SUM, True, {"comment": "exact sum of the amounts"}),
        T.StructField("limite", _SUM, True, {"comment": "exact sum of the credit limits"}),
        T.StructField("linhas", T.LongType(), True, {"comment": "acquisitions summed"}),
        T.StructField(LOAD_DATE, T.StringType(), True, {"comment": "load date, yyyyMMdd"}),
        T.StructField(BATCH, T.StringType(), True, {"comment": "batch of arrivals"}),
    ]),
    partition_by=(LOAD_DATE, BATCH),
)


def partial_sums(lake: Lake, acquisitions: DataFrame, products: DataFrame) -> DataFrame:
    """Exact sums and row counts by product name of some acquisitions, for products with a credit limit.

    The products are broadcast where their text is small enough; else the hot ones are salted.
    """
    known = credit_products(products)
    chars = products.agg(F.sum(row_chars(products.schema)).alias("n")).first()["n"] or 0
    small = chars <= lake.broadcast_chars
    sold = acquisitions.select("produto_id", F.col("valor_aquisicao").alias("valor_prod_contratado"))
    hot = None if small else find_hot_keys(sold, "produto_id", lake.rows_per_task)
    joined = lookup_join(sold, known, "produto_id", "inner", hot=hot, broadcast_lookup=small)
    return joined.groupBy("prod_contratado").agg(
        F.sum(amount(F.col("valor_prod_contratado"))).cast(_SUM).alias("valor"),
        F.sum(amount(F.col("limite_credito"))).cast(_SUM).alias("limite"),
        F.count(F.lit(1)).alias("linhas"),
    )


def put_batch(
    spark: SparkSession,
    lake: Lake,
    load_date: str,
    batch: str,
    acquisitions: DataFrame,
    *,
    products_table: LakeTable = config.PRODUCTS,
) -> int:
    """Sum up one batch of a date's acquisitions and keep its sums; returns how many products it has.

    A batch that comes again replaces its own sums and no others, so it may be repeated. An empty batch takes its sums
    out. The sums hold as long as the products of the date do: a new slice of those needs every batch again.
    """
    create_database(spark, lake, PARTIALS.database)
    products = slice_scan(spark, lake, products_table, load_date)
    sums = partial_sums(lake, acquisitions, products)
    written = write_slices(spark, lake, PARTIALS, sums, [load_date], within={BATCH: batch})
    if not written["rows"]:
        drop_partition(spark, lake, PARTIALS, {LOAD_DATE: load_date, BATCH: batch})
    return written["rows"]


def merged_totals(partials: DataFrame) -> DataFrame:
    """Totals by product from partial sums, exact until the end."""
    return partials.groupBy("prod_contratado").agg(
        F.sum("valor").cast("double").alias("valor_total_prod_contratado"),
        F.sum("limite").cast("double").alias("valor_total_limite_credito"),
    )


def differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """By product, the signed difference of two sets of partial sums; products without one are left out.

    Added to the sums of ``before`` it gives those of ``after``: whoever keeps totals of their own need not read
    all batches when one is replaced.
    """

    def signed(rows: DataFrame, sign: int) -> DataFrame:
        return rows.select("prod_contratado", *[(F.col(c) * sign).alias(c) for c in ("valor", "limite", "linhas")])

    sums = signed(before, -1).unionByName(signed(after, 1)).groupBy("prod_contratado").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("valor", "limite", "linhas")]
    )
    return sums.where("valor <> 0 OR limite <> 0 OR linhas <> 0")


def refresh_totals(
    spark: SparkSession, lake: Lake, load_date: str, *, table: LakeTable = config.PRODUCT_TOTALS
) -> dict[str, object]:
    """Build the gold slice of a date from the partial sums of its batches: products times batches rows are read."""
    return write_slices(spark, lake, table, merged_totals(slice_scan(spark, lake, PARTIALS, load_date)), [load_date])

