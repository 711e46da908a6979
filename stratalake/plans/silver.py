"""Customers with credit products."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratalake import config
from stratalake.config import Lake, load_day
from stratalake.errors import JobFailed
from stratalake.functions.customer import (
    HASH_CHARS,
    TOP_INCOME_CLASS,
    age_years,
    hash_document,
    income_class,
    whole_number,
)
from stratalake.functions.amounts import amount
from stratalake.operators.joins import find_hot_keys, lookup_join
from stratalake.operators.profile import (
    marked_counts,
    megabytes,
    row_chars,
    sampled_row_chars,
    unparsed_marks,
)
from stratalake.schemas import LOAD_DATE, SILVER_COLUMNS
from stratalake.sinks.buckets import BucketLayout, layout_scan
from stratalake.sinks.runlog import RunLog, metrics_sink
from stratalake.sinks.tables import audit_slice, write_slices
from stratalake.sources.tables import slice_scan

CUSTOMER_INPUT = [
    "client_id", "cpf", "rg", "data_nascimento", "est_civil", "genero", "estado", "renda",
    "tp_cliente",
]
_KNOWN = "__known"
_CHARS = "__chars"
PRODUCT_INPUT = ["produto_id", "nome", "categoria", "limite_credito"]


@dataclass(frozen=True)
class JoinPlan:
    """How the lookups are joined, decided from their sizes and the counts of the keys."""

    broadcast_products: bool = False
    broadcast_customers: bool = False
    hot_customers: DataFrame | None = None
    hot_products: DataFrame | None = None


def customer_attributes(
    customers: DataFrame,
    as_of: date,
    salt: str = "",
    unparsed: str | None = TOP_INCOME_CLASS,
) -> DataFrame:
    """Derived customer columns, computed once per customer and not once per acquisition."""
    return customers.select(
        "client_id",
        hash_document(F.col("cpf"), salt).alias("num_doc"),
        "est_civil",
        age_years(F.col("data_nascimento"), as_of).alias("idade"),
        "tp_cliente",
        income_class(F.col("renda"), unparsed).alias("classe_renda"),
        "genero",
        "estado",
        "renda",
    )


def credit_products(products: DataFrame) -> DataFrame:
    """Products with a credit limit."""
    return products.where(F.col("limite_credito").isNotNull()).select(
        "produto_id", F.col("nome").alias("prod_contratado"), "categoria", "limite_credito"
    )


def credit_customers(
    acquisitions: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    as_of: date,
    plan: JoinPlan | None = None,
    *,
    salt: str = "",
    unparsed: str | None = TOP_INCOME_CLASS,
) -> DataFrame:
    """Acquisitions of products with a credit limit, with the attributes of their customer.

    An acquisition of an unknown product is dropped, one of an unknown customer stays with null
    attributes and the top income class. Products come first: that join drops rows, so fewer are
    shuffled to meet the customers. ``salt`` goes before each document that is hashed, ``unparsed`` is
    the class of null or malformed incomes.
    """
    plan = plan or JoinPlan()
    sold = acquisitions.select(
        F.col("cliente_id").alias("client_id"),
        "produto_id",
        F.col("valor_aquisicao").alias("valor_prod_contratado"),
    )
    with_product = lookup_join(
        sold,
        credit_products(products),
        "produto_id",
        "inner",
        hot=plan.hot_products,
        broadcast_lookup=plan.broadcast_products,
    )
    joined = lookup_join(
        with_product.drop("produto_id"),
        customer_attributes(customers, as_of, salt, unparsed).withColumn(_KNOWN, F.lit(True)),
        "client_id",
        "left",
        hot=plan.hot_customers,
        broadcast_lookup=plan.broadcast_customers,
    )
    known_class = F.when(F.col(_KNOWN), F.col("classe_renda")).otherwise(TOP_INCOME_CLASS)
    return joined.withColumn("classe_renda", known_class).select(
        *[name for name, _ in SILVER_COLUMNS]
    )


@dataclass(frozen=True)
class InputProfile:
    """Text size of the lookups, the join plan that follows from it, and the mean text of a row of each."""

    chars: int
    joins: JoinPlan
    row_chars: float


def profile_inputs(
    lake: Lake, acquisitions: DataFrame, customers: DataFrame, products: DataFrame, co_located: bool = False
) -> InputProfile:
    """Sizes of the lookups in one job; keys of the acquisitions only where a lookup is too large to broadcast.

    Customers that are ``co_located`` with the acquisitions need no count of keys.
    """

    def totals(df: DataFrame, name: str) -> DataFrame:
        return df.agg(
            F.lit(name).alias("input"),
            F.count(F.lit(1)).alias("n"),
            F.coalesce(F.sum(row_chars(df.schema)), F.lit(0)).alias("chars"),
        )

    parts = [totals(customers, "customers"), totals(products, "products")]
    rows = {row["input"]: row for row in reduce(DataFrame.unionByName, parts).collect()}
    # A customer is joined with the hash of the document added.
    customer_chars = rows["customers"]["chars"] + HASH_CHARS * rows["customers"]["n"]
    small_customers = customer_chars <= lake.broadcast_chars
    small_products = rows["products"]["chars"] <= lake.broadcast_chars

    def hot(small: bool, key: str, name: str) -> DataFrame | None:
        if small:
            return None
        keys = acquisitions.select(F.col(key).alias(name))
        return find_hot_keys(keys, name, lake.rows_per_task)

    return InputProfile(
        sum(row["chars"] for row in rows.values()),
        JoinPlan(
            broadcast_products=small_products,
            broadcast_customers=small_customers,
            hot_customers=hot(small_customers or co_located, "cliente_id", "client_id"),
            hot_products=hot(small_products, "produto_id", "produto_id"),
        ),
        sum(row["chars"] / max(row["n"], 1) for row in rows.values()),
    )


def co_located_parts(
    spark: SparkSession, lake: Lake, load_date: str, layouts: tuple[BucketLayout, BucketLayout]
) -> list[tuple[DataFrame, DataFrame, JoinPlan]]:
    """Acquisitions of a load date, the customers they meet, and how, from layouts of both by the customer.

    Buckets meet buckets without a shuffle. Acquisitions of hot customers meet those customers alone, which are
    broadcast up to ``Lake.broadcast_chars``; beyond that they are shuffled and salted.
    """
    sales, masters = layouts
    if (sales.key, masters.key) != ("cliente_id", "client_id") or sales.buckets != masters.buckets:
        raise ValueError("the layouts are by cliente_id and client_id, in the same number of buckets")
    if masters.split_hot:
        raise ValueError("customers are a lookup: their layout holds each key in its bucket")
    even, hot = layout_scan(spark, lake, sales, load_date)
    customers = layout_scan(spark, lake, masters, load_date)[0].select(CUSTOMER_INPUT)
    parts = [(even, customers.hint("merge"), JoinPlan())]
    if hot is not None:
        # At most rows/rows_per_task keys.
        keys = hot.select(F.col("cliente_id").alias("client_id")).distinct()
        met = customers.join(F.broadcast(keys), "client_id", "left_semi")
        small = (met.agg(F.sum(row_chars(met.schema))).first()[0] or 0) <= lake.broadcast_chars
        counted = None if small else find_hot_keys(hot.select(F.col("cliente_id").alias("client_id")), "client_id", lake.rows_per_task)
        parts.append((hot, met, JoinPlan(broadcast_customers=small, hot_customers=counted)))
    return parts


#: Columns of the silver rows that are read as numbers, and how.
_PARSED = {"renda": whole_number, "limite_credito": amount, "valor_prod_contratado": amount}


def silver_credit_customers(
    spark: SparkSession,
    lake: Lake,
    load_date: str,
    *,
    as_of: date | None = None,
    mode: str = "replace_slice",
    table: config.LakeTable = config.CREDIT_CUSTOMERS,
    customers_table: config.LakeTable = config.CUSTOMERS,
    products_table: config.LakeTable = config.PRODUCTS,
    acquisitions_table: config.LakeTable = config.ACQUISITIONS,
    salt: str = "",
    unparsed: str | None = TOP_INCOME_CLASS,
    layouts: tuple[BucketLayout, BucketLayout] | None = None,
) -> dict[str, object]:
    """Build the silver slice of one load date from the bronze slices of that date.

    ``layouts`` are copies of the acquisitions and the customers in buckets of the customer; customers too large to
    broadcast are then joined without a shuffle, as long as the products are small enough to broadcast.
    The three sources may be tables that arrivals fill. The acquisitions are read by the tasks of the join
    alone, which also count their text; values that do not parse as numbers are counted and logged.
    """
    run = RunLog("silver", table.name, load_date)
    try:
        with run.timed("load_total_time"):
            customers = slice_scan(spark, lake, customers_table, load_date, CUSTOMER_INPUT)
            products = slice_scan(spark, lake, products_table, load_date, PRODUCT_INPUT)
            acquisitions = slice_scan(spark, lake, acquisitions_table, load_date)
        found = profile_inputs(lake, acquisitions, customers, products, layouts is not None)
        parts = [(acquisitions, customers, found.joins)]
        if layouts and not found.joins.broadcast_customers:
            parts = co_located_parts(spark, lake, load_date, layouts)
        reads, built = [], []
        for sales, masters, joins in parts:
            reads.append(Observation())
            size = F.coalesce(F.sum(_CHARS), F.lit(0))
            if LOAD_DATE not in sales.columns:
                sales = sales.withColumn(LOAD_DATE, F.lit(load_date)).select(acquisitions.columns)
            sales = sales.withColumn(_CHARS, row_chars(acquisitions.schema))
            built.append(
                credit_customers(
                    sales.observe(reads[-1], size.alias("chars")),
                    masters,
                    products,
                    as_of or load_day(load_date),
                    replace(joins, broadcast_products=found.joins.broadcast_products, hot_products=found.joins.hot_products),
                    salt=salt,
                    unparsed=unparsed,
                )
            )
        # Once for each row in the generated code, and not in the aggregates that the write observes.
        rows = reduce(DataFrame.unionByName, built).withColumns(unparsed_marks(_PARSED))
        with run.timed("write_total_time"):
            totals = write_slices(
                spark,
                lake,
                table,
                rows,
                [load_date],
                mode,
                totals=marked_counts(_PARSED),
                rows_per_file=lake.rows_per_file(found.row_chars + sampled_row_chars(acquisitions)),
            )
        written = totals["rows"]
        run.set(data_size_mb_formatted=megabytes(found.chars + sum(read.get["chars"] for read in reads)))
        run.log_unparsed(totals, _PARSED)
        audit = audit_slice(spark, lake, table, load_date)
        run.set(
            qtd_total_rows_insert=written,
            qts_total_rows_insert_verify=audit.rows,
            num_columns_table=audit.columns,
            num_files=audit.files,
        )
        run.reconcile(written, audit.rows)
        metrics = run.finish()
    except Exception as error:
        run.finish(error)
        metrics_sink(spark, lake, run)
        raise JobFailed(f"silver build for {load_date} failed: {error}") from error
    metrics_sink(spark, lake, run)
    return metrics
