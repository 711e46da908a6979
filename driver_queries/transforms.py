"""Projections, filters, joins, sums and scalar functions."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from driver_queries import views
from driver_queries.registry import query
from driver_queries.views import CUSTOMER_NAMES, FIRST
from stratalake.config import LOAD_ZONE, Lake, load_day
from stratalake.functions.amounts import amount, rounded
from stratalake.functions.customer import (
    DAYS_PER_YEAR,
    age_years,
    hash_document,
    income_class,
    whole_number,
)
from stratalake.functions.dates import load_date_text
from stratalake.operators.cleaning import null_markers_to_null, trim_column_names
from stratalake.operators.joins import find_hot_keys, lookup_join
from stratalake.operators.profile import data_size, null_counts, row_count
from stratalake.operators.totals import product_totals
from stratalake.plans.silver import (
    CUSTOMER_INPUT,
    PRODUCT_INPUT,
    credit_customers,
    profile_inputs,
)

AS_OF = load_day(FIRST)
_LAKE = Lake(root="", stage_root="")  # only its limits are used here

SQL_WHOLE_INCOME = "trunc(TRY_CAST(renda AS DECIMAL(20,4)))"
SQL_INCOME_CLASS = (
    f"CASE WHEN {SQL_WHOLE_INCOME} <= 521 THEN 'Classe E'"
    f" WHEN {SQL_WHOLE_INCOME} <= 1042 THEN 'Classe D'"
    f" WHEN {SQL_WHOLE_INCOME} <= 4427 THEN 'Classe C'"
    f" WHEN {SQL_WHOLE_INCOME} <= 8856 THEN 'Classe B' ELSE 'Classe A' END"
)
SQL_DAYS = f"date_diff('day', CAST(data_nascimento AS DATE), DATE '{AS_OF}')"
SQL_AGE = f"CAST(CAST(floor({SQL_DAYS} / 365.25::DOUBLE) AS BIGINT) AS VARCHAR)"


def sql_silver(acquisitions: str, customers: str, products: str, on_date: str, extra: str) -> str:
    """The silver rows in SQL."""
    return (
        f"SELECT sha256(c.cpf) AS num_doc, c.est_civil, {SQL_AGE} AS idade, c.tp_cliente,"
        f" {SQL_INCOME_CLASS} AS classe_renda, c.genero, c.estado, c.renda,"
        " p.nome AS prod_contratado, v.valor_aquisicao AS valor_prod_contratado, p.categoria,"
        f" p.limite_credito{extra} FROM {acquisitions} v"
        f" LEFT JOIN {customers} c ON v.cliente_id = c.client_id"
        f"{on_date.format(side='c')}"
        f" LEFT JOIN {products} p ON v.produto_id = p.produto_id"
        f"{on_date.format(side='p')}"
        " WHERE p.limite_credito IS NOT NULL"
    )


SQL_SILVER = sql_silver("clientesxprod", "clientes_limpos", "produtos_limpos", "", "")
SQL_TOTALS = (
    "CAST(sum(TRY_CAST(valor_prod_contratado AS DECIMAL(28,2))) AS DOUBLE)"
    " AS valor_total_prod_contratado,"
    " CAST(sum(TRY_CAST(limite_credito AS DECIMAL(28,2))) AS DOUBLE) AS valor_total_limite_credito"
)


#: Plans every lookup as too large to broadcast, and most keys as hot.
_SHUFFLED = replace(_LAKE, broadcast_chars=0, rows_per_task=20)


def silver_rows(spark, sf_dir, lake=_LAKE):
    """The silver rows of the whole export, joined as the sizes of the lookups decide."""
    bought = views.acquisitions(spark, sf_dir)
    acquisitions = bought.select("cliente_id", "produto_id", "valor_aquisicao")
    if not lake.broadcast_chars:
        # Read three times: to count the keys of each lookup, and to join.
        acquisitions = views.stored(acquisitions)
    customers = views.clean_customers(spark, sf_dir).select(CUSTOMER_INPUT)
    products = views.clean_products(spark, sf_dir).select(PRODUCT_INPUT)
    found = profile_inputs(lake, acquisitions, customers, products)
    return credit_customers(acquisitions, customers, products, AS_OF, found.joins)


# Projections and filters


@query("select_columns", "SELECT tp_cliente, client_id, renda FROM clientes")
def select_columns(spark, sf_dir):
    return views.customers(spark, sf_dir).select("tp_cliente", "client_id", "renda")


@query(
    "add_columns",
    f"SELECT client_id, sha256(cpf) AS num_doc, {SQL_AGE} AS idade,"
    f" {SQL_INCOME_CLASS} AS classe_renda FROM clientes_limpos",
)
def add_columns(spark, sf_dir):
    return (
        views.clean_customers(spark, sf_dir)
        .withColumns({
            "num_doc": hash_document(F.col("cpf")),
            "idade": age_years(F.col("data_nascimento"), AS_OF),
            "classe_renda": income_class(F.col("renda")),
        })
        .select("client_id", "num_doc", "idade", "classe_renda")
    )


@query(
    "replace_column",
    "SELECT client_id, CAST(year(CAST(data_nascimento AS DATE)) AS BIGINT) AS data_nascimento"
    " FROM clientes",
)
def replace_column(spark, sf_dir):
    birth = F.col("data_nascimento").try_cast("date")
    replaced = (
        views.customers(spark, sf_dir)
        .withColumn("data_nascimento", birth)
        .withColumn("data_nascimento", F.year("data_nascimento").cast("long"))
    )
    return replaced.select("client_id", "data_nascimento")


@query("rename_column", "SELECT id, cliente_id AS client_id, produto_id FROM clientesxprod")
def rename_column(spark, sf_dir):
    acquisitions = views.acquisitions(spark, sf_dir)
    return acquisitions.withColumnRenamed("cliente_id", "client_id").select(
        "id", "client_id", "produto_id"
    )


@query("trim_column_names", "SELECT * FROM clientesxprod")
def trimmed(spark, sf_dir):
    acquisitions = views.acquisitions(spark, sf_dir)
    return trim_column_names(acquisitions.toDF(*[f" {c}  " for c in acquisitions.columns]))


@query("copy_column", "SELECT produto_id, nome, nome AS prod_contratado FROM produtos")
def copy_column(spark, sf_dir):
    return views.products(spark, sf_dir).select(
        "produto_id", "nome", F.col("nome").alias("prod_contratado")
    )


@query("filter_equals", "SELECT * FROM clientes WHERE tp_cliente = 'HOUSEHOLD'")
def filter_equals(spark, sf_dir):
    return views.customers(spark, sf_dir).where(F.col("tp_cliente") == "HOUSEHOLD")


@query("filter_not_null", "SELECT * FROM produtos_limpos WHERE limite_credito IS NOT NULL")
def filter_not_null(spark, sf_dir):
    return views.clean_products(spark, sf_dir).where(F.col("limite_credito").isNotNull())


@query(
    "predicate_isin",
    "SELECT client_id, renda, trim(renda) IN ('NULL', 'null') AS is_marker FROM clientes",
)
def predicate_isin(spark, sf_dir):
    marked = F.trim("renda").isin("NULL", "null").alias("is_marker")
    return views.customers(spark, sf_dir).select("client_id", "renda", marked)


@query(
    "predicate_range",
    f"SELECT client_id, renda FROM clientes_limpos WHERE {SQL_WHOLE_INCOME} > 1042"
    f" AND {SQL_WHOLE_INCOME} <= 4427",
)
def predicate_range(spark, sf_dir):
    income = whole_number(F.col("renda"))
    return (
        views.clean_customers(spark, sf_dir)
        .where((income > 1042) & (income <= 4427))
        .select("client_id", "renda")
    )


@query("null_marker_to_null", "SELECT * FROM clientes_limpos")
def null_marker(spark, sf_dir):
    return null_markers_to_null(views.customers(spark, sf_dir))


# Joins


@query(
    "left_join_customer",
    "SELECT v.id, v.cliente_id AS client_id, c.cpf, c.estado, c.renda"
    " FROM clientesxprod v LEFT JOIN clientes_limpos c ON v.cliente_id = c.client_id",
)
def left_join_customer(spark, sf_dir):
    """Customers are broadcast once their size has been checked, else shuffled and salted."""
    facts = client_sales(views.acquisitions(spark, sf_dir))
    customers = views.clean_customers(spark, sf_dir).select("client_id", "cpf", "estado", "renda")
    return _sized_join(facts, customers, "client_id", _LAKE)


def client_sales(acquisitions):
    return acquisitions.select("id", F.col("cliente_id").alias("client_id"))


def _sized_join(facts, lookup, key, lake):
    """The lookup's size first; the facts' keys are only counted where it has to be shuffled."""
    small = data_size(lookup).first()["chars"] <= lake.broadcast_chars
    hot = None if small else find_hot_keys(facts.select(key), key, lake.rows_per_task)
    return lookup_join(facts, lookup, key, hot=hot, broadcast_lookup=small)


SQL_LEFT_PRODUCT = (
    "SELECT v.id, v.produto_id, p.nome, p.categoria, p.limite_credito"
    " FROM clientesxprod v LEFT JOIN produtos_limpos p ON v.produto_id = p.produto_id"
)


def _left_join_product(spark, sf_dir):
    products = views.clean_products(spark, sf_dir).select(PRODUCT_INPUT)
    facts = views.acquisitions(spark, sf_dir).select("id", "produto_id")
    return _sized_join(facts, products, "produto_id", _LAKE)


# A third of the acquisitions go to one customer and one product, a fifth to none.
_SKEWED = (
    "SELECT id, CASE WHEN hash_of % 3 = 0 THEN '1' WHEN hash_of % 5 = 0 THEN NULL ELSE cliente_id END"
    " AS cliente_id, CASE WHEN hash_of % 3 = 1 THEN '1' WHEN hash_of % 5 = 0 THEN NULL ELSE produto_id"
    " END AS produto_id, valor_aquisicao FROM (SELECT *, CAST(split_part(id, '-', 1) AS BIGINT)"
    " AS hash_of FROM {sales}) AS numbered"
)


def skewed_sales(spark, sf_dir):
    return spark.sql(_SKEWED, sales=views.acquisitions(spark, sf_dir))


SQL_LEFT_CUSTOMER_SKEWED = (
    "SELECT v.id, v.cliente_id AS client_id, c.cpf, c.estado, c.renda"
    f" FROM ({_SKEWED.format(sales='clientesxprod')}) v"
    " LEFT JOIN clientes_limpos c ON v.cliente_id = c.client_id"
)


@query("left_join_customer_salted", SQL_LEFT_CUSTOMER_SKEWED)
def left_join_customer_salted(spark, sf_dir):
    """The same join shuffled, over one heavy key and many rows without a key."""
    facts = client_sales(skewed_sales(spark, sf_dir))
    customers = views.clean_customers(spark, sf_dir).select("client_id", "cpf", "estado", "renda")
    return _sized_join(facts, customers, "client_id", _SHUFFLED)


@query(
    "left_join_product_salted",
    "SELECT v.id, v.produto_id, p.nome, p.categoria, p.limite_credito"
    f" FROM ({_SKEWED.format(sales='clientesxprod')}) v"
    " LEFT JOIN produtos_limpos p ON v.produto_id = p.produto_id",
)
def left_join_product_salted(spark, sf_dir):
    """Products above the broadcast limit: shuffled, with the heavy keys salted."""
    products = views.clean_products(spark, sf_dir).select(PRODUCT_INPUT)
    facts = skewed_sales(spark, sf_dir).select("id", "produto_id")
    return _sized_join(facts, products, "produto_id", _SHUFFLED)


@query("broadcast_left_join_product", SQL_LEFT_PRODUCT)
def broadcast_left_join_product(spark, sf_dir):
    """Products are broadcast once their size has been checked, else shuffled and salted."""
    return _left_join_product(spark, sf_dir)


@query("left_join_then_not_null", f"{SQL_LEFT_PRODUCT} WHERE p.limite_credito IS NOT NULL")
def left_join_then_not_null(spark, sf_dir):
    return _left_join_product(spark, sf_dir).where(F.col("limite_credito").isNotNull())


# Sums and counts


@query(
    "product_totals",
    f"SELECT prod_contratado, {SQL_TOTALS} FROM ({SQL_SILVER}) GROUP BY prod_contratado",
)
def totals(spark, sf_dir):
    return product_totals(silver_rows(spark, sf_dir))


@query(
    "product_totals_salted",
    f"SELECT prod_contratado, {SQL_TOTALS} FROM ({SQL_SILVER}) GROUP BY prod_contratado",
)
def totals_salted(spark, sf_dir):
    """The same totals with both lookups shuffled."""
    return product_totals(silver_rows(spark, sf_dir, _SHUFFLED))


@query("row_count", "SELECT count(*) AS \"rows\" FROM clientesxprod")
def count_rows(spark, sf_dir):
    return row_count(views.acquisitions(spark, sf_dir))


@query(
    "null_counts",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM clientes_limpos"
        for c in CUSTOMER_NAMES
    ),
)
def count_nulls(spark, sf_dir):
    return null_counts(views.clean_customers(spark, sf_dir))


def sql_chars(columns: list[str]) -> str:
    """Length of ``Row(a='x', b=None)`` in SQL."""
    fixed = 5 + 2 * (len(columns) - 1) + sum(len(c) + 1 for c in columns)
    return " + ".join([str(fixed), *[f"coalesce(length({c}) + 2, 4)" for c in columns]])


@query(
    "data_size",
    f"SELECT *, round(CAST(chars AS DOUBLE) / 1048576, 2) AS size_mb FROM ("
    f"SELECT count(*) AS \"rows\", CAST(sum({sql_chars(CUSTOMER_NAMES)}) AS BIGINT) AS chars"
    f" FROM clientes_limpos)",
)
def text_size(spark, sf_dir):
    return data_size(views.clean_customers(spark, sf_dir))


# Scalar functions


# A text with both quotes, a backslash, a line feed, a control character and a character that does not print.
_ESCAPED = "concat(nome, '\"it', chr(39), 's', chr(92), chr(10), chr(7), 'é', decode(unhex('E2808B'), 'UTF-8'))"
_SQL_ESCAPED_LENGTH = "(length(nome) + 2 + length('\"its\"') - 1 + 2 + 2 + 2 + 4 + 1 + 6)"


@query(
    "data_size_exact",
    "SELECT count(*) AS \"rows\", CAST(sum(length('Row(produto_id=, nome=, texto=)') + length(produto_id) + 2"
    f" + length(nome) + 2 + {_SQL_ESCAPED_LENGTH}) AS BIGINT) AS chars,"
    " round(sum(length('Row(produto_id=, nome=, texto=)') + length(produto_id) + 2"
    f" + length(nome) + 2 + {_SQL_ESCAPED_LENGTH}) / 1048576.0, 2) AS size_mb FROM produtos",
)
def exact_size(spark, sf_dir):
    """The size of rows written out as text, escapes written out too."""
    rows = views.products(spark, sf_dir).select("produto_id", "nome").withColumn("texto", F.expr(_ESCAPED))
    return data_size(rows, exact=True)


@query("fn_trim", "SELECT client_id, trim(renda) AS trimmed FROM clientes")
def fn_trim(spark, sf_dir):
    return views.customers(spark, sf_dir).select("client_id", F.trim("renda").alias("trimmed"))


@query(
    "fn_case",
    "SELECT client_id, CASE WHEN genero = 'F' THEN 'feminino' ELSE 'masculino' END AS genero,"
    " CASE WHEN est_civil = 'solteiro' THEN 1 WHEN est_civil = 'casado' THEN 2"
    " WHEN est_civil = 'divorciado' THEN 3 ELSE 4 END AS est_civil FROM clientes",
)
def fn_case(spark, sf_dir):
    status = F.col("est_civil")
    return views.customers(spark, sf_dir).select(
        "client_id",
        F.when(F.col("genero") == "F", "feminino").otherwise("masculino").alias("genero"),
        F.when(status == "solteiro", 1)
        .when(status == "casado", 2)
        .when(status == "divorciado", 3)
        .otherwise(4)
        .alias("est_civil"),
    )


@query(
    "income_class",
    f"SELECT client_id, renda, {SQL_INCOME_CLASS} AS classe_renda,"
    f" CASE WHEN {SQL_WHOLE_INCOME} IS NULL THEN NULL ELSE {SQL_INCOME_CLASS} END AS classe_lida"
    " FROM clientes_limpos",
)
def classes(spark, sf_dir):
    return views.clean_customers(spark, sf_dir).select(
        "client_id",
        "renda",
        income_class(F.col("renda")).alias("classe_renda"),
        income_class(F.col("renda"), unparsed=None).alias("classe_lida"),
    )


@query("hash_document", "SELECT client_id, sha256(cpf) AS num_doc FROM clientes")
def documents(spark, sf_dir):
    return views.customers(spark, sf_dir).select(
        "client_id", hash_document(F.col("cpf")).alias("num_doc")
    )


@query("age_years", f"SELECT client_id, {SQL_AGE} AS idade FROM clientes")
def ages(spark, sf_dir):
    return views.customers(spark, sf_dir).select(
        "client_id", age_years(F.col("data_nascimento"), AS_OF).alias("idade")
    )


def _days():
    return F.datediff(F.lit(AS_OF), F.col("data_nascimento").try_cast("date"))


@query("fn_datediff", f"SELECT client_id, CAST({SQL_DAYS} AS INTEGER) AS days FROM clientes")
def fn_datediff(spark, sf_dir):
    return views.customers(spark, sf_dir).select("client_id", _days().alias("days"))


@query(
    "fn_divide",
    f"SELECT client_id, {SQL_DAYS} / 365.25::DOUBLE AS years FROM clientes",
)
def fn_divide(spark, sf_dir):
    return views.customers(spark, sf_dir).select(
        "client_id", (_days() / F.lit(DAYS_PER_YEAR)).alias("years")
    )


@query(
    "fn_floor",
    f"SELECT client_id, CAST(floor({SQL_DAYS} / 365.25::DOUBLE) AS BIGINT) AS years FROM clientes",
)
def fn_floor(spark, sf_dir):
    return views.customers(spark, sf_dir).select(
        "client_id", F.floor(_days() / F.lit(DAYS_PER_YEAR)).alias("years")
    )


@query(
    "fn_cast",
    "SELECT id, TRY_CAST(produto_id AS INTEGER) AS produto_id,"
    " CAST(TRY_CAST(data_aquisicao AS DATE) AS VARCHAR) AS data_aquisicao,"
    " TRY_CAST(valor_aquisicao AS DOUBLE) AS valor_aquisicao,"
    " CAST(TRY_CAST(valor_aquisicao AS DECIMAL(28,2)) AS VARCHAR) AS exact_amount"
    " FROM clientesxprod",
)
def fn_cast(spark, sf_dir):
    return views.acquisitions(spark, sf_dir).select(
        "id",
        F.col("produto_id").try_cast("int").alias("produto_id"),
        F.col("data_aquisicao").try_cast("date").cast("string").alias("data_aquisicao"),
        F.col("valor_aquisicao").try_cast("double").alias("valor_aquisicao"),
        amount(F.col("valor_aquisicao")).cast("string").alias("exact_amount"),
    )


@query(
    "fn_round",
    "SELECT id, CAST(CAST(CAST(valor_aquisicao AS DECIMAL(12,2)) AS DECIMAL(12,1)) AS DOUBLE)"
    " AS valor FROM clientesxprod",
)
def fn_round(spark, sf_dir):
    return views.acquisitions(spark, sf_dir).select(
        "id", rounded(F.col("valor_aquisicao"), 1).alias("valor")
    )


@query("fn_is_null", "SELECT client_id, cargo IS NULL AS no_cargo FROM clientes")
def fn_is_null(spark, sf_dir):
    return views.customers(spark, sf_dir).select(
        "client_id", F.col("cargo").isNull().alias("no_cargo")
    )


@query("fn_is_not_null", "SELECT client_id, cargo IS NOT NULL AS has_cargo FROM clientes")
def fn_is_not_null(spark, sf_dir):
    return views.customers(spark, sf_dir).select(
        "client_id", F.col("cargo").isNotNull().alias("has_cargo")
    )


@query("fn_lit", f"SELECT client_id, '{FIRST}' AS dat_ref_carga FROM clientes")
def fn_lit(spark, sf_dir):
    return views.customers(spark, sf_dir).select("client_id", F.lit(FIRST).alias("dat_ref_carga"))


@query(
    "fn_load_date",
    "SELECT event_id, strftime(ts - INTERVAL 3 HOUR, '%Y%m%d') AS dat_ref_carga FROM events",
)
def fn_load_date(spark, sf_dir):
    """Sao Paulo is three hours behind UTC all year in the years of the events."""
    events = views.driver_table(spark, sf_dir, "events")
    return events.select(
        "event_id", load_date_text(F.col("ts"), LOAD_ZONE).alias("dat_ref_carga")
    )


@query(
    "fn_json",
    "SELECT produto_id, concat('{\"produto_id\":\"', produto_id, '\",\"nome\":\"', nome,"
    " '\"', CASE WHEN limite_credito IS NULL THEN ''"
    " ELSE concat(',\"limite_credito\":\"', limite_credito, '\"') END, '}') AS document"
    " FROM produtos_limpos",
)
def fn_json(spark, sf_dir):
    return views.clean_products(spark, sf_dir).select(
        "produto_id",
        F.to_json(F.struct("produto_id", "nome", "limite_credito")).alias("document"),
    )
