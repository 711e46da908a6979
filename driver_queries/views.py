"""The lake's model derived from the driver's tables, in Spark and in SQL.

Both forms must agree value for value; ``SQL_VIEWS`` is the prefix of every oracle.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake import config
from stratalake.config import DATABASES, Lake
from stratalake.operators.cleaning import null_markers_to_null
from stratalake.plans.silver import silver_credit_customers
from stratalake.schemas import ACQUISITION_COLUMNS, CUSTOMER_COLUMNS, LOAD_DATE, PRODUCT_COLUMNS
from stratalake.sinks.tables import create_lake, write_slices
from stratalake.workspace import delete_path, new_folder

LOAD_DATES = ("20250415", "20250416", "20250417")
FIRST, SECOND, THIRD = LOAD_DATES

CUSTOMER_NAMES = [c[0] for c in CUSTOMER_COLUMNS]
PRODUCT_NAMES = [c[0] for c in PRODUCT_COLUMNS]
ACQUISITION_NAMES = [c[0] for c in ACQUISITION_COLUMNS]


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# One expression per column that Spark and DuckDB read the same way.
CUSTOMER_SQL = """
    CAST(c_custkey AS VARCHAR(20)) AS client_id,
    c_name AS nome,
    lower(c_mktsegment) AS sobrenome,
    lpad(CAST(c_custkey AS VARCHAR(20)), 11, '0') AS cpf,
    lpad(CAST(c_nationkey AS VARCHAR(20)), 10, '0') AS rg,
    CAST({birth} AS VARCHAR(10)) AS data_nascimento,
    CASE c_custkey % 4 WHEN 0 THEN 'solteiro' WHEN 1 THEN 'casado'
        WHEN 2 THEN 'divorciado' ELSE 'viuvo' END AS est_civil,
    CASE c_custkey % 2 WHEN 0 THEN 'F' ELSE 'M' END AS genero,
    concat('c', CAST(c_custkey AS VARCHAR(20)), '@example.org') AS email,
    concat('+55 ', lpad(CAST(c_custkey AS VARCHAR(20)), 8, '0')) AS tel_res,
    concat('+55 9', lpad(CAST(c_custkey AS VARCHAR(20)), 8, '0')) AS tel_cel,
    concat('Rua ', CAST(c_custkey % 97 AS VARCHAR(20)), ', ', CAST(c_custkey AS VARCHAR(20)))
        AS endereco,
    'Brasil' AS pais,
    concat('cidade ', CAST(c_nationkey AS VARCHAR(20))) AS cidade,
    CAST(c_nationkey AS VARCHAR(20)) AS estado,
    lpad(CAST(c_custkey % 90000 AS VARCHAR(20)), 8, '0') AS cep,
    'brasileira' AS nacionalidade,
    CASE WHEN c_custkey % 17 = 0 THEN ' NULL '
         WHEN c_custkey % 31 = 0 THEN 'n/d'
         WHEN c_custkey % 5 = 0 THEN CAST(CAST(abs(c_acctbal) AS DECIMAL(12,2)) AS VARCHAR(20))
         ELSE CAST(CAST(floor(abs(c_acctbal)) AS BIGINT) AS VARCHAR(20)) END AS renda,
    CASE WHEN c_custkey % 7 = 0 THEN NULL
         ELSE concat('cargo ', CAST(c_custkey % 13 AS VARCHAR(20))) END AS cargo,
    c_mktsegment AS tp_cliente,
    '2024-01-01' AS data_criacao
"""
PRODUCT_SQL = """
    CAST(p_partkey AS VARCHAR(20)) AS produto_id,
    p_name AS nome,
    concat('"', p_brand, '", ', p_name) AS descricao,
    p_type AS categoria,
    '2024-01-01' AS data_lancamento,
    concat(CAST(p_size % 10 AS VARCHAR(20)), '.50') AS taxa_juros,
    '0.00' AS taxa_administracao,
    CASE WHEN p_partkey % 5 = 0 THEN 'null'
         ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR(20)) END AS limite_credito,
    CAST(p_size AS VARCHAR(20)) AS prazo,
    CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE '0800-000-0001' END AS contato_suporte,
    '0.00' AS taxa_adesao,
    '2024-01-01' AS data_ultima_atualizacao,
    CAST(p_size % 3 AS VARCHAR(20)) AS prazo_carencia,
    '0.00' AS taxa_rentabilidade,
    '12' AS periodo_investimento,
    '0.00' AS multa_cancelamento
"""
ACQUISITION_SQL = """
    concat(CAST(l_orderkey AS VARCHAR(20)), '-', CAST(l_linenumber AS VARCHAR(20))) AS id,
    CAST(CASE WHEN l_orderkey % 50 = 0 THEN o_custkey + 10000000 ELSE o_custkey END
        AS VARCHAR(20)) AS cliente_id,
    CAST(l_partkey AS VARCHAR(20)) AS produto_id,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR(10)) AS data_aquisicao,
    CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR(20)) AS valor_aquisicao
"""
SLICE_SQL = (
    f"CASE l_orderkey % 3 WHEN 0 THEN '{FIRST}' WHEN 1 THEN '{SECOND}' ELSE '{THIRD}' END"
)

_DATES = ", ".join(f"('{d}')" for d in LOAD_DATES)


def _markers(columns: list[str]) -> str:
    return ", ".join(
        f"CASE WHEN trim({c}) IN ('NULL', 'null') THEN NULL ELSE {c} END AS {c}" for c in columns
    )


SQL_VIEWS = f"""
WITH clientes AS (
    SELECT {CUSTOMER_SQL.format(birth="DATE '1950-01-01' + CAST(c_custkey % 20000 AS INTEGER)")}
    FROM customer),
produtos AS (SELECT {PRODUCT_SQL} FROM part),
vendas AS (
    SELECT {ACQUISITION_SQL}, {SLICE_SQL} AS {LOAD_DATE}
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
clientes_limpos AS (SELECT {_markers(CUSTOMER_NAMES)} FROM clientes),
produtos_limpos AS (SELECT {_markers(PRODUCT_NAMES)} FROM produtos),
datas AS (SELECT * FROM (VALUES {_DATES}) AS d({LOAD_DATE})),
clientes_datas AS (SELECT clientes_limpos.*, datas.{LOAD_DATE} FROM clientes_limpos, datas),
produtos_datas AS (SELECT produtos_limpos.*, datas.{LOAD_DATE} FROM produtos_limpos, datas),
clientesxprod AS (SELECT id, cliente_id, produto_id, data_aquisicao, valor_aquisicao FROM vendas)
"""


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer export, null markers still in it."""
    return _select(
        driver_table(spark, sf_dir, "customer"),
        CUSTOMER_SQL.format(birth="date_add(DATE '1950-01-01', CAST(c_custkey % 20000 AS INT))"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product export, null markers still in it."""
    return _select(driver_table(spark, sf_dir, "part"), PRODUCT_SQL)


def dated_acquisitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The acquisitions with the load date each falls in."""
    lines = driver_table(spark, sf_dir, "lineitem")
    orders = driver_table(spark, sf_dir, "orders")
    bought = lines.join(orders, lines["l_orderkey"] == orders["o_orderkey"])
    return _select(bought, f"{ACQUISITION_SQL}, {SLICE_SQL} AS {LOAD_DATE}")


def acquisitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The acquisition export."""
    return dated_acquisitions(spark, sf_dir).drop(LOAD_DATE)


def clean_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_markers_to_null(customers(spark, sf_dir))


def clean_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_markers_to_null(products(spark, sf_dir))


def _select(df: DataFrame, columns: str) -> DataFrame:
    source = f"source_{uuid.uuid4().hex}"
    df.createOrReplaceTempView(source)
    selected = df.sparkSession.sql(f"SELECT {columns} FROM {source}")
    df.sparkSession.catalog.dropTempView(source)
    return selected.select(*[F.col(c).cast("string").alias(c) for c in selected.columns])


def on_each_date(df: DataFrame) -> DataFrame:
    """Every row once for each load date."""
    dates = F.array(*[F.lit(d) for d in LOAD_DATES])
    return df.withColumn(LOAD_DATE, F.explode(dates))


def stored(df: DataFrame) -> DataFrame:
    """The rows written out and read back, for queries that pass over a derived view twice."""
    path = new_folder(df.sparkSession, "view")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def new_lake(spark: SparkSession) -> Lake:
    """An empty lake in a folder and databases of its own."""
    root = new_folder(spark, "lake")
    return Lake(
        root=f"{root}/tables",
        stage_root=f"{root}/stage",
        database_prefix=f"t{uuid.uuid4().hex[:12]}_",
    )


def finished(result: DataFrame, lake: Lake) -> DataFrame:
    """A small result kept on its own, and the lake it was taken from deleted."""
    spark = result.sparkSession
    kept = stored(result)
    for database in DATABASES:
        spark.sql(f"DROP DATABASE IF EXISTS {lake.database(database)} CASCADE")
    delete_path(spark, lake.root)
    delete_path(spark, lake.stage_root)
    return kept


_lakes: dict[tuple[str, str, str], Lake] = {}


def bronze_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """A lake whose bronze tables hold the driver's rows on all load dates; made once a session."""
    key = (spark.sparkContext.applicationId, sf_dir, "bronze")
    if key not in _lakes:
        lake = new_lake(spark)
        create_lake(spark, lake)
        write_slices(
            spark, lake, config.CUSTOMERS, on_each_date(clean_customers(spark, sf_dir)), LOAD_DATES
        )
        write_slices(
            spark, lake, config.PRODUCTS, on_each_date(clean_products(spark, sf_dir)), LOAD_DATES
        )
        write_slices(
            spark, lake, config.ACQUISITIONS, dated_acquisitions(spark, sf_dir), LOAD_DATES
        )
        _lakes[key] = lake
    return _lakes[key]


def silver_lake(spark: SparkSession, sf_dir: str) -> Lake:
    """The same lake with its silver slices built; made once a session."""
    lake = bronze_lake(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir, "silver")
    if key not in _lakes:
        for load_date in LOAD_DATES:
            silver_credit_customers(spark, lake, load_date)
        _lakes[key] = lake
    return lake
