"""Column layouts of the source exports, the lake tables and the run metrics."""

from __future__ import annotations

from pyspark.sql import types as T

LOAD_DATE = "dat_ref_carga"
"""Partition column of every lake table: the load date as ``yyyyMMdd`` text."""

RAGGED = "__ragged"
"""Text of a record with more or fewer values than its header; null for all others."""

FILE = "__file"
"""The file of each row, in a scan that did not come straight from Spark's reader."""

# Table layouts (name, source type, comment).
CUSTOMER_COLUMNS = [
    ("client_id", T.IntegerType(), "customer key"),
    ("nome", T.StringType(), "first name"),
    ("sobrenome", T.StringType(), "family name"),
    ("cpf", T.StringType(), "personal document number"),
    ("rg", T.StringType(), "identity card number"),
    ("data_nascimento", T.DateType(), "birth date"),
    ("est_civil", T.StringType(), "marital status"),
    ("genero", T.StringType(), "gender"),
    ("email", T.StringType(), "mail address"),
    ("tel_res", T.StringType(), "home phone"),
    ("tel_cel", T.StringType(), "mobile phone"),
    ("endereco", T.StringType(), "street address"),
    ("pais", T.StringType(), "country"),
    ("cidade", T.StringType(), "city"),
    ("estado", T.StringType(), "state"),
    ("cep", T.StringType(), "postal code"),
    ("nacionalidade", T.StringType(), "nationality"),
    ("renda", T.StringType(), "monthly income, as typed in"),
    ("cargo", T.StringType(), "occupation"),
    ("tp_cliente", T.StringType(), "kind of customer"),
    ("data_criacao", T.DateType(), "date the record was made"),
]
PRODUCT_COLUMNS = [
    ("produto_id", T.IntegerType(), "product key"),
    ("nome", T.StringType(), "product name"),
    ("descricao", T.StringType(), "description"),
    ("categoria", T.StringType(), "category"),
    ("data_lancamento", T.DateType(), "launch date"),
    ("taxa_juros", T.DecimalType(5, 2), "interest rate"),
    ("taxa_administracao", T.DecimalType(5, 2), "administration fee"),
    ("limite_credito", T.DecimalType(10, 2), "credit limit"),
    ("prazo", T.IntegerType(), "term"),
    ("contato_suporte", T.StringType(), "support phone"),
    ("taxa_adesao", T.DecimalType(10, 2), "joining fee"),
    ("data_ultima_atualizacao", T.DateType(), "last update"),
    ("prazo_carencia", T.IntegerType(), "grace period"),
    ("taxa_rentabilidade", T.DecimalType(5, 2), "expected yield"),
    ("periodo_investimento", T.IntegerType(), "investment period"),
    ("multa_cancelamento", T.DecimalType(5, 2), "cancellation fee"),
]
ACQUISITION_COLUMNS = [
    ("id", T.IntegerType(), "acquisition key"),
    ("cliente_id", T.IntegerType(), "customer who bought"),
    ("produto_id", T.IntegerType(), "product bought"),
    ("data_aquisicao", T.DateType(), "date of purchase"),
    ("valor_aquisicao", T.DecimalType(10, 2), "amount"),
]
SILVER_COLUMNS = [
    ("num_doc", "hashed document number"),
    ("est_civil", "marital status"),
    ("idade", "age in years"),
    ("tp_cliente", "kind of customer"),
    ("classe_renda", "income class"),
    ("genero", "gender"),
    ("estado", "state"),
    ("renda", "monthly income, as typed in"),
    ("prod_contratado", "product bought"),
    ("valor_prod_contratado", "amount"),
    ("categoria", "product category"),
    ("limite_credito", "credit limit of the product"),
]
GOLD_COLUMNS = [
    ("prod_contratado", T.StringType(), "product bought"),
    ("valor_total_prod_contratado", T.DoubleType(), "sum of the amounts"),
    ("valor_total_limite_credito", T.DoubleType(), "sum of the credit limits"),
]


def _field(name: str, kind: T.DataType, comment: str) -> T.StructField:
    return T.StructField(name, kind, True, {"comment": comment})


def _lake(columns: list[tuple[str, T.DataType, str]]) -> T.StructType:
    fields = [_field(*column) for column in columns]
    return T.StructType([*fields, _field(LOAD_DATE, T.StringType(), "load date, yyyyMMdd")])


def _text(columns: list[tuple]) -> list[tuple[str, T.DataType, str]]:
    return [(column[0], T.StringType(), column[-1]) for column in columns]


CUSTOMERS_SOURCE = T.StructType([_field(*c) for c in CUSTOMER_COLUMNS])
PRODUCTS_SOURCE = T.StructType([_field(*c) for c in PRODUCT_COLUMNS])
ACQUISITIONS_SOURCE = T.StructType([_field(*c) for c in ACQUISITION_COLUMNS])

CUSTOMERS = _lake(_text(CUSTOMER_COLUMNS))
PRODUCTS = _lake(_text(PRODUCT_COLUMNS))
ACQUISITIONS = _lake(_text(ACQUISITION_COLUMNS))
CREDIT_CUSTOMERS = _lake(_text(SILVER_COLUMNS))
PRODUCT_TOTALS = _lake(GOLD_COLUMNS)

REJECTS = _lake([
    ("motivo", T.StringType(), "why the row was refused"),
    ("arquivo", T.StringType(), "file it came from"),
    ("registro", T.StringType(), "the row as delimited text"),
])

LOG_ENTRY = T.StructType([
    T.StructField("Timestamp", T.StringType()),
    T.StructField("Level", T.StringType()),
    T.StructField("Message", T.StringType()),
])

# Metric fields of a bronze run, and of a silver or gold run.
BRONZE_METRICS = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("load_total_time", T.DoubleType()),
    T.StructField("number_lines_loaded", T.LongType()),
    T.StructField("data_size_mb_formatted", T.DoubleType()),
    T.StructField("write_total_time", T.DoubleType()),
    T.StructField("qtd_total_rows_insert", T.LongType()),
    T.StructField("num_columns_table", T.LongType()),
    T.StructField("num_files", T.LongType()),
    T.StructField("total_execution", T.DoubleType()),
    T.StructField("dat_carga", T.StringType()),
    T.StructField("alerta", T.BooleanType()),
    T.StructField("execution_succes", T.BooleanType()),
    T.StructField("datetime_execution", T.StringType()),
])
REFINED_METRICS = T.StructType([
    T.StructField("table_name", T.StringType()),
    T.StructField("load_total_time", T.DoubleType()),
    T.StructField("qtd_total_rows_insert", T.LongType()),
    T.StructField("write_total_time", T.DoubleType()),
    T.StructField("data_size_mb_formatted", T.DoubleType()),
    T.StructField("qts_total_rows_insert_verify", T.LongType()),
    T.StructField("num_columns_table", T.LongType()),
    T.StructField("num_files", T.LongType()),
    T.StructField("total_execution", T.DoubleType()),
    T.StructField("dat_carga", T.StringType()),
    T.StructField("alerta", T.BooleanType()),
    T.StructField("execution_succes", T.BooleanType()),
    T.StructField("datetime_execution", T.StringType()),
])
