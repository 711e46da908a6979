"""Scans and sources."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from driver_queries import views
from driver_queries.registry import query
from driver_queries.views import FIRST, LOAD_DATES, PRODUCT_NAMES, SECOND
from stratalake import config
from stratalake.errors import BadInput, UnsupportedFormat
from stratalake.functions.dates import load_date_of_path
from stratalake.operators.profile import row_count
from stratalake.plans.silver import CUSTOMER_INPUT
from stratalake.schemas import FILE, LOAD_DATE
from stratalake.sinks.stage import land_snapshot
from stratalake.sources.stage import (
    AVRO_SOURCE,
    add_load_date,
    inline_rows,
    list_files,
    sample_rows,
    scan_stage,
    stage_path,
    with_input_file,
)
from stratalake.sources.tables import scan_table, slice_of, slice_scan


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def header_bytes(columns: list[str]) -> int:
    """Size of a file that holds a header and no rows."""
    return len(",".join(columns).encode()) + 1


def land_by_date(spark, sf_dir, lake, dates=LOAD_DATES) -> None:
    """Land the acquisitions of each load date in its own folder."""
    dated = views.stored(views.dated_acquisitions(spark, sf_dir))  # joined once for all dates
    for load_date in dates:
        land_snapshot(
            slice_of(dated, load_date).drop(LOAD_DATE), lake.stage_root, "clientesxprod", load_date
        )


@query("scan_csv", "SELECT * FROM clientes")
def scan_csv(spark, sf_dir):
    lake = views.new_lake(spark)
    path = land_snapshot(views.customers(spark, sf_dir), lake.stage_root, "clientes", FIRST)
    return scan_stage(spark, path, "csv")


#: A description over three lines, with quotes and a carriage return.
_LINES = "concat(descricao, chr(10), '\"', nome, '\",', chr(13), chr(10), 'fim')"


@query(
    "scan_csv_multiline",
    f"SELECT {', '.join(c if c != 'descricao' else f'{_LINES} AS descricao' for c in PRODUCT_NAMES)}"
    " FROM produtos",
)
def scan_csv_multiline(spark, sf_dir):
    """An export in one file, with line breaks inside values, read by as many tasks as it has blocks."""
    lake = views.new_lake(spark)
    rows = views.products(spark, sf_dir).withColumn("descricao", F.expr(_LINES)).select(PRODUCT_NAMES)
    path = land_snapshot(rows.coalesce(1), lake.stage_root, "produtos", FIRST)
    length = list_files(spark, path).agg(F.max("length").alias("n")).first()["n"]
    sizes = {"spark.sql.files.maxPartitionBytes": length // 16 + 1, "spark.sql.files.openCostInBytes": 0}
    before = {name: spark.conf.get(name) for name in sizes}
    try:
        for name, size in sizes.items():
            spark.conf.set(name, size)
        return views.stored(scan_stage(spark, path, "csv", multiline=True).drop(FILE))
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


@query("scan_txt", "SELECT * FROM clientesxprod")
def scan_txt(spark, sf_dir):
    lake = views.new_lake(spark)
    rows = views.acquisitions(spark, sf_dir)
    path = land_snapshot(rows, lake.stage_root, "clientesxprod", FIRST, sep="|")
    return scan_stage(spark, path, "txt", sep="|")


@query("scan_parquet", "SELECT * FROM produtos")
def scan_parquet(spark, sf_dir):
    path = stage_path(views.new_lake(spark).stage_root, "produtos", FIRST)
    views.products(spark, sf_dir).write.parquet(path)
    return scan_stage(spark, path, "parquet")


@query(
    "reject_format",
    "SELECT 'csv' AS file_type, 'accepted' AS outcome, count(*) AS n_rows FROM produtos"
    " UNION ALL SELECT 'txt', 'accepted', count(*) FROM produtos"
    " UNION ALL SELECT 'json', 'rejected', CAST(0 AS BIGINT)"
    " UNION ALL SELECT 'orc', 'rejected', CAST(0 AS BIGINT)",
)
def reject_format(spark, sf_dir):
    lake = views.new_lake(spark)
    path = land_snapshot(views.products(spark, sf_dir), lake.stage_root, "produtos", FIRST)
    parts = []
    for file_type in ("csv", "txt", "json", "orc"):
        try:
            counted = row_count(scan_stage(spark, path, file_type))
            outcome = counted.select(F.lit("accepted").alias("outcome"), "rows")
        except UnsupportedFormat:
            outcome = inline_rows(spark, [("rejected", 0)], "outcome string, rows bigint")
        parts.append(
            outcome.select(
                F.lit(file_type).alias("file_type"), "outcome", F.col("rows").alias("n_rows")
            )
        )
    return views.finished(union(parts), lake)


@query("scan_avro", "SELECT * FROM produtos")
def scan_avro_files(spark, sf_dir):
    """The products through Avro files."""
    path = stage_path(views.new_lake(spark).stage_root, "produtos", FIRST)
    views.products(spark, sf_dir).write.format(AVRO_SOURCE).save(path)
    return scan_stage(spark, path, "avro")


@query(
    "sample_rows",
    "SELECT CAST(3 AS BIGINT) AS sampled, true AS all_in_table, count(*) AS n_rows"
    " FROM clientesxprod",
)
def sampled_rows(spark, sf_dir):
    """A few rows for a message, all of them rows of the table."""
    acquisitions = views.stored(views.acquisitions(spark, sf_dir))
    sample = views.stored(sample_rows(acquisitions, 3).select("id"))
    ids = sample.distinct().withColumn("hit", F.col("id"))
    found = acquisitions.join(F.broadcast(ids), "id", "left")  # three rows at most
    return found.agg(
        F.lit(sample.count()).cast("long").alias("sampled"),
        (F.count_distinct("hit") == F.lit(ids.count())).alias("all_in_table"),
        F.count(F.lit(1)).alias("n_rows"),
    )


@query("stage_path", f"SELECT {LOAD_DATE}, count(*) AS n_rows FROM vendas GROUP BY {LOAD_DATE}")
def stage_paths(spark, sf_dir):
    lake = views.new_lake(spark)
    land_by_date(spark, sf_dir, lake)
    counts = [
        row_count(scan_stage(spark, stage_path(lake.stage_root, "clientesxprod", d))).select(
            F.lit(d).alias(LOAD_DATE), F.col("rows").alias("n_rows")
        )
        for d in LOAD_DATES
    ]
    return views.finished(union(counts), lake)


@query(
    "column_guard",
    "SELECT ',' AS sep, 'rejected' AS outcome, CAST(0 AS BIGINT) AS n_rows"
    " UNION ALL SELECT ';', 'accepted', count(*) FROM clientesxprod",
)
def column_guard(spark, sf_dir):
    lake = views.new_lake(spark)
    rows = views.acquisitions(spark, sf_dir)
    path = land_snapshot(rows, lake.stage_root, "clientesxprod", FIRST, sep=";")
    parts = []
    for sep in (",", ";"):
        try:
            counted = row_count(scan_stage(spark, path, "csv", sep=sep))
            outcome = counted.select(F.lit("accepted").alias("outcome"), "rows")
        except BadInput:
            outcome = inline_rows(spark, [("rejected", 0)], "outcome string, rows bigint")
        parts.append(
            outcome.select(F.lit(sep).alias("sep"), "outcome", F.col("rows").alias("n_rows"))
        )
    return views.finished(union(parts), lake)


@query("add_load_date", f"SELECT *, '{FIRST}' AS {LOAD_DATE} FROM clientesxprod")
def load_date_column(spark, sf_dir):
    return add_load_date(views.acquisitions(spark, sf_dir), FIRST)


@query("scan_table", "SELECT * FROM clientes_datas")
def catalog_table(spark, sf_dir):
    return scan_table(spark, views.bronze_lake(spark, sf_dir), config.CUSTOMERS)


@query("slice_scan", f"SELECT * FROM vendas WHERE {LOAD_DATE} = '{SECOND}'")
def one_slice(spark, sf_dir):
    return slice_scan(spark, views.bronze_lake(spark, sf_dir), config.ACQUISITIONS, SECOND)


@query(
    "slice_scan_projected",
    f"SELECT {', '.join(CUSTOMER_INPUT)} FROM clientes_datas WHERE {LOAD_DATE} = '{SECOND}'",
)
def one_slice_projected(spark, sf_dir):
    lake = views.bronze_lake(spark, sf_dir)
    return slice_scan(spark, lake, config.CUSTOMERS, SECOND, CUSTOMER_INPUT)


@query(
    "list_files",
    f"SELECT {LOAD_DATE}, count(*) AS n_rows, CAST(0 AS BIGINT) AS unread_files FROM vendas"
    f" GROUP BY {LOAD_DATE}",
)
def files_and_their_rows(spark, sf_dir):
    """Every listed file with more than a header is read; their rows add up to the folder's.

    An empty partition leaves a file that holds a header and nothing else.
    """
    lake = views.new_lake(spark)
    land_by_date(spark, sf_dir, lake)
    folder = stage_path(lake.stage_root, "clientesxprod", FIRST).rsplit("/", 1)[0] + "/*"
    scan = scan_stage(spark, folder)
    listed = list_files(spark, folder).where(F.col("length") > header_bytes(scan.columns))
    rows = with_input_file(scan, "path").groupBy("path").agg(F.count(F.lit(1)).alias("n"))
    # The two sources spell the scheme differently; the part below the stage root is the same.
    below = F.regexp_extract("path", r"(/\d{8}/[^/]+)$", 1).alias("file")
    joined = listed.select(below).join(rows.select(below, "n"), "file", "full")
    counts = joined.groupBy(load_date_of_path(F.col("file")).alias(LOAD_DATE)).agg(
        F.sum("n").alias("n_rows"), F.count_if(F.col("n").isNull()).alias("unread_files")
    )
    return views.finished(counts, lake)


@query("input_files", f"SELECT {LOAD_DATE}, id FROM vendas")
def file_of_each_row(spark, sf_dir):
    lake = views.new_lake(spark)
    land_by_date(spark, sf_dir, lake)
    folder = stage_path(lake.stage_root, "clientesxprod", FIRST).rsplit("/", 1)[0] + "/*"
    rows = with_input_file(scan_stage(spark, folder))
    return rows.select(load_date_of_path(F.col("file_name")).alias(LOAD_DATE), "id")


# Two seed products in the layout of the source table; columns not named are null.
SEED_PRODUCTS = [("900001", "Conta Digital", "Conta Corrente", None),
                 ("900002", "Cheque Especial", "Conta Corrente", "10000.00")]


@query(
    "inline_rows",
    "SELECT categoria, count(*) AS n_products, count(limite_credito) AS with_limit FROM ("
    " SELECT produto_id, nome, categoria, limite_credito FROM produtos_limpos"
    " UNION ALL SELECT * FROM (VALUES"
    " ('900001', 'Conta Digital', 'Conta Corrente', NULL),"
    " ('900002', 'Cheque Especial', 'Conta Corrente', '10000.00'))) GROUP BY categoria",
)
def seeded_products(spark, sf_dir):
    schema = "produto_id string, nome string, categoria string, limite_credito string"
    seed = inline_rows(spark, SEED_PRODUCTS, schema)
    catalogue = views.clean_products(spark, sf_dir).select(PRODUCT_NAMES)
    return (
        catalogue.unionByName(seed, allowMissingColumns=True)
        .groupBy("categoria")
        .agg(
            F.count(F.lit(1)).alias("n_products"),
            F.count("limite_credito").alias("with_limit"),
        )
    )
