"""Databases, tables, writes, exports, landings and purges."""

from __future__ import annotations

import re
from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from driver_queries import views
from driver_queries.registry import query
from driver_queries.sources import union
from driver_queries.views import CUSTOMER_NAMES, FIRST, LOAD_DATES, SECOND
from stratalake import config, schemas
from stratalake.config import ALL_TABLES, BRONZE_LOADS, DATABASES, WRITE_MODES, LakeTable
from stratalake.errors import AlreadyLanded, BadInput
from stratalake.operators.profile import row_count
from stratalake.plans.bronze import bronze_ingest
from stratalake.plans.gold import gold_product_totals
from stratalake.plans.silver import silver_credit_customers
from stratalake.schemas import LOAD_DATE
from stratalake.sinks.compact import compact_slice
from stratalake.sinks.runlog import run_log
from stratalake.sinks.stage import first_row_peek, land_snapshot, purge_stage, snapshot_export
from stratalake.sinks.tables import (
    create_database,
    create_lake,
    create_table,
    slice_path,
    table_exists,
    write_slices,
)
from stratalake.sources.stage import inline_rows, list_files, scan_stage
from stratalake.sources.tables import scan_table, slice_of
from stratalake.workspace import new_folder


# Rows of the five tables after one date: none in a new lake, then as many as the exports and joins give.
_TABLE_ROWS = {
    "clientes": "(SELECT count(*) FROM clientes)",
    "produtos": "(SELECT count(*) FROM produtos)",
    "clientesxprod": "(SELECT count(*) FROM vendas)",
    "clie_limit": "(SELECT count(*) FROM vendas v JOIN produtos_limpos p USING (produto_id)"
    " WHERE p.limite_credito IS NOT NULL)",
    "prod_contrat_diario": "(SELECT count(DISTINCT p.nome) FROM vendas v JOIN produtos_limpos p USING (produto_id)"
    " WHERE p.limite_credito IS NOT NULL)",
}
# Written out by hand: database, table, columns and how many of them have a comment.
_TABLES = (
    ("b_cad", "clientes", 22, 22),
    ("b_cad", "produtos", 17, 17),
    ("b_vend", "clientesxprod", 6, 6),
    ("s_vend", "clie_limit", 13, 13),
    ("g_vend", "prod_contrat_diario", 4, 4),
)


def _filled(spark, sf_dir, lake) -> None:
    """The tables of a lake, filled for one date."""
    write_slices(spark, lake, config.CUSTOMERS, views.clean_customers(spark, sf_dir), [FIRST])
    write_slices(spark, lake, config.PRODUCTS, views.clean_products(spark, sf_dir), [FIRST])
    write_slices(spark, lake, config.ACQUISITIONS, views.acquisitions(spark, sf_dir), [FIRST])
    silver_credit_customers(spark, lake, FIRST)
    gold_product_totals(spark, lake, FIRST)


@query(
    "create_database",
    " UNION ALL ".join(
        f"SELECT '{database}' AS database_name, false AS existed, true AS present, true AS twice_is_once,"
        f" {' + '.join(_TABLE_ROWS[t] for d, t, *_ in _TABLES if d == database)} AS n_rows"
        for database in ("b_cad", "b_vend", "s_vend", "g_vend")
    ),
)
def databases(spark, sf_dir):
    """All databases of a lake that has none yet, made twice, and the rows of the tables then made in them."""
    lake = views.new_lake(spark)
    existed = {d: spark.catalog.databaseExists(lake.database(d)) for d in DATABASES}
    present = {}
    for database in DATABASES * 2:
        create_database(spark, lake, database)
        found = len(spark.catalog.listDatabases(lake.database(database)))
        present.setdefault(database, []).append(found)
    create_lake(spark, lake)
    _filled(spark, sf_dir, lake)
    parts = []
    for database in DATABASES:
        members = [t for t in ALL_TABLES if t.database == database]
        counted = union([row_count(scan_table(spark, lake, t)) for t in members])
        parts.append(
            counted.agg(F.sum("rows").alias("n_rows")).select(
                F.lit(database).alias("database_name"),
                F.lit(existed[database]).alias("existed"),
                F.lit(spark.catalog.databaseExists(lake.database(database))).alias("present"),
                F.lit(present[database] == [1, 1]).alias("twice_is_once"),
                "n_rows",
            )
        )
    return views.finished(union(parts), lake)


@query(
    "create_table",
    " UNION ALL ".join(
        f"SELECT '{database}' AS database_name, '{name}' AS table_name, {columns} AS n_columns,"
        f" {commented} AS n_comments, '{LOAD_DATE}' AS partition_column, true AS below_the_root,"
        f" {_TABLE_ROWS[name]} AS n_rows"
        for database, name, columns, commented in _TABLES
    ),
)
def created_tables(spark, sf_dir):
    """The five tables, made in an empty lake, as the catalog describes them, and the rows they then take."""
    lake = views.new_lake(spark)
    for database in DATABASES:
        create_database(spark, lake, database)
    described = {}
    for table in ALL_TABLES:
        create_table(spark, lake, table)
        columns = spark.catalog.listColumns(table.full_name(lake))
        detail = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table.full_name(lake)}").collect()}
        described[table.name] = (columns, detail["Location"])
    _filled(spark, sf_dir, lake)
    parts = []
    for table in ALL_TABLES:
        columns, location = described[table.name]
        parts.append(
            row_count(scan_table(spark, lake, table)).select(
                F.lit(table.database).alias("database_name"),
                F.lit(table.name).alias("table_name"),
                F.lit(len(columns)).alias("n_columns"),
                F.lit(sum(bool(c.description) for c in columns)).alias("n_comments"),
                F.lit(",".join(c.name for c in columns if c.isPartition)).alias("partition_column"),
                F.lit(location.endswith(table.path(lake).split(":", 1)[-1].lstrip("/"))).alias("below_the_root"),
                F.col("rows").alias("n_rows"),
            )
        )
    return views.finished(union(parts), lake)


@query(
    "table_exists",
    "SELECT 'produtos' AS table_name, false AS existed, true AS present, count(*) AS n_rows"
    " FROM produtos",
)
def existing_table(spark, sf_dir):
    lake = views.new_lake(spark)
    create_database(spark, lake, config.PRODUCTS.database)
    existed = table_exists(spark, lake, config.PRODUCTS)
    rows = views.products(spark, sf_dir).withColumn(LOAD_DATE, F.lit(FIRST))
    write_slices(spark, lake, config.PRODUCTS, rows, [FIRST])
    found = row_count(scan_table(spark, lake, config.PRODUCTS)).select(
        F.lit(config.PRODUCTS.name).alias("table_name"),
        F.lit(existed).alias("existed"),
        F.lit(table_exists(spark, lake, config.PRODUCTS)).alias("present"),
        F.col("rows").alias("n_rows"),
    )
    return views.finished(found, lake)


def _acquisition_lake(spark, sf_dir):
    lake = views.new_lake(spark)
    create_database(spark, lake, config.ACQUISITIONS.database)
    return lake, views.stored(views.dated_acquisitions(spark, sf_dir))


@query("append_slice", "SELECT * FROM vendas UNION ALL SELECT * FROM vendas")
def append_twice(spark, sf_dir):
    lake, rows = _acquisition_lake(spark, sf_dir)
    for _ in range(2):
        write_slices(spark, lake, config.ACQUISITIONS, rows, LOAD_DATES, "append")
    return scan_table(spark, lake, config.ACQUISITIONS)


@query(
    "write_mode",
    f"SELECT 'append' AS mode, '{FIRST}' AS {LOAD_DATE}, 2 * count(*) AS n_rows FROM produtos"
    f" UNION ALL SELECT 'append', '{SECOND}', count(*) FROM produtos"
    f" UNION ALL SELECT 'replace_slice', '{FIRST}', count(*) FROM produtos"
    f" UNION ALL SELECT 'replace_slice', '{SECOND}', count(*) FROM produtos"
    f" UNION ALL SELECT 'overwrite_table', '{FIRST}', count(*) FROM produtos"
    " UNION ALL SELECT 'upsert', 'rejected', CAST(0 AS BIGINT)",
)
def write_modes(spark, sf_dir):
    """Two slices, then the first once more in each mode."""
    rows = views.products(spark, sf_dir)
    parts = []
    for mode in (*WRITE_MODES, "upsert"):
        lake = views.new_lake(spark)
        create_database(spark, lake, config.PRODUCTS.database)
        for load_date in (FIRST, SECOND):
            dated = rows.withColumn(LOAD_DATE, F.lit(load_date))
            write_slices(spark, lake, config.PRODUCTS, dated, [load_date])
        again = rows.withColumn(LOAD_DATE, F.lit(FIRST))
        try:
            write_slices(spark, lake, config.PRODUCTS, again, [FIRST], mode)
            stored = scan_table(spark, lake, config.PRODUCTS)
            counted = stored.groupBy(LOAD_DATE).agg(F.count(F.lit(1)).alias("n_rows"))
        except ValueError:
            counted = inline_rows(spark, [("rejected", 0)], f"{LOAD_DATE} string, n_rows bigint")
        parts.append(views.finished(counted.withColumn("mode", F.lit(mode)), lake))
    return union(parts)


@query("overwrite_table", f"SELECT * FROM vendas WHERE {LOAD_DATE} = '{SECOND}'")
def overwritten(spark, sf_dir):
    """All slices, then the table overwritten with one of them."""
    lake, rows = _acquisition_lake(spark, sf_dir)
    write_slices(spark, lake, config.ACQUISITIONS, rows, LOAD_DATES)
    last = slice_of(rows, SECOND)
    write_slices(spark, lake, config.ACQUISITIONS, last, [SECOND], "overwrite_table")
    return scan_table(spark, lake, config.ACQUISITIONS)


@query("replace_slice", "SELECT * FROM vendas")
def replaced(spark, sf_dir):
    """All slices, then one of them loaded again."""
    lake, rows = _acquisition_lake(spark, sf_dir)
    write_slices(spark, lake, config.ACQUISITIONS, rows, LOAD_DATES)
    write_slices(spark, lake, config.ACQUISITIONS, slice_of(rows, FIRST), [FIRST])
    return scan_table(spark, lake, config.ACQUISITIONS)


@query(
    "schema_merge",
    f"SELECT {', '.join(c if c != 'cargo' else 'NULL AS cargo' for c in CUSTOMER_NAMES)},"
    f" CAST(NULL AS VARCHAR) AS canal, '{FIRST}' AS {LOAD_DATE} FROM clientes"
    f" UNION ALL SELECT {', '.join(CUSTOMER_NAMES)}, concat('canal ', estado), '{SECOND}'"
    " FROM clientes",
)
def merged_schema(spark, sf_dir):
    """A first load without one column of the table, a second with a new one."""
    lake = views.new_lake(spark)
    create_database(spark, lake, config.CUSTOMERS.database)
    customers = views.customers(spark, sf_dir)
    first = customers.drop("cargo").withColumn(LOAD_DATE, F.lit(FIRST))
    second = customers.withColumn("canal", F.concat(F.lit("canal "), "estado"))
    write_slices(spark, lake, config.CUSTOMERS, first, [FIRST])
    write_slices(
        spark, lake, config.CUSTOMERS, second.withColumn(LOAD_DATE, F.lit(SECOND)), [SECOND]
    )
    return scan_table(spark, lake, config.CUSTOMERS)


_MEASURES = LakeTable(
    "b_vend",
    "medidas",
    T.StructType([
        T.StructField("id", T.LongType()), T.StructField("valor", T.IntegerType()), T.StructField(LOAD_DATE, T.StringType()),
    ]),
)
# Each load in turn: the type its values come in, and their SQL.
_KINDS = (
    ("int", "CAST(l_linenumber AS INT)"),
    ("bigint", "CAST(l_orderkey AS BIGINT) * 10000000000"),
    ("decimal(12,2)", "CAST(l_extendedprice AS DECIMAL(12,2))"),
    ("string", "concat(' ', CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR(20)))"),
    ("string", "CASE WHEN l_linenumber = 1 THEN 'n/d' ELSE '1.25' END"),
)


@query(
    "type_reconciliation",
    "SELECT 'int' AS incoming, 'int' AS stored_as, 'kept' AS outcome, count(*) AS n_rows,"
    " CAST(sum(l_linenumber) AS DOUBLE) AS total FROM lineitem"
    " UNION ALL SELECT 'bigint', 'bigint', 'kept', 2 * count(*),"
    " CAST(sum(CAST(l_linenumber AS DECIMAL(38,2)) + CAST(l_orderkey AS DECIMAL(28,0)) * 10000000000) AS DOUBLE) FROM lineitem"
    " UNION ALL SELECT 'decimal(12,2)', 'decimal(22,2)', 'kept', 3 * count(*), CAST(sum(CAST(l_linenumber AS DECIMAL(38,2))"
    " + CAST(l_orderkey AS DECIMAL(28,0)) * 10000000000 + CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) FROM lineitem"
    " UNION ALL SELECT 'text', 'decimal(22,2)', 'kept', 4 * count(*), CAST(sum(CAST(l_linenumber AS DECIMAL(38,2))"
    " + CAST(l_orderkey AS DECIMAL(28,0)) * 10000000000 + 2 * CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) FROM lineitem"
    " UNION ALL SELECT 'text', 'decimal(22,2)', concat('refused, ', CAST(sum(CASE WHEN l_linenumber = 1 THEN 1 ELSE 0 END)"
    " AS VARCHAR), ' values'), 4 * count(*), CAST(sum(CAST(l_linenumber AS DECIMAL(38,2))"
    " + CAST(l_orderkey AS DECIMAL(28,0)) * 10000000000 + 2 * CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) FROM lineitem",
)
def reconciled_types(spark, sf_dir):
    """Loads of one column in ever wider types, then as text: the table widens, and refuses what it would lose."""
    lake = views.new_lake(spark)
    create_database(spark, lake, _MEASURES.database)
    lines = views.driver_table(spark, sf_dir, "lineitem")
    parts = []
    for day, (kind, value) in enumerate(_KINDS, 1):
        path = new_folder(spark, "typed")
        lines.selectExpr("CAST(l_orderkey AS BIGINT) AS id", f"{value} AS valor").write.parquet(path)
        try:
            write_slices(spark, lake, _MEASURES, scan_stage(spark, path, "parquet"), [f"2025010{day}"])
            outcome = "kept"
        except BadInput as error:
            outcome = f"refused, {re.search(r'table: ([0-9]+) of valor', str(error))[1]} values"
        stored = scan_table(spark, lake, _MEASURES)
        parts.append(
            stored.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("valor").cast("decimal(38,2)")).cast("double").alias("total")).select(
                F.lit("text" if kind == "string" else kind).alias("incoming"),
                F.lit(stored.schema["valor"].dataType.simpleString()).alias("stored_as"),
                F.lit(outcome).alias("outcome"),
                "n_rows",
                "total",
            )
        )
        # The table changes under the next load.
        parts[-1] = views.stored(parts[-1])
    return views.finished(union(parts), lake)


@query("file_size", "SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS files_too_large FROM vendas")
def sized_files(spark, sf_dir):
    """Of a load with a small target, no file has many more bytes than that."""
    lake = replace(views.new_lake(spark), target_file_bytes=48 * 1024)
    create_database(spark, lake, config.ACQUISITIONS.database)
    rows = views.acquisitions(spark, sf_dir)
    land_snapshot(rows, lake.stage_root, "clientesxprod", FIRST)
    bronze_ingest(spark, lake, BRONZE_LOADS["clientesxprod"], FIRST)
    files = list_files(spark, config.ACQUISITIONS.path(lake), recursive=True)
    too_large = files.agg(
        F.count_if(F.col("length") > 2 * lake.target_file_bytes).alias("files_too_large")
    ).first()["files_too_large"]
    counted = row_count(scan_table(spark, lake, config.ACQUISITIONS))
    sizes = counted.select(
        F.col("rows").alias("n_rows"), F.lit(too_large).cast("long").alias("files_too_large")
    )
    return views.finished(sizes, lake)


@query(
    "compaction",
    "SELECT *, true AS as_few_as_fit, true AS untouched_once_more FROM clientesxprod",
)
def compacted(spark, sf_dir):
    """A slice of two hundred small files, put together to as many as its bytes fill; the rows stay."""
    lake = views.new_lake(spark)
    create_database(spark, lake, config.ACQUISITIONS.database)
    rows = views.acquisitions(spark, sf_dir).repartition(200)
    write_slices(spark, lake, config.ACQUISITIONS, rows, [FIRST])
    folder = slice_path(lake, config.ACQUISITIONS, FIRST)
    held = list_files(spark, folder).agg(F.sum("length").alias("n")).first()["n"]
    target = held // 3 + 1
    done = compact_slice(spark, lake, config.ACQUISITIONS, FIRST, target)
    listed = list_files(spark, folder).count()
    few = done.before == 200 and done.after == listed == 3
    again = compact_slice(spark, lake, config.ACQUISITIONS, FIRST, held // 30)
    found = scan_table(spark, lake, config.ACQUISITIONS).drop(LOAD_DATE)
    marks = {"as_few_as_fit": F.lit(few), "untouched_once_more": F.lit(again.rewritten_bytes == 0)}
    return views.finished(found.withColumns(marks), lake)


@query("snapshot_export", "SELECT * FROM produtos")
def exported(spark, sf_dir):
    """Descriptions hold quotes and commas; they come back as they were."""
    path = f"{new_folder(spark, 'export')}/produtos"
    snapshot_export(views.products(spark, sf_dir), path)
    return scan_stage(spark, path)


@query(
    "land_snapshot",
    "SELECT '20250415' AS dat_ref_carga, 'rejected' AS second_landing, count(*) AS n_rows"
    " FROM clientesxprod",
)
def landed(spark, sf_dir):
    lake = views.new_lake(spark)
    rows = views.acquisitions(spark, sf_dir)
    path = land_snapshot(rows, lake.stage_root, "clientesxprod", FIRST)
    try:
        land_snapshot(rows, lake.stage_root, "clientesxprod", FIRST)
        second = "accepted"
    except AlreadyLanded:
        second = "rejected"
    found = row_count(scan_stage(spark, path)).select(
        F.lit(FIRST).alias(LOAD_DATE),
        F.lit(second).alias("second_landing"),
        F.col("rows").alias("n_rows"),
    )
    return views.finished(found, lake)


@query(
    "first_row_peek",
    f"SELECT 'clientes' AS table_name, '{','.join(CUSTOMER_NAMES)}' AS header,"
    " count(*) AS n_rows FROM clientes"
    f" UNION ALL SELECT 'produtos', '{','.join(views.PRODUCT_NAMES)}', count(*) FROM produtos",
)
def headers(spark, sf_dir):
    lake = views.new_lake(spark)
    parts = []
    for name, rows in (
        ("clientes", views.customers(spark, sf_dir)),
        ("produtos", views.products(spark, sf_dir)),
    ):
        path = land_snapshot(rows, lake.stage_root, name, FIRST)
        parts.append(
            row_count(scan_stage(spark, path)).select(
                F.lit(name).alias("table_name"),
                F.lit(first_row_peek(spark, path)).alias("header"),
                F.col("rows").alias("n_rows"),
            )
        )
    return views.finished(union(parts), lake)


@query(
    "purge_stage",
    f"SELECT 'clientesxprod' AS table_name, {LOAD_DATE}, count(*) AS n_rows,"
    f" {LOAD_DATE} <> '{FIRST}' AS folder_gone, {LOAD_DATE} = '{FIRST}' AS late_file_kept"
    f" FROM vendas GROUP BY {LOAD_DATE}",
)
def purged(spark, sf_dir):
    """All dates are loaded and purged; files that come late for the first are kept."""
    lake = views.new_lake(spark)
    create_lake(spark, lake)
    dated = views.dated_acquisitions(spark, sf_dir)
    load = BRONZE_LOADS["clientesxprod"]
    parts = []
    for load_date in LOAD_DATES:
        rows = slice_of(dated, load_date).drop(LOAD_DATE)
        path = land_snapshot(rows, lake.stage_root, "clientesxprod", load_date)
        done = bronze_ingest(spark, lake, load, load_date)
        if load_date == FIRST:
            rows.write.mode("append").option("header", True).csv(path)
        outcome = purge_stage(spark, path, done.loaded)
        stored = slice_of(scan_table(spark, lake, config.ACQUISITIONS), load_date)
        parts.append(
            row_count(stored).select(
                F.lit("clientesxprod").alias("table_name"),
                F.lit(load_date).alias(LOAD_DATE),
                F.col("rows").alias("n_rows"),
                F.lit(outcome.deleted > 0 and outcome.kept == 0).alias("folder_gone"),
                F.lit(outcome.kept > 0).alias("late_file_kept"),
            )
        )
    return views.finished(union(parts), lake)


@query(
    "metrics_sink",
    "SELECT 'bronze' AS layer, 'clientesxprod' AS table_name, dat_ref_carga AS dat_carga,"
    " true AS success, count(*) AS number_lines_loaded, false AS alerta"
    " FROM vendas GROUP BY dat_ref_carga",
)
def stored_metrics(spark, sf_dir):
    """Three loads, as their documents in the ops table tell them."""
    lake = views.new_lake(spark)
    create_lake(spark, lake)
    dated = views.dated_acquisitions(spark, sf_dir)
    for load_date in LOAD_DATES:
        rows = slice_of(dated, load_date).drop(LOAD_DATE)
        land_snapshot(rows, lake.stage_root, "clientesxprod", load_date)
        bronze_ingest(spark, lake, BRONZE_LOADS["clientesxprod"], load_date)
    metrics = F.from_json(
        F.get_json_object("document", "$.metrics"), schemas.BRONZE_METRICS
    ).alias("m")
    runs = run_log(spark, lake).select("layer", "table_name", "dat_carga", "success", metrics)
    found = runs.select(
        "layer", "table_name", "dat_carga", "success", "m.number_lines_loaded", "m.alerta"
    )
    return views.finished(found, lake)
