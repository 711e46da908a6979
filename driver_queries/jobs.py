"""Quality checks, run metrics, the layer jobs and arrivals."""

from __future__ import annotations

from dataclasses import replace
from unittest.mock import patch

from pyspark.sql import functions as F

from driver_queries import views
from driver_queries.registry import query
from driver_queries.sources import header_bytes, land_by_date, union
from driver_queries.transforms import SQL_TOTALS, sql_silver
from driver_queries.views import FIRST, LOAD_DATES, SECOND, THIRD
from stratalake import config
from stratalake.config import BRONZE_LOADS
from stratalake.errors import JobFailed, QualityError
from stratalake.operators.profile import FILE_SKETCH_ERROR, distinct_file_count, null_counts, row_count
from stratalake.operators.quality import (
    metrics_complete,
    null_report,
    reconcile,
    reconcile_content,
    required_columns,
)
from stratalake.plans.bronze import bronze_ingest
from stratalake.plans.gold import gold_product_totals
from stratalake.plans.run import run_layers
from stratalake.plans.silver import CUSTOMER_INPUT, PRODUCT_INPUT, silver_credit_customers
from stratalake.schemas import BRONZE_METRICS, LOAD_DATE, REFINED_METRICS, SILVER_COLUMNS
from stratalake.sinks.ledger import Ledger
from stratalake.sinks.runlog import run_log
from stratalake.sinks.stage import land_snapshot, purge_stage, snapshot_export
from stratalake.sinks.tables import create_database, create_lake, write_slices
from stratalake.sources.stage import inline_rows, list_files, scan_stage, stage_path
from stratalake.sources.tables import scan_table, slice_of
from stratalake.streaming.arrival import ARRIVAL, arrival_ingest, arrival_table
from stratalake.workspace import delete_path, folder_entries, move_file, new_folder


def land_masters(spark, sf_dir, lake, load_date: str) -> None:
    """Land the exports of customers and products."""
    land_snapshot(views.customers(spark, sf_dir), lake.stage_root, "clientes", load_date)
    land_snapshot(views.products(spark, sf_dir), lake.stage_root, "produtos", load_date)


def land_exports(spark, sf_dir, lake) -> None:
    """Land the three whole exports under one load date."""
    land_masters(spark, sf_dir, lake, FIRST)
    land_snapshot(views.acquisitions(spark, sf_dir), lake.stage_root, "clientesxprod", FIRST)


# Counts of files and checks


@query(
    "distinct_file_count",
    "SELECT count(*) AS \"rows\", true AS all_files_read FROM clientesxprod",
)
def files_read(spark, sf_dir):
    """The files that give rows are those a listing finds with more than a header."""
    lake = views.new_lake(spark)
    rows = views.acquisitions(spark, sf_dir)
    path = land_snapshot(rows, lake.stage_root, "clientesxprod", FIRST)
    scan = scan_stage(spark, path)
    filled = list_files(spark, path).where(F.col("length") > header_bytes(scan.columns))
    listed = row_count(filled).first()["rows"]
    read = distinct_file_count(scan).first()["num_files"]
    counted = row_count(scan).withColumn("all_files_read", F.lit(read == listed))
    return views.finished(counted, lake)


@query(
    "sketched_file_count",
    "SELECT count(*) AS \"rows\", CAST(300 AS BIGINT) AS num_files, true AS within_bound FROM clientesxprod",
)
def files_sketched(spark, sf_dir):
    """Three hundred files, counted exactly and by a sketch whose error is bounded."""
    path = f"{views.new_lake(spark).stage_root}/many"
    views.acquisitions(spark, sf_dir).repartition(300).write.csv(path, header=True)
    scan = scan_stage(spark, path)
    exact = distinct_file_count(scan).first()["num_files"]
    about = distinct_file_count(scan, sketch=True).first()["num_files"]
    within = abs(about - exact) <= FILE_SKETCH_ERROR * exact
    counted = row_count(scan).withColumns({"num_files": F.lit(exact).cast("long"), "within_bound": F.lit(within)})
    return views.stored(counted)


@query(
    "required_columns",
    "SELECT 'nome,cpf' AS required, 'ok' AS outcome, count(*) AS n_rows FROM clientes"
    " UNION ALL SELECT 'nome,documento', 'rejected', CAST(0 AS BIGINT)",
)
def required(spark, sf_dir):
    customers = views.customers(spark, sf_dir)
    parts = []
    for names in (["nome", "cpf"], ["nome", "documento"]):
        try:
            required_columns(customers.columns, names)
            counted = row_count(customers).select(F.lit("ok").alias("outcome"), "rows")
        except QualityError:
            counted = inline_rows(spark, [("rejected", 0)], "outcome string, rows bigint")
        parts.append(
            counted.select(
                F.lit(",".join(names)).alias("required"),
                "outcome",
                F.col("rows").alias("n_rows"),
            )
        )
    return union(parts)


@query(
    "required_not_null",
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls,"
        f" {'true' if c in ('nome', 'cpf', 'cargo') else 'false'} AS required,"
        f" CASE WHEN count(*) = count({c}) THEN 'ok'"
        f" ELSE '{'error' if c in ('nome', 'cpf', 'cargo') else 'noted'}' END AS verdict"
        " FROM clientes_limpos"
        for c in views.CUSTOMER_NAMES
    ),
)
def verdicts(spark, sf_dir):
    counts = null_counts(views.clean_customers(spark, sf_dir))
    return null_report(counts, ("nome", "cpf", "cargo"))


@query(
    "reconcile",
    "SELECT 'replace_slice' AS mode, dat_ref_carga, count(*) AS rows_loaded,"
    " count(*) AS rows_in_slice, false AS alert FROM vendas GROUP BY dat_ref_carga"
    " UNION ALL SELECT 'append', dat_ref_carga, count(*), 2 * count(*), true"
    " FROM vendas GROUP BY dat_ref_carga",
)
def reconciled(spark, sf_dir):
    """Loading all slices twice raises the alert when they are appended."""
    rows = views.stored(views.dated_acquisitions(spark, sf_dir))
    parts = []
    for mode in ("replace_slice", "append"):
        lake = views.new_lake(spark)
        create_database(spark, lake, config.ACQUISITIONS.database)
        for _ in range(2):
            write_slices(spark, lake, config.ACQUISITIONS, rows, LOAD_DATES, mode)
        stored = scan_table(spark, lake, config.ACQUISITIONS)
        checks = [
            reconcile(slice_of(rows, d), slice_of(stored, d)).withColumns(
                {"mode": F.lit(mode), LOAD_DATE: F.lit(d)}
            )
            for d in LOAD_DATES
        ]
        parts.append(views.finished(union(checks), lake))
    return union(parts)


@query(
    "column_count",
    "SELECT 'clientes' AS table_name, 22 AS n_columns, count(*) AS n_rows FROM clientes_datas"
    " UNION ALL SELECT 'produtos', 17, count(*) FROM produtos_datas"
    " UNION ALL SELECT 'clientesxprod', 6, count(*) FROM vendas",
)
def column_counts(spark, sf_dir):
    lake = views.bronze_lake(spark, sf_dir)
    parts = []
    for table in (config.CUSTOMERS, config.PRODUCTS, config.ACQUISITIONS):
        stored = scan_table(spark, lake, table)
        parts.append(
            row_count(stored).select(
                F.lit(table.name).alias("table_name"),
                F.lit(len(stored.columns)).alias("n_columns"),
                F.col("rows").alias("n_rows"),
            )
        )
    return union(parts)


def _run_all_loads(spark, sf_dir):
    """Land and ingest the three sources of one date; the documents of the runs."""
    lake = views.new_lake(spark)
    create_lake(spark, lake)
    land_exports(spark, sf_dir, lake)
    for load in BRONZE_LOADS.values():
        bronze_ingest(spark, lake, load, FIRST)
    document = F.get_json_object("document", "$.metrics")
    runs = run_log(spark, lake).select(F.from_json(document, BRONZE_METRICS).alias("m"))
    return views.finished(runs, lake)


def _sql_chars(source: str, columns: list[str]) -> str:
    """SQL for the text size, in megabytes, of rows written out with their names; nulls as None."""
    fixed = len("Row()") + len(", ") * (len(columns) - 1) + sum(len(c) + 1 for c in columns)
    values = " + ".join(f"coalesce(length({c}) + 2, 4)" for c in columns)
    return f"(SELECT round(sum({fixed} + {values}) / 1048576.0, 2) FROM {source})"


_DATED = {
    "clientes": f"(SELECT *, '{FIRST}' AS {LOAD_DATE} FROM clientes)",
    "produtos": f"(SELECT *, '{FIRST}' AS {LOAD_DATE} FROM produtos)",
    "clientesxprod": f"(SELECT *, '{FIRST}' AS {LOAD_DATE} FROM clientesxprod)",
}
_READ_BY_SILVER = {
    "clientes_limpos": CUSTOMER_INPUT,
    "produtos_limpos": PRODUCT_INPUT,
    _DATED["clientesxprod"]: [*views.ACQUISITION_NAMES, LOAD_DATE],
}
_SILVER_OF_DATE = f"({sql_silver('clientesxprod', 'clientes_limpos', 'produtos_limpos', '', '')})"


@query(
    "run_metrics",
    " UNION ALL ".join([
        *(
            f"SELECT 'bronze' AS layer, '{name}' AS table_name, count(*) AS rows_read, count(*) AS rows_in_slice,"
            f" CAST({columns} AS BIGINT) AS num_columns_table,"
            f" {_sql_chars(_DATED[name], [*names, LOAD_DATE])} AS data_size_mb_formatted,"
            f" true AS files_counted, true AS timed, '{FIRST}' AS dat_carga, false AS alerta,"
            f" true AS execution_succes, true AS stamped FROM {name}"
            for name, columns, names in (
                ("clientes", 22, views.CUSTOMER_NAMES),
                ("produtos", 17, views.PRODUCT_NAMES),
                ("clientesxprod", 6, views.ACQUISITION_NAMES),
            )
        ),
        f"SELECT 'silver', 'clie_limit', count(*), count(*), CAST(13 AS BIGINT),"
        f" {{silver_mb}}, true, true, '{FIRST}', false, true, true FROM {_SILVER_OF_DATE}",
        f"SELECT 'gold', 'prod_contrat_diario', count(*), count(*), CAST(4 AS BIGINT),"
        f" {{gold_mb}}, true, true, '{FIRST}', false, true, true"
        f" FROM (SELECT DISTINCT prod_contratado FROM {_SILVER_OF_DATE})",
    ])
    .replace(
        "{silver_mb}",
        "(SELECT round((" + " + ".join(
            _sql_chars(source, list(names)).replace("round(sum(", "sum(").replace(" / 1048576.0, 2)", "")
            for source, names in _READ_BY_SILVER.items()
        ) + ") / 1048576.0, 2))",
    )
    .replace(
        "{gold_mb}",
        _sql_chars(
            f"(SELECT *, '{FIRST}' AS {LOAD_DATE} FROM {_SILVER_OF_DATE})", [n for n, _ in SILVER_COLUMNS] + [LOAD_DATE]
        ),
    ),
)
def run_metrics(spark, sf_dir):
    """The metrics of one date in all layers; clocks and file counts by whether they are there."""
    lake = views.new_lake(spark)
    create_lake(spark, lake)
    land_exports(spark, sf_dir, lake)
    run_layers(spark, lake, FIRST)
    document = F.get_json_object("document", "$.metrics")
    parts = []
    for schema, layers, read, in_slice in (
        (BRONZE_METRICS, ("bronze",), "number_lines_loaded", "qtd_total_rows_insert"),
        (REFINED_METRICS, ("silver", "gold"), "qtd_total_rows_insert", "qts_total_rows_insert_verify"),
    ):
        runs = run_log(spark, lake).where(F.col("layer").isin(*layers))
        metrics = runs.select("layer", F.from_json(document, schema).alias("m"))
        clocks = [F.col(f"m.{c}") >= 0 for c in ("load_total_time", "write_total_time", "total_execution")]
        parts.append(
            metrics.select(
                "layer",
                "m.table_name",
                F.col(f"m.{read}").alias("rows_read"),
                F.col(f"m.{in_slice}").alias("rows_in_slice"),
                "m.num_columns_table",
                "m.data_size_mb_formatted",
                (F.col("m.num_files") > 0).alias("files_counted"),
                (clocks[0] & clocks[1] & clocks[2]).alias("timed"),
                "m.dat_carga",
                "m.alerta",
                "m.execution_succes",
                F.col("m.datetime_execution").isNotNull().alias("stamped"),
            )
        )
    return views.finished(union(parts), lake)


@query(
    "stage_timing",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS number_lines_loaded, true AS load_timed,"
        f" true AS write_timed, true AS parts_within_total FROM {source}"
        for name, source in (
            ("clientes", "clientes"),
            ("produtos", "produtos"),
            ("clientesxprod", "vendas"),
        )
    ),
)
def stage_timing(spark, sf_dir):
    load, write, total = "m.load_total_time", "m.write_total_time", "m.total_execution"
    return _run_all_loads(spark, sf_dir).select(
        "m.table_name",
        "m.number_lines_loaded",
        (F.col(load) > 0).alias("load_timed"),
        (F.col(write) > 0).alias("write_timed"),
        (F.col(load) + F.col(write) <= F.col(total)).alias("parts_within_total"),
    )


@query(
    "metrics_complete",
    "SELECT 'clientes' AS table_name, false AS success, false AS complete,"
    " count(*) AS number_lines_loaded FROM clientes"
    " UNION ALL SELECT 'produtos', true, true, count(*) FROM produtos",
)
def complete_metrics(spark, sf_dir):
    """One load fails, since a column it requires has nulls; its metrics are kept, incomplete."""
    lake = views.new_lake(spark)
    create_lake(spark, lake)
    land_exports(spark, sf_dir, lake)
    strict = replace(BRONZE_LOADS["clientes"], required=("nome", "cargo"))
    for load in (strict, BRONZE_LOADS["produtos"]):
        try:
            bronze_ingest(spark, lake, load, FIRST)
        except JobFailed:
            pass
    metrics = F.from_json(F.get_json_object("document", "$.metrics"), BRONZE_METRICS)
    runs = run_log(spark, lake).select("table_name", "success", metrics.alias("m"))
    names = [f"m.{name}" for name in BRONZE_METRICS.names]
    found = runs.select(
        "table_name",
        "success",
        metrics_complete(names, "m.execution_succes").alias("complete"),
        "m.number_lines_loaded",
    )
    return views.finished(found, lake)


@query(
    "reconcile_content",
    "SELECT dat_ref_carga, count(*) AS rows_loaded, count(*) AS rows_in_slice, false AS count_alert,"
    f" dat_ref_carga <> '{FIRST}' AS alert FROM vendas GROUP BY dat_ref_carga",
)
def reconciled_content(spark, sf_dir):
    """In every slice but the first a row is lost and another doubled: counts agree, contents do not."""
    lake = views.new_lake(spark)
    create_database(spark, lake, config.ACQUISITIONS.database)
    rows = views.stored(views.dated_acquisitions(spark, sf_dir))
    parts = []
    for load_date in LOAD_DATES:
        loaded = slice_of(rows, load_date)
        stored = loaded
        if load_date != FIRST:
            single = loaded.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n = 1")
            ends = single.agg(F.min("id").alias("lost"), F.max("id").alias("doubled")).first()
            doubled = loaded.where(F.col("id") == ends["doubled"])
            stored = loaded.where(F.col("id") != ends["lost"]).unionByName(doubled)
        write_slices(spark, lake, config.ACQUISITIONS, stored, [load_date])
        found = slice_of(scan_table(spark, lake, config.ACQUISITIONS), load_date)
        parts.append(reconcile_content(loaded, found).withColumn(LOAD_DATE, F.lit(load_date)))
    return views.finished(union(parts), lake)


_STRICT = replace(BRONZE_LOADS["clientes"], required=("nome", "cargo"), bad_rows="quarantine")


def _quarantined(spark, sf_dir):
    lake = views.new_lake(spark)
    create_lake(spark, lake)
    land_masters(spark, sf_dir, lake, FIRST)
    done = bronze_ingest(spark, lake, _STRICT, FIRST)
    return lake, done


@query(
    "quarantine_good",
    f"SELECT *, '{FIRST}' AS {LOAD_DATE} FROM clientes_limpos WHERE cargo IS NOT NULL",
)
def quarantine_good(spark, sf_dir):
    """Of a load that requires a column with nulls, the good rows."""
    lake, _ = _quarantined(spark, sf_dir)
    return views.finished(scan_table(spark, lake, config.CUSTOMERS), lake)


@query(
    "quarantine_rejects",
    "SELECT client_id, 'cargo is null' AS motivo, true AS from_a_staged_file, true AS adds_up,"
    f" '{FIRST}' AS {LOAD_DATE} FROM clientes_limpos WHERE cargo IS NULL",
)
def quarantine_rejects(spark, sf_dir):
    """Of the same load the refused rows, by the first value of their text; both add up to the input."""
    lake, done = _quarantined(spark, sf_dir)
    good = row_count(scan_table(spark, lake, config.CUSTOMERS)).first()["rows"]
    rejects = scan_table(spark, lake, config.rejects_of(config.CUSTOMERS))
    folder = stage_path(lake.stage_root, "clientes", FIRST)
    found = rejects.select(
        F.split("registro", ",")[0].alias("client_id"),
        "motivo",
        F.col("arquivo").contains(folder).alias("from_a_staged_file"),
        F.lit(good + done.rejected == done.profile.rows).alias("adds_up"),
        LOAD_DATE,
    )
    return views.finished(found, lake)


# Jobs


@query(
    "bronze_configs",
    "SELECT 'clientes' AS table_name, 'b_cad' AS database_name, 'nome,cpf' AS required,"
    " count(*) AS n_rows FROM clientes"
    " UNION ALL SELECT 'produtos', 'b_cad', 'produto_id,nome,descricao,categoria', count(*)"
    " FROM produtos"
    " UNION ALL SELECT 'clientesxprod', 'b_vend', 'cliente_id,produto_id', count(*)"
    " FROM vendas",
)
def configured_loads(spark, sf_dir):
    """Every configured source, loaded as configured."""
    lake = views.new_lake(spark)
    create_lake(spark, lake)
    land_exports(spark, sf_dir, lake)
    parts = []
    for load in BRONZE_LOADS.values():
        bronze_ingest(spark, lake, load, FIRST)
        parts.append(
            row_count(scan_table(spark, lake, load.table)).select(
                F.lit(load.table.name).alias("table_name"),
                F.lit(load.table.database).alias("database_name"),
                F.lit(",".join(load.required)).alias("required"),
                F.col("rows").alias("n_rows"),
            )
        )
    return views.finished(union(parts), lake)


@query("bronze_ingest", "SELECT * FROM clientes_datas")
def ingested(spark, sf_dir):
    """All dates loaded from CSV, the second one twice."""
    lake = views.new_lake(spark)
    create_lake(spark, lake)
    customers = views.customers(spark, sf_dir)
    for load_date in LOAD_DATES:
        land_snapshot(customers, lake.stage_root, "clientes", load_date)
    for load_date in (*LOAD_DATES, SECOND):
        bronze_ingest(spark, lake, BRONZE_LOADS["clientes"], load_date)
    delete_path(spark, lake.stage_root)
    return scan_table(spark, lake, config.CUSTOMERS)


SQL_SILVER_DATES = sql_silver(
    "vendas",
    "clientes_datas",
    "produtos_datas",
    f" AND {{side}}.{LOAD_DATE} = v.{LOAD_DATE}",
    f", v.{LOAD_DATE}",
).replace(
    "DATE '2025-04-15'", f"CAST(strptime(v.{LOAD_DATE}, '%Y%m%d') AS DATE)"
)


@query("silver_credit_customers", SQL_SILVER_DATES)
def silver(spark, sf_dir):
    """The silver table after a run for each load date."""
    lake = views.bronze_lake(spark, sf_dir)
    for load_date in LOAD_DATES:
        silver_credit_customers(spark, lake, load_date)
    return scan_table(spark, lake, config.CREDIT_CUSTOMERS)


SQL_GOLD = (
    f"SELECT prod_contratado, {SQL_TOTALS}, {LOAD_DATE} FROM ({SQL_SILVER_DATES})"
    f" GROUP BY prod_contratado, {LOAD_DATE}"
)


@query("gold_product_totals", SQL_GOLD)
def gold(spark, sf_dir):
    """The gold table after a run for each load date."""
    lake = views.silver_lake(spark, sf_dir)
    for load_date in LOAD_DATES:
        gold_product_totals(spark, lake, load_date)
    return scan_table(spark, lake, config.PRODUCT_TOTALS)


@query("run_layers", SQL_GOLD)
def all_layers(spark, sf_dir):
    """All dates landed, and each taken from the stage to gold."""
    lake = views.new_lake(spark)
    land_by_date(spark, sf_dir, lake)
    for load_date in LOAD_DATES:
        land_masters(spark, sf_dir, lake, load_date)
        run_layers(spark, lake, load_date)
    return views.finished(scan_table(spark, lake, config.PRODUCT_TOTALS), lake)


@query("arrivals_to_gold", SQL_GOLD)
def arrivals_to_gold(spark, sf_dir):
    """All sources of all dates arrive, and each date is taken to gold from what has arrived."""
    lake = views.new_lake(spark)
    create_lake(spark, lake)
    land_by_date(spark, sf_dir, lake)
    for load_date in LOAD_DATES:
        land_masters(spark, sf_dir, lake, load_date)
    arrived = {}
    for name, load in BRONZE_LOADS.items():
        arrival_ingest(spark, lake, load, new_folder(spark, "arrivals"))
        arrived[name] = arrival_table(load)
    for load_date in LOAD_DATES:
        silver_credit_customers(
            spark,
            lake,
            load_date,
            customers_table=arrived["clientes"],
            products_table=arrived["produtos"],
            acquisitions_table=arrived["clientesxprod"],
        )
        gold_product_totals(spark, lake, load_date)
    return views.finished(scan_table(spark, lake, config.PRODUCT_TOTALS), lake)


@query("late_files", "SELECT * FROM clientesxprod")
def late_files(spark, sf_dir):
    """Half of an export is loaded and purged before the other half lands; a third run adds nothing."""
    lake = views.new_lake(spark)
    create_lake(spark, lake)
    rows = views.stored(views.acquisitions(spark, sf_dir))
    load = BRONZE_LOADS["clientesxprod"]
    folder = stage_path(lake.stage_root, "clientesxprod", FIRST)
    early = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    snapshot_export(rows.where(early), folder)
    done = bronze_ingest(spark, lake, load, FIRST)
    snapshot_export(rows.where(~early), f"{lake.stage_root}/late")
    for name, _ in folder_entries(spark, f"{lake.stage_root}/late"):
        if not name.endswith("_SUCCESS"):
            move_file(spark, name, folder)
    purge_stage(spark, folder, done.loaded)
    for _ in range(2):
        bronze_ingest(spark, lake, load, FIRST)
    return views.finished(scan_table(spark, lake, config.ACQUISITIONS).drop(LOAD_DATE), lake)


class _Died(Exception):
    """Stands for the death of a run."""


def _die_before_the_end(*_):
    raise _Died


@query(
    "crash_safe_load",
    "SELECT id, cliente_id, produto_id, data_aquisicao, valor_aquisicao, false AS alert FROM clientesxprod",
)
def crash_safe_load(spark, sf_dir):
    """Late files are written and committed by a run that dies before it notes that; the next run repeats it."""
    lake = views.new_lake(spark)
    create_lake(spark, lake)
    rows = views.stored(views.acquisitions(spark, sf_dir))
    load = BRONZE_LOADS["clientesxprod"]
    folder = stage_path(lake.stage_root, "clientesxprod", FIRST)
    early = F.pmod(F.xxhash64("id"), F.lit(2)) == 0
    snapshot_export(rows.where(early), folder)
    done = bronze_ingest(spark, lake, load, FIRST)
    purge_stage(spark, folder, done.loaded)
    snapshot_export(rows.where(~early), folder)
    with patch.object(Ledger, "end", _die_before_the_end):
        try:
            bronze_ingest(spark, lake, load, FIRST)
        except JobFailed:
            pass
    repeated = bronze_ingest(spark, lake, load, FIRST)
    found = scan_table(spark, lake, config.ACQUISITIONS).drop(LOAD_DATE)
    return views.finished(found.withColumn("alert", F.lit(repeated.metrics["alerta"])), lake)


@query("arrival_ingest", "SELECT * FROM vendas")
def arrivals(spark, sf_dir):
    """Two dates arrive, then a third; each file is read once."""
    lake = views.new_lake(spark)
    load = BRONZE_LOADS["clientesxprod"]
    checkpoint = new_folder(spark, "arrivals")
    for dates in ((FIRST, SECOND), (THIRD,)):
        land_by_date(spark, sf_dir, lake, dates)
        arrival_ingest(spark, lake, load, checkpoint)
    delete_path(spark, lake.stage_root)
    return scan_table(spark, lake, arrival_table(load)).drop(ARRIVAL)
