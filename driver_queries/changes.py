"""Changes between snapshots, current states, newest rows, and totals kept up to date."""

from __future__ import annotations

from pyspark.sql import functions as F

from driver_queries import views
from driver_queries.registry import query
from driver_queries.transforms import SQL_TOTALS, sql_silver
from driver_queries.views import CUSTOMER_NAMES, FIRST, SECOND
from stratalake import config
from stratalake.operators.changes import apply_changes, latest_per_key, snapshot_changes
from stratalake.plans.increments import BATCH, PARTIALS, differences, put_batch, refresh_totals
from stratalake.schemas import LOAD_DATE
from stratalake.sinks.tables import create_lake, write_slices
from stratalake.sources.tables import scan_table, slice_scan

# The second snapshot: each tenth customer is gone, each seventh has another job, each twentieth is new under
# another id. In Spark and in SQL alike.
_ID = "CAST(client_id AS BIGINT)"
_NEW_JOB = f"CASE WHEN {_ID} % 7 = 0 THEN concat('novo ', coalesce(cargo, '')) ELSE cargo END"
_NEW_ID = f"CAST({_ID} + 20000000 AS VARCHAR(20))"


def _columns(**changed: str) -> str:
    return ", ".join(f"{changed[c]} AS {c}" if c in changed else c for c in CUSTOMER_NAMES)


_SQL_SECOND = (
    f"SELECT {_columns(cargo=_NEW_JOB)} FROM clientes_limpos WHERE {_ID} % 10 <> 0"
    f" UNION ALL SELECT {_columns(client_id=_NEW_ID)} FROM clientes_limpos WHERE {_ID} % 20 = 0"
)


def _second(first):
    kept = first.where(f"{_ID} % 10 <> 0").selectExpr(*[
        f"{_NEW_JOB} AS cargo" if c == "cargo" else c for c in CUSTOMER_NAMES
    ])
    new = first.where(f"{_ID} % 20 = 0").selectExpr(*[
        f"{_NEW_ID} AS client_id" if c == "client_id" else c for c in CUSTOMER_NAMES
    ])
    return kept.unionByName(new)


def _two_slices(spark, sf_dir):
    """A lake with the customers of two dates."""
    lake = views.new_lake(spark)
    create_lake(spark, lake)
    first = views.clean_customers(spark, sf_dir)
    write_slices(spark, lake, config.CUSTOMERS, first, [FIRST])
    write_slices(spark, lake, config.CUSTOMERS, _second(first), [SECOND])
    return lake, *[slice_scan(spark, lake, config.CUSTOMERS, d, CUSTOMER_NAMES) for d in (FIRST, SECOND)]


@query(
    "snapshot_changes",
    f"SELECT 'delete' AS mudanca, {_columns()} FROM clientes_limpos WHERE {_ID} % 10 = 0"
    f" UNION ALL SELECT 'update', {_columns(cargo=_NEW_JOB)} FROM clientes_limpos"
    f" WHERE {_ID} % 10 <> 0 AND {_ID} % 7 = 0"
    f" UNION ALL SELECT 'insert', {_columns(client_id=_NEW_ID)} FROM clientes_limpos WHERE {_ID} % 20 = 0",
)
def changes(spark, sf_dir):
    """What changed between the customers of two dates."""
    lake, first, second = _two_slices(spark, sf_dir)
    return views.finished(snapshot_changes(first, second, ["client_id"]), lake)


@query("current_state", _SQL_SECOND)
def current_state(spark, sf_dir):
    """The first snapshot with the changes applied to it is the second one."""
    lake, first, second = _two_slices(spark, sf_dir)
    changed = views.stored(snapshot_changes(first, second, ["client_id"]))
    return views.finished(apply_changes(first, changed, ["client_id"]), lake)


@query(
    "latest_per_key",
    f"SELECT * FROM (SELECT *, '{SECOND}' AS {LOAD_DATE} FROM ({_SQL_SECOND}))"
    f" UNION ALL SELECT *, '{FIRST}' FROM clientes_limpos WHERE {_ID} % 10 = 0",
)
def newest_customers(spark, sf_dir):
    """The newest row of each customer over all dates: customers that are gone have their last one."""
    lake, _, _ = _two_slices(spark, sf_dir)
    return views.finished(latest_per_key(scan_table(spark, lake, config.CUSTOMERS), ["client_id"], [LOAD_DATE]), lake)


_SQL_SOLD = sql_silver("clientesxprod", "clientes_limpos", "produtos_limpos", "", "")
_BATCHES = ("a", "b", "c")
_PART = "CAST(split_part(id, '-', 1) AS BIGINT) % 3"
_SQL_MISTAKEN = sql_silver(
    f"(SELECT * FROM clientesxprod WHERE {_PART} = 2)", "clientes_limpos", "produtos_limpos", "", ""
)


def _batched(spark, sf_dir):
    """Three batches of one date, of which the second came wrong first and is then replaced; its sums before and after."""
    lake = views.new_lake(spark)
    create_lake(spark, lake)
    write_slices(spark, lake, config.PRODUCTS, views.clean_products(spark, sf_dir), [FIRST])
    rows = views.stored(views.acquisitions(spark, sf_dir))
    batches = {name: rows.where(f"{_PART} = {i}") for i, name in enumerate(_BATCHES)}
    wrong = batches["b"].unionByName(batches["c"])
    for name, batch in (batches | {"b": wrong}).items():
        put_batch(spark, lake, FIRST, name, batch)
    refresh_totals(spark, lake, FIRST)
    sums = slice_scan(spark, lake, PARTIALS, FIRST).where(F.col(BATCH) == "b")
    before = views.stored(sums)
    put_batch(spark, lake, FIRST, "b", batches["b"])
    after = views.stored(slice_scan(spark, lake, PARTIALS, FIRST).where(F.col(BATCH) == "b"))
    refresh_totals(spark, lake, FIRST)
    return lake, before, after


@query(
    "incremental_totals",
    f"SELECT prod_contratado, {SQL_TOTALS}, '{FIRST}' AS {LOAD_DATE} FROM ({_SQL_SOLD}) GROUP BY prod_contratado",
)
def incremental_totals(spark, sf_dir):
    """Gold from the sums of three batches, one of them replaced: the same as a full rebuild."""
    lake, *_ = _batched(spark, sf_dir)
    return views.finished(scan_table(spark, lake, config.PRODUCT_TOTALS), lake)


@query(
    "signed_differences",
    "SELECT prod_contratado, -CAST(sum(TRY_CAST(valor_prod_contratado AS DECIMAL(28,2))) AS DOUBLE) AS valor,"
    " -CAST(sum(TRY_CAST(limite_credito AS DECIMAL(28,2))) AS DOUBLE) AS limite, -count(*) AS linhas"
    f" FROM ({_SQL_MISTAKEN}) GROUP BY prod_contratado",
)
def signed_differences(spark, sf_dir):
    """The difference that the replaced batch makes: less the rows that were in it by mistake."""
    lake, before, after = _batched(spark, sf_dir)
    found = differences(before, after).withColumns({c: F.col(c).cast("double") for c in ("valor", "limite")})
    return views.finished(found, lake)
