"""One load date through all layers."""

from __future__ import annotations

from collections.abc import Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date

from pyspark.sql import SparkSession

from stratalake.config import BRONZE_LOADS, BronzeLoad, Lake
from stratalake.errors import JobFailed
from stratalake.plans.bronze import BronzeRun, bronze_ingest
from stratalake.plans.gold import gold_product_totals
from stratalake.plans.silver import silver_credit_customers
from stratalake.sinks.stage import purge_stage
from stratalake.sinks.tables import create_lake
from stratalake.sources.stage import stage_path


def _load_and_purge(
    spark: SparkSession, lake: Lake, load: BronzeLoad, load_date: str, purge: bool
) -> BronzeRun:
    done = bronze_ingest(spark, lake, load, load_date)
    if purge:
        if done.metrics["alerta"]:
            raise JobFailed(f"{load.table.name} holds other rows than were loaded; stage kept")
        folder = stage_path(lake.stage_root, load.table.name, load_date)
        purge_stage(spark, folder, done.loaded)
    return done


def run_layers(
    spark: SparkSession,
    lake: Lake,
    load_date: str,
    *,
    loads: Mapping[str, BronzeLoad] = BRONZE_LOADS,
    as_of: date | None = None,
    purge: bool = True,
) -> dict[str, dict[str, object]]:
    """Load the sources, then build silver, then gold, and return the metrics by table.

    The sources load side by side and each stage folder is purged once its load is reconciled.
    Silver waits for all of them. The first failure stops the run.
    """
    create_lake(spark, lake)
    metrics: dict[str, dict[str, object]] = {}
    with ThreadPoolExecutor(max_workers=len(loads)) as pool:
        running = {
            name: pool.submit(_load_and_purge, spark, lake, load, load_date, purge)
            for name, load in loads.items()
        }
        for name, future in running.items():
            metrics[name] = future.result().metrics
    silver = silver_credit_customers(spark, lake, load_date, as_of=as_of)
    metrics[silver["table_name"]] = silver
    gold = gold_product_totals(spark, lake, load_date)
    metrics[gold["table_name"]] = gold
    return metrics
