"""Totals by product."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from stratalake import config
from stratalake.config import Lake
from stratalake.errors import JobFailed
from stratalake.functions.amounts import amount
from stratalake.operators.profile import (
    megabytes,
    row_chars,
    sampled_row_chars,
    unparsed_counts,
)
from stratalake.operators.totals import product_totals
from stratalake.sinks.runlog import RunLog, metrics_sink
from stratalake.sinks.tables import audit_slice, write_slices
from stratalake.sources.tables import slice_scan

#: Columns whose amounts are summed.
_SUMMED = ("valor_prod_contratado", "limite_credito")


def gold_product_totals(
    spark: SparkSession,
    lake: Lake,
    load_date: str,
    *,
    mode: str = "replace_slice",
    extra_keys: Sequence[str] = (),
    source: config.LakeTable = config.CREDIT_CUSTOMERS,
    table: config.LakeTable = config.PRODUCT_TOTALS,
) -> dict[str, object]:
    """Build the gold slice of one load date from its silver slice."""
    run = RunLog("gold", table.name, load_date)
    try:
        with run.timed("load_total_time"):
            sales = slice_scan(spark, lake, source, load_date)
        # The text size of the input rides along with the sums, so the slice is read once.
        counts = unparsed_counts(dict.fromkeys(_SUMMED, amount))
        totals = product_totals(
            sales,
            extra_keys,
            F.sum(row_chars(sales.schema)).alias("__chars"),
            *[count.alias(f"__{name}") for name, count in counts.items()],
        )
        with run.timed("write_total_time"):
            found = write_slices(
                spark,
                lake,
                table,
                totals,
                [load_date],
                mode,
                totals={
                    name: F.coalesce(F.sum(f"__{name}"), F.lit(0)) for name in ("chars", *counts)
                },
                rows_per_file=lake.rows_per_file(sampled_row_chars(sales)),
            )
        run.log_unparsed(found, _SUMMED)
        written = found["rows"]
        run.set(data_size_mb_formatted=megabytes(found["chars"]))
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
        raise JobFailed(f"gold build for {load_date} failed: {error}") from error
    metrics_sink(spark, lake, run)
    return metrics
