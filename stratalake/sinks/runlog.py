"""Metrics and log entries of a run, and the table that keeps them."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager
from datetime import datetime, timezone
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake import schemas
from stratalake.config import LOAD_ZONE, Lake
from stratalake.operators.quality import complete

RUN_DOCUMENT = "layer string, table_name string, dat_carga string, success boolean, document string"

SUCCESS = "execution_succes"


class RunLog:
    """Metrics of one run of one table, filled in as the run goes."""

    def __init__(self, layer: str, table_name: str, load_date: str | None = None):
        self.layer = layer
        self.schema = schemas.BRONZE_METRICS if layer == "bronze" else schemas.REFINED_METRICS
        self.metrics: dict[str, object] = dict.fromkeys(self.schema.names)
        now = datetime.now(ZoneInfo(LOAD_ZONE))
        self.metrics.update(
            table_name=table_name,
            dat_carga=load_date,
            datetime_execution=now.strftime("%Y-%m-%d %H:%M:%S"),
        )
        self.metrics[SUCCESS] = True
        self.entries: list[tuple[str, str, str]] = []
        self._started = time.monotonic()

    def log(self, message: str, level: str = "INFO") -> None:
        stamp = datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        self.entries.append((stamp, level, message))

    def set(self, **metrics: object) -> None:
        for name, value in metrics.items():
            if name not in self.metrics:
                raise KeyError(f"{name!r} is no metric of a {self.layer} run")
            self.metrics[name] = value

    def log_unparsed(self, totals: Mapping[str, object], columns: Iterable[str]) -> None:
        """A warning for each column with values that did not parse as numbers."""
        for name in columns:
            if totals[f"unparsed_{name}"]:
                self.log(f"column {name} has {totals[f'unparsed_{name}']} unparsed values", "WARN")

    @contextmanager
    def timed(self, metric: str) -> Iterator[None]:
        """Seconds spent in the block."""
        started = time.monotonic()
        yield
        self.set(**{metric: time.monotonic() - started})

    def reconcile(self, loaded: int, in_slice: int) -> bool:
        """Alert when the slice does not hold the rows of this load."""
        alert = loaded != in_slice
        self.set(alerta=alert)
        if alert:
            self.log(f"{loaded} rows loaded, {in_slice} rows in the slice", "WARNING")
        return alert

    def reconcile_content(self, expected: object, found: object) -> bool:
        """Alert when the slice holds as many rows as it should, but not the same ones."""
        alert = expected != found
        self.set(alerta=alert)
        if alert:
            self.log("the slice holds other rows than were loaded", "WARNING")
        return alert

    def finish(self, error: Exception | None = None) -> dict[str, object]:
        self.set(total_execution=time.monotonic() - self._started)
        if error is not None:
            self.log(f"{type(error).__name__}: {error}", "ERROR")
        self.metrics[SUCCESS] = error is None and complete(self.metrics, SUCCESS)
        return dict(self.metrics)

    def metrics_row(self, spark: SparkSession) -> DataFrame:
        """The metrics as one row."""
        return self._row(spark).select("metrics.*")

    def document_row(self, spark: SparkSession) -> DataFrame:
        """The metrics and log entries as one JSON document, with the columns to find it by."""
        return self._row(spark).select(
            F.lit(self.layer).alias("layer"),
            F.col("metrics.table_name").alias("table_name"),
            F.col("metrics.dat_carga").alias("dat_carga"),
            F.col(f"metrics.{SUCCESS}").alias("success"),
            F.to_json(F.struct("logs", "metrics")).alias("document"),
        )

    def _row(self, spark: SparkSession) -> DataFrame:
        columns = T.StructType([
            T.StructField("metrics", self.schema),
            T.StructField("logs", T.ArrayType(schemas.LOG_ENTRY)),
        ])
        logs = [dict(zip(schemas.LOG_ENTRY.names, entry)) for entry in self.entries]
        text = json.dumps({"metrics": self.metrics, "logs": logs})
        parsed = F.from_json(F.lit(text), columns).alias("run")
        return spark.range(1).coalesce(1).select(parsed).select("run.*")


def run_log_path(lake: Lake) -> str:
    return f"{lake.root}/ops/run_log"


def metrics_sink(spark: SparkSession, lake: Lake, run: RunLog) -> None:
    """Add the document of a run to the ops table.

    Each run writes a folder of its own: loads run side by side, and two jobs that append to one
    folder share, and clear, one folder of temporary files.
    """
    folder = f"{run_log_path(lake)}/{run.layer}/{uuid.uuid4().hex}"
    run.document_row(spark).write.mode("errorifexists").parquet(folder)


def run_log(spark: SparkSession, lake: Lake) -> DataFrame:
    """All runs so far."""
    rows = spark.read.schema(RUN_DOCUMENT).option("recursiveFileLookup", True)
    return rows.parquet(run_log_path(lake))
