"""Ingest of dated stage files to a bronze table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.config import BronzeLoad, Lake, rejects_of
from stratalake.errors import BadInput, JobFailed
from stratalake.operators.profile import (
    LoadProfile,
    data_columns,
    load_profile,
    measured,
    profile_load,
    profile_totals,
    rejected_rows,
    sampled_row_chars,
)
from stratalake.operators.quality import (
    REQUIRED_IS_NULL,
    fail_on_null,
    refusal,
    required_columns,
    required_not_null,
)
from stratalake.schemas import LOAD_DATE
from stratalake.sinks.compact import finish_compaction
from stratalake.sinks.ledger import (
    Fingerprint,
    Ledger,
    Load,
    Plan,
    StagedFile,
    same_form,
    staged_files,
)
from stratalake.sinks.runlog import RunLog, metrics_sink
from stratalake.sinks.tables import audit_slice, drop_slice, slice_path, table_exists, write_slices
from stratalake.sources.stage import FILE, RAGGED, scan_stage, stage_path


@dataclass(frozen=True)
class BronzeRun:
    """Metrics of a load, what its profile found, the files it read, and how many rows it refused."""

    metrics: dict[str, object]
    profile: LoadProfile
    loaded: list[StagedFile]
    rejected: int = 0

    @property
    def input_files(self) -> list[str]:
        return [f.path for f in self.loaded]


def _write(
    spark: SparkSession,
    lake: Lake,
    load: BronzeLoad,
    rows: DataFrame,
    load_date: str,
    mode: str,
    totals: dict[str, Column],
    **how: object,
) -> dict[str, object] | None:
    """Write a load and return its totals; None when a required column turned out to hold nulls."""
    if load.bad_rows == "quarantine":
        misfit = F.col(RAGGED) if load.refuse_ragged else None
        how["kept"] = refusal(load.required, misfit).isNull()
    else:
        rows = fail_on_null(rows, load.required)
    try:
        return write_slices(spark, lake, load.table, rows, [load_date], mode, totals=totals, **how)
    except PySparkException as error:
        if REQUIRED_IS_NULL in str(error):
            return None
        raise


def _scanned(spark: SparkSession, load: BronzeLoad, folder: str, plan: Plan) -> DataFrame:
    """The files of a plan: the folder as a whole where they are all it holds, else each by the name it was listed by."""

    def scan(path: str | list[str]) -> DataFrame:
        return scan_stage(
            spark, path, load.file_type, sep=load.sep, multiline=load.multiline, options=load.read_options, ragged=True
        )

    if not plan.read or not (plan.late or load.multiline):
        found = scan(folder)
        if not plan.read or {same_form(f) for f in found.inputFiles()} == {f.key for f in plan.read}:
            return found
    # Some files are loaded already, or came after the listing.
    return scan([f.path for f in plan.read])


def bronze_ingest(
    spark: SparkSession, lake: Lake, load: BronzeLoad, load_date: str, *, mode: str | None = None
) -> BronzeRun:
    """Load the stage folder of one table and date.

    The input is read once: what the metrics need is counted by the tasks that write. A null in a
    required column, or a record that does not fit its header, fails the write before anything is
    committed; only then is the input read again, to count the nulls. A load that quarantines writes the good rows and
    counts the bad ones in that pass; only where there are some, a second pass writes them to the rejects. The
    metrics row is written whether the load succeeds or not.

    A slice is replaced as long as all files it was loaded from are still staged. Once some have been
    purged, only files it has not been loaded from are read, and added; where there are none, the slice
    stays as it is. A load without rows never replaces a slice that has some.

    The stage folder is listed once, before it is read; that listing is what the load remembers and what a purge
    may delete. A run that dies at any point can be repeated: what it had written is undone first.
    """
    table, rejects = load.table, rejects_of(load.table)
    mode = mode or load.mode
    if load.bad_rows not in ("fail", "quarantine") or load.verify not in ("content", "rows"):
        raise ValueError(f"unknown choice: bad_rows={load.bad_rows!r}, verify={load.verify!r}")
    run = RunLog("bronze", table.name, load_date)
    begun = None
    try:
        folder = stage_path(lake.stage_root, table.name, load_date)
        existed = table_exists(spark, lake, table)
        run.log(f"table {table.full_name(lake)} {'exists' if existed else 'is new'}")
        if finish_compaction(spark, lake, table, load_date):
            run.log("a compaction that was cut off is finished", "WARN")
        ledger = Ledger(spark, lake, table, load_date)
        staged = staged_files(spark, folder)
        written_to = [slice_path(lake, t, load_date) for t in (table, rejects)]
        plan = ledger.plan(staged, written_to, appends=mode == "append")
        if plan.undone:
            run.log(f"{plan.undone} files of a load that was cut off are undone", "WARN")
            for name in (t.full_name(lake) for t in (table, rejects) if table_exists(spark, lake, t)):
                spark.catalog.refreshTable(name)
        with run.timed("load_total_time"):
            scan = _scanned(spark, load, folder, plan)
        rows = measured(scan, F.lit(load_date), load.null_markers).drop(LOAD_DATE)
        columns = data_columns(rows)
        required_columns(columns, load.required)
        if plan.late:
            run.log(f"{plan.gone} loaded files are gone; {len(plan.read)} new ones are added")
            if not plan.read:
                rows = rows.limit(0)
        row_chars = sampled_row_chars(scan.drop(RAGGED, FILE))
        if not row_chars and not plan.late:
            if load.reject_empty:
                raise BadInput(f"the load of {table.name} has no rows")
            held = audit_slice(spark, lake, table, load_date).rows if existed else 0
            if mode != "append" and held:
                raise BadInput(f"a load without rows would remove the {held} rows of the slice")
        begun = ledger.begin(plan)
        quarantine = load.bad_rows == "quarantine"
        with run.timed("write_total_time"):
            totals = _write(
                spark, lake, load, rows, load_date, "append" if plan.late else mode,
                profile_totals(columns, load.refuse_ragged and not quarantine),
                rows_per_file=lake.rows_per_file(row_chars),
                file_prefix=begun.prefix,
                fingerprint=True,
            )
        if totals is None:
            profile = profile_load(scan, load_date, load.null_markers)
        else:
            profile = load_profile(columns, totals | {"rows": totals["read"]})
        run.set(
            number_lines_loaded=profile.rows,
            data_size_mb_formatted=profile.size_mb,
            num_files=profile.files,
        )
        if not quarantine:
            for name, nulls in required_not_null(profile.nulls, load.required).items():
                run.log(f"column {name} has {nulls} nulls")
        if profile.ragged:
            run.log(f"{profile.ragged} records have more or fewer values than their header", "WARN")
        wrote = Fingerprint.of(totals)
        rejected = profile.rows - wrote.rows
        if quarantine:
            _reject(spark, lake, load, scan, load_date, "append" if plan.late else mode, begun, rejected)
            run.log(f"{rejected} rows are refused", "WARN" if rejected else "INFO")
        ledger.end(begun, wrote)
        content = load.verify == "content"
        audit = audit_slice(spark, lake, table, load_date, content=content)
        run.set(qtd_total_rows_insert=audit.rows - plan.held.rows, num_columns_table=audit.columns)
        alert = run.reconcile(wrote.rows, audit.rows - plan.held.rows)
        if content and not alert:
            run.reconcile_content(plan.held + wrote, Fingerprint.of(audit.found))
        metrics = run.finish()
    except Exception as error:
        run.finish(error)
        metrics_sink(spark, lake, run)
        raise JobFailed(f"bronze load of {table.name} for {load_date} failed: {error}") from error
    metrics_sink(spark, lake, run)
    return BronzeRun(metrics, profile, plan.read, rejected)


def _reject(
    spark: SparkSession,
    lake: Lake,
    load: BronzeLoad,
    scan: DataFrame,
    load_date: str,
    mode: str,
    begun: Load,
    expected: int,
) -> None:
    """Write the refused rows of a load; a load without any replaces those of the load it replaced."""
    rejects = rejects_of(load.table)
    if not expected:
        if mode != "append" and table_exists(spark, lake, rejects):
            drop_slice(spark, lake, rejects, load_date)
        return
    rows = rejected_rows(scan, load.required, load.refuse_ragged, load.null_markers)
    found = write_slices(
        spark, lake, rejects, rows, [load_date], "append" if mode == "append" else "replace_slice", file_prefix=begun.prefix
    )
    if found["rows"] != expected:
        raise BadInput(f"{expected} rows were refused, {found['rows']} of them written to the rejects")
