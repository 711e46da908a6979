"""Ingest of stage files as they arrive."""

from __future__ import annotations

from dataclasses import replace
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.config import BronzeLoad, Lake, LakeTable
from stratalake.errors import QualityError
from stratalake.functions.dates import load_date_of_path
from stratalake.operators.profile import (
    data_columns,
    load_profile,
    measured,
    profile_totals,
    source_file,
)
from stratalake.operators.quality import fail_on_null, required_columns
from stratalake.schemas import LOAD_DATE
from stratalake.sinks.ledger import same_form
from stratalake.sinks.runlog import RunLog, metrics_sink
from stratalake.sinks.tables import audit, create_database, write_slices
from stratalake.sources.stage import DELIMITED, STAGE_FOLDER, check_file_type, scan_stage
from stratalake.sources.tables import scan_table

ARRIVAL = "lote_chegada"
"""Second partition column of a table filled by arrival: the stream and its micro-batch."""

MAX_FILES = 10_000
"""Files of a micro-batch, unless a call says otherwise."""

BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"
"""Fixed value: the columns of Spark's reader of whole files."""

_UNREADABLE = "FAILED_READ_FILE"
"""Fixed value: Spark's condition for a file a scan cannot read, one with another header among them."""

_QUERY_ID = "sql.streaming.queryId"


def arrival_table(load: BronzeLoad) -> LakeTable:
    """The bronze table, with the micro-batch as a further partition."""
    schema = T.StructType([*load.table.schema.fields, T.StructField(ARRIVAL, T.StringType())])
    return replace(
        load.table,
        name=f"{load.table.name}_chegada",
        schema=schema,
        partition_by=(LOAD_DATE, ARRIVAL),
    )


def new_files(
    spark: SparkSession, lake: Lake, load: BronzeLoad, max_files: int | None = None
) -> DataFrame:
    """Stream of the paths of new files; their contents are not read here."""
    check_file_type(load.file_type)
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE)
    path = f"{lake.stage_root.rstrip('/')}/{STAGE_FOLDER}/{load.table.name}/*/*"
    files = reader.option("maxFilesPerTrigger", max_files or MAX_FILES).load(path)
    return files.where(F.col("length") > 0).select("path")


def files_by_header(spark: SparkSession, paths: list[str]) -> list[list[str]]:
    """Some delimited files, those of one header together.

    The first lines are taken by tasks, through the reader that also expands compressed files; the driver
    gets names and headers.
    """
    lines = spark.read.text(paths).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.monotonically_increasing_id().alias("place"),
    )
    first = lines.where("start = 0").groupBy("file").agg(F.min_by("value", "place").alias("header"))
    found = {same_form(r["file"]): r["header"] for r in first.collect()}
    groups: dict[str, list[str]] = {}
    for path in paths:
        groups.setdefault(found.get(same_form(path), ""), []).append(path)
    return list(groups.values())


def read_files(spark: SparkSession, load: BronzeLoad, groups: list[list[str]]) -> DataFrame:
    """The measured rows of groups of files, dated by the folder each came from.

    Files of one group are read by one scan. Groups are put together by column name, so an added
    column or another order of columns loses nothing; what a file lacks is null.
    """
    parts = []
    for files in groups:
        scan = scan_stage(
            spark,
            files,
            load.file_type,
            sep=load.sep,
            multiline=load.multiline,
            options=load.read_options,
            ragged=True,
        )
        rows = measured(scan, load_date_of_path(source_file(scan)), load.null_markers)
        required_columns(data_columns(rows), load.required)
        parts.append(rows)
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def _write_files(
    spark: SparkSession, lake: Lake, load: BronzeLoad, table: LakeTable, groups: list[list[str]], batch: str
) -> tuple[list[str], dict[str, object]]:
    """The columns and totals of a batch written from groups of files."""
    dated = F.coalesce(
        F.nullif(LOAD_DATE, F.lit("")),
        F.raise_error(f"a file of {load.table.name} is not in a folder named by its load date"),
    )
    rows = read_files(spark, load, groups)
    columns = data_columns(rows)
    checked = fail_on_null(rows, load.required).withColumn(LOAD_DATE, dated)
    totals = profile_totals(columns, load.refuse_ragged)
    return columns, write_slices(spark, lake, table, checked, None, within={ARRIVAL: batch}, totals=totals)


def ingest_batch(
    spark: SparkSession,
    lake: Lake,
    load: BronzeLoad,
    table: LakeTable,
    paths: list[str],
    batch: str,
) -> int:
    """Check the files of one micro-batch and write them to its own partition of each load date.

    A batch that runs again, because its end was not recorded, has the same files and the same
    name, so it replaces its own partitions and no row is kept twice. As in a bronze load, the
    files are read once, by the tasks that write, and a metrics row is kept either way.
    """
    run = RunLog("bronze", table.name)
    run.set(load_total_time=0.0)  # reading is part of the write
    try:
        with run.timed("write_total_time"):
            try:
                columns, found = _write_files(spark, lake, load, table, [paths], batch)
            except (PySparkException, Py4JJavaError, QualityError) as error:
                # One scan for all files holds as long as they share a header, which its tasks check.
                groups = []
                if load.file_type in DELIMITED and (isinstance(error, QualityError) or _UNREADABLE in str(error)):
                    groups = files_by_header(spark, paths)
                if len(groups) < 2:
                    raise
                run.log(f"the {len(paths)} files have {len(groups)} different headers")
                columns, found = _write_files(spark, lake, load, table, groups, batch)
        if not found["rows"]:
            return 0
        profile = load_profile(columns, found)
        if profile.ragged:
            run.log(f"{profile.ragged} records have more or fewer values than their header", "WARN")
        stored = audit(scan_table(spark, lake, table).where(F.col(ARRIVAL) == batch))
        run.set(
            dat_carga=",".join(sorted(found["load_dates"])),
            number_lines_loaded=profile.rows,
            data_size_mb_formatted=profile.size_mb,
            num_files=profile.files,
            qtd_total_rows_insert=stored.rows,
            num_columns_table=stored.columns,
        )
        run.reconcile(profile.rows, stored.rows)
        run.finish()
    except Exception as error:
        run.finish(error)
        metrics_sink(spark, lake, run)
        raise
    metrics_sink(spark, lake, run)
    return profile.rows


def arrival_ingest(
    spark: SparkSession,
    lake: Lake,
    load: BronzeLoad,
    checkpoint: str,
    *,
    max_files: int | None = None,
) -> int:
    """Ingest all files that arrived since the last call, then stop. Returns the rows written.

    ``checkpoint`` is a durable folder; it remembers which files have been read.
    """
    table = arrival_table(load)
    create_database(spark, lake, table.database)
    written = []

    def write_batch(files: DataFrame, number: int) -> None:
        # The identity of a stream lives in its checkpoint: a new checkpoint cannot replace the
        # batches of an older one.
        session = files.sparkSession
        stream = session.sparkContext.getLocalProperty(_QUERY_ID)
        if not stream:
            raise RuntimeError("the stream has no id to name its batches by")
        # As many names as a batch may have files.
        paths = sorted(row["path"] for row in files.distinct().collect())
        if paths:
            batch = f"{stream}-{number}"
            written.append(ingest_batch(session, lake, load, table, paths, batch))

    query = (
        new_files(spark, lake, load, max_files)
        .writeStream.foreachBatch(write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(written)
