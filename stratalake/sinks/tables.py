"""Lake databases, tables, and writes by load date."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.config import ALL_TABLES, DATABASES, WRITE_MODES, Lake, LakeTable
from stratalake.errors import BadInput
from stratalake.functions.text import sql_name, sql_text
from stratalake.operators.quality import fingerprint_totals, hash_totals, row_hash
from stratalake.operators.types import WIDEN, lost_counts, merges
from stratalake.schemas import LOAD_DATE
from stratalake.workspace import delete_path, path_exists


TABLE_FORMAT = "parquet"
"""Format of the files of all tables."""


def create_database(spark: SparkSession, lake: Lake, name: str) -> None:
    database = lake.database(name)
    location = sql_text(f"{lake.root}/{database}")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION {location}")


def _column_ddl(field: T.StructField) -> str:
    ddl = f"`{field.name}` {field.dataType.simpleString()}"
    comment = field.metadata.get("comment")
    return f"{ddl} COMMENT {sql_text(comment)}" if comment else ddl


def create_table(spark: SparkSession, lake: Lake, table: LakeTable) -> None:
    """Create a partitioned external table where it is absent.

    A table made over a folder that holds data learns its partitions once, here; later writes
    add theirs one by one.
    """
    if table_exists(spark, lake, table):
        return
    has_data = path_exists(spark, table.path(lake))
    columns = ", ".join(_column_ddl(f) for f in table.schema.fields)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table.full_name(lake)} ({columns}) "
        f"USING {TABLE_FORMAT} PARTITIONED BY ({', '.join(table.partition_by)}) "
        f"LOCATION {sql_text(table.path(lake))}"
    )
    if has_data:
        spark.catalog.recoverPartitions(table.full_name(lake))


def create_lake(spark: SparkSession, lake: Lake) -> None:
    """All databases and tables."""
    for database in DATABASES:
        create_database(spark, lake, database)
    for table in ALL_TABLES:
        create_table(spark, lake, table)


def table_exists(spark: SparkSession, lake: Lake, table: LakeTable) -> bool:
    return spark.catalog.tableExists(table.full_name(lake))


def evolve_table(spark: SparkSession, lake: Lake, table: LakeTable, df: DataFrame) -> list[str]:
    """Add the columns ``df`` has and the table lacks, and widen the types that do not hold its own.

    Older slices read new columns as null, and their narrower numbers as wider ones. Where a type of the load can
    be neither widened to nor cast without loss, its values are counted, and one that would be lost refuses the load. The
    schema lives in the catalog, so no reader has to merge the footers of all files.
    """
    _merge_types(spark, lake, table, df)
    known = {f.name.lower() for f in spark.table(table.full_name(lake)).schema.fields}
    new = [f for f in df.schema.fields if f.name.lower() not in known]
    if new:
        columns = ", ".join(_column_ddl(f) for f in new)
        spark.sql(f"ALTER TABLE {table.full_name(lake)} ADD COLUMNS ({columns})")
    return [f.name for f in new]


def _merge_types(spark: SparkSession, lake: Lake, table: LakeTable, df: DataFrame) -> None:
    name = table.full_name(lake)
    stored = spark.table(name).schema
    found = merges(stored, df.schema)
    if lost := lost_counts(df, found):
        listed = ", ".join(f"{n} of {c} ({found[c].kind.simpleString()})" for c, n in sorted(lost.items()))
        raise BadInput(f"values of {table.name} would be lost in the types of the table: {listed}")
    wider = {c: merge.kind for c, merge in found.items() if merge.action == WIDEN and c not in table.partition_by}
    if not wider:
        return
    # An external table of the same files under a wider schema: the catalog offers no change of a type. Readers
    # of this moment may miss the table, none can miss rows.
    comments = {c.name: c.description for c in spark.catalog.listColumns(name)}
    fields = [
        T.StructField(f.name, wider.get(f.name, f.dataType), True, {"comment": comments.get(f.name) or ""})
        for f in stored.fields
    ]
    spark.sql(f"DROP TABLE {name}")
    create_table(spark, lake, replace(table, schema=T.StructType(fields)))


def _stored_as(name: str, field: T.StructField) -> Column:
    """A column under the name and type it has in the table."""
    kind = field.dataType.simpleString()
    return F.expr(f"CAST({sql_name(name)} AS {kind}) AS {sql_name(field.name)}")


def _counted(df: DataFrame, load_dates: Sequence[str] | None) -> Column:
    """Aggregate: the rows. Fails, before anything is committed, on a row of no known load date."""
    if load_dates is None or LOAD_DATE not in df.columns:
        return F.count(F.lit(1)).alias("rows")
    message = f"a row has another load date than {', '.join(load_dates)}"
    known = F.col(LOAD_DATE).isin(*load_dates)
    return F.count(F.when(known, 1).otherwise(F.raise_error(message))).alias("rows")


#: Load dates of a write up to which a task has a file open for each; beyond, its rows are sorted by load date.
OPEN_FILES = 8

_HASH = "__fingerprint"

_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextmanager
def _open_files(spark: SparkSession, load_dates: int) -> Iterator[None]:
    """Within it a task writes the slices of some load dates side by side and does not sort its rows, whatever their number."""
    if not 1 < load_dates <= OPEN_FILES:
        yield
        return
    before = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, load_dates)
    try:
        yield
    finally:
        spark.conf.set(_WRITERS, before)


def check_mode(mode: str) -> str:
    if mode not in WRITE_MODES:
        raise ValueError(f"write mode {mode!r} is not one of {', '.join(WRITE_MODES)}")
    return mode


def write_slices(
    spark: SparkSession,
    lake: Lake,
    table: LakeTable,
    df: DataFrame,
    load_dates: Sequence[str] | None,
    mode: str = "replace_slice",
    *,
    within: Mapping[str, str] | None = None,
    totals: Mapping[str, Column] | None = None,
    rows_per_file: int = 0,
    rebalance: bool = False,
    kept: Column | None = None,
    file_prefix: str = "",
    fingerprint: bool = False,
) -> dict[str, object]:
    """Write the slices of ``load_dates``; returns ``rows`` written and the ``totals`` asked for.

    With one load date ``df`` needs no such column; where it has one, a row of another load date
    fails the write. Without ``load_dates`` they are those of the rows. A table with further
    partition columns takes the one value of each in ``within``.

    ``append`` adds to the slices, ``replace_slice`` replaces them, ``overwrite_table`` replaces
    them and drops all others. A replaced slice stays readable until the new files are committed,
    and a second run gives the same table. ``totals`` are aggregates of ``df`` taken while it is
    written; columns whose names start with two underscores are for them and are not stored.
    ``rows_per_file`` caps the size of a file; ``rebalance`` lets AQE merge small ones, for the
    price of a shuffle. Where ``kept`` is given, only rows it holds for are written, and ``rows`` counts those,
    while ``totals`` see all; a slice is then never replaced by none. ``file_prefix`` begins the names of the files, and
    ``fingerprint`` adds the totals ``fingerprint_sum`` and ``fingerprint_xor`` of the rows as stored.
    """
    check_mode(mode)
    if load_dates is None and LOAD_DATE not in df.columns:
        raise ValueError("a write needs load dates, as an argument or as a column")
    create_table(spark, lake, table)
    data = df.drop(*[c for c in df.columns if c.startswith("__")])
    evolve_table(spark, lake, table, data)
    fixed = dict(within or {})
    if load_dates and len(load_dates) == 1:
        fixed[LOAD_DATE] = load_dates[0]
    stored = {f.name.lower(): f for f in spark.table(table.full_name(lake)).schema.fields}
    columns = [_stored_as(c, stored[c.lower()]) for c in data.columns if c not in fixed]
    # A partition column with one value is a literal of the last projection: Spark then knows the
    # rows are ordered by it and need no sort before the write.
    columns += [F.lit(value).alias(name) for name, value in fixed.items()]
    if rebalance:
        df = df.hint("rebalance")
    # Next to the write, so that the counters are in the tasks that commit files and a map task
    # that runs again cannot add to them.
    written = Observation()
    extra = [total.alias(name) for name, total in (totals or {}).items()]
    if LOAD_DATE in df.columns:
        extra.append(F.collect_set(LOAD_DATE).alias("load_dates"))
    if fingerprint:
        values = {
            c: F.col(sql_name(c)).cast(stored[c.lower()].dataType) for c in data.columns if c not in table.partition_by
        }
        # Observed aggregates are evaluated node by node for each row: the hash is a column of the generated code below.
        hashed = row_hash(values) if kept is None else F.when(kept, row_hash(values))
        df = df.withColumn(_HASH, hashed)
        extra += hash_totals(F.col(_HASH))
    rows = _counted(df, load_dates) if kept is None else F.count_if(kept).alias("rows")
    out = df.observe(written, rows, *extra)
    out = (out if kept is None else out.where(kept)).select(*columns)
    options = {"maxRecordsPerFile": rows_per_file} if rows_per_file else {}
    if file_prefix:
        options["mapreduce.output.basename"] = file_prefix
    writer = out.write.format(TABLE_FORMAT).options(**options)
    whole = len(fixed) == len(table.partition_by)
    if mode == "append" and whole:
        # Straight into the slice, so that appends to other slices can run at the same time.
        rows = out.drop(*fixed).write.format(TABLE_FORMAT).options(**options)
        rows.mode("append").save(slice_path(lake, table, fixed[LOAD_DATE], within))
    elif mode == "append":
        with _open_files(spark, len(load_dates or ())):
            writer.mode("append").partitionBy(*table.partition_by).save(table.path(lake))
    else:
        # On a path the option is honoured; insertInto would ignore it and clear the table.
        writer = writer.option("partitionOverwriteMode", "dynamic").mode("overwrite")
        with _open_files(spark, 0 if whole else len(load_dates or ())):
            writer.partitionBy(*table.partition_by).save(table.path(lake))
    found = written.get
    filled = found.get("load_dates", load_dates if found["rows"] else [])
    if mode != "append" and kept is not None and not found["rows"]:
        raise BadInput("no row of the load is good: the slice stays as it was")
    if mode != "append" and not within:
        for load_date in set(load_dates or ()) - set(filled):
            drop_slice(spark, lake, table, load_date)
    _register(spark, lake, table, filled, within or {})
    if mode == "overwrite_table":
        for other in set(slices(spark, lake, table)) - set(filled):
            drop_slice(spark, lake, table, other)
    return found


def _register(
    spark: SparkSession,
    lake: Lake,
    table: LakeTable,
    load_dates: Sequence[str],
    within: Mapping[str, str],
) -> None:
    """Tell the catalog about the partitions of a write."""
    name = table.full_name(lake)
    deeper = "".join(f", {c} = {sql_text(v)}" for c, v in within.items())
    specs = [f"PARTITION ({LOAD_DATE} = {sql_text(d)}{deeper})" for d in load_dates]
    if specs:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(specs)}")
    spark.catalog.refreshTable(name)


def slice_path(
    lake: Lake, table: LakeTable, load_date: str, within: Mapping[str, str] | None = None
) -> str:
    """Folder of a load date, or of one further partition of it."""
    deeper = "".join(f"/{name}={value}" for name, value in (within or {}).items())
    return f"{table.path(lake)}/{LOAD_DATE}={load_date}{deeper}"


def slices(spark: SparkSession, lake: Lake, table: LakeTable) -> list[str]:
    """Load dates the table holds."""
    rows = spark.sql(f"SHOW PARTITIONS {table.full_name(lake)}").toLocalIterator()
    return sorted({row[0].split("/")[0].split("=", 1)[1] for row in rows})


def drop_slice(spark: SparkSession, lake: Lake, table: LakeTable, load_date: str) -> None:
    """Remove one load date."""
    value = sql_text(load_date)
    name = table.full_name(lake)
    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({LOAD_DATE} = {value})")
    delete_path(spark, slice_path(lake, table, load_date))
    spark.catalog.refreshTable(name)


def drop_partition(spark: SparkSession, lake: Lake, table: LakeTable, spec: Mapping[str, str]) -> None:
    """Remove one partition of a table with further partition columns."""
    listed = ", ".join(f"{name} = {sql_text(value)}" for name, value in spec.items())
    spark.sql(f"ALTER TABLE {table.full_name(lake)} DROP IF EXISTS PARTITION ({listed})")
    within = {name: value for name, value in spec.items() if name != LOAD_DATE}
    delete_path(spark, slice_path(lake, table, spec[LOAD_DATE], within))
    spark.catalog.refreshTable(table.full_name(lake))


@dataclass(frozen=True)
class SliceAudit:
    """What is in a slice after a write; ``found`` holds its fingerprint, where that was asked for."""

    rows: int
    files: int
    columns: int
    found: Mapping[str, object] = field(default_factory=dict)


def slice_files(df: DataFrame, *others: Column) -> DataFrame:
    """``rows`` and ``num_table_files`` of a table scan. Reads no column but those of ``others``, only footers."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("_metadata.file_path").alias("num_table_files"),
        *others,
    )


def audit(rows: DataFrame, partition_by: Sequence[str] | None = None) -> SliceAudit:
    """Rows, files and columns of a part of a table, in one pass that reads no column.

    With ``partition_by`` the fingerprint of all other columns is taken too; that pass reads them.
    """
    extra = []
    if partition_by is not None:
        extra = fingerprint_totals({c: F.col(sql_name(c)) for c in rows.columns if c not in partition_by})
    row = slice_files(rows, *extra).first()
    return SliceAudit(row["rows"], row["num_table_files"], len(rows.columns), row.asDict())


def audit_slice(
    spark: SparkSession, lake: Lake, table: LakeTable, load_date: str, content: bool = False
) -> SliceAudit:
    """What a load date of a table holds; ``content`` adds its fingerprint."""
    rows = spark.table(table.full_name(lake)).where(F.col(LOAD_DATE) == load_date)
    return audit(rows, table.partition_by if content else None)
