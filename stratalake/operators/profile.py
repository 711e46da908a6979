"""Counts and sizes of a load, taken in one pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.python_text import quoted_length
from stratalake.functions.text import sql_name
from stratalake.operators.cleaning import cleaned_columns
from stratalake.schemas import LOAD_DATE
from stratalake.operators.quality import refusal
from stratalake.sources.stage import FILE, RAGGED

MEGABYTE = 1024 * 1024

_SOURCE_FILE = "__source_file"
_ROW_CHARS = "__row_chars"


def row_chars(schema: T.StructType, exact: bool = False) -> Column:
    """Length of a row written out as ``Row(name='value', other=None)``.

    Characters that such a text would escape count once, unless it is to be ``exact``, for the price of a
    pattern match per value.
    """
    if exact:
        return _exact_row_chars(schema)
    chars = len("Row()") + len(", ") * (len(schema.fields) - 1)
    chars += sum(len(f.name) + len("=") for f in schema.fields)
    terms = [str(chars)]
    for f in schema.fields:
        length = f"length(CAST({sql_name(f.name)} AS STRING))"
        if isinstance(f.dataType, T.StringType):
            length += f" + {len(repr(''))}"
        terms.append(f"coalesce({length}, {len('None')})")
    return F.expr(" + ".join(terms))


def _exact_row_chars(schema: T.StructType) -> Column:
    fixed = len("Row()") + len(", ") * (len(schema.fields) - 1) + sum(len(f.name) + len("=") for f in schema.fields)
    total = F.lit(fixed)
    for f in schema.fields:
        value = F.col(sql_name(f.name))
        length = quoted_length(value) if isinstance(f.dataType, T.StringType) else F.length(value.cast("string"))
        total += F.coalesce(length, F.lit(len("None")))
    return total


def megabytes(chars: int) -> float:
    return round(chars / MEGABYTE, 2)


def sampled_row_chars(df: DataFrame, rows: int = 1000) -> float:
    """Mean text length of the first rows: enough to size files, and no pass over the input. 0 without rows."""
    found = df.limit(rows).agg(F.avg(row_chars(df.schema)).alias("mean")).first()
    return found["mean"] or 0.0


def unparsed_counts(parsers: Mapping[str, Callable[[Column], Column]]) -> dict[str, Column]:
    """Aggregates: the values of each column that are there but that its parser cannot read."""
    return {
        f"unparsed_{name}": F.count_if(F.col(name).isNotNull() & parse(F.col(name)).isNull())
        for name, parse in parsers.items()
    }


def unparsed_marks(parsers: Mapping[str, Callable[[Column], Column]]) -> dict[str, Column]:
    """The same as columns of each row, for writes that observe them: set where a value cannot be read, else null."""
    return {
        f"__unparsed_{name}": F.when(F.col(name).isNotNull() & parse(F.col(name)).isNull(), 1)
        for name, parse in parsers.items()
    }


def marked_counts(parsers: Mapping[str, object]) -> dict[str, Column]:
    """``unparsed_counts`` of rows that hold ``unparsed_marks``."""
    return {f"unparsed_{name}": F.count(f"__unparsed_{name}") for name in parsers}


def data_size(df: DataFrame, exact: bool = False) -> DataFrame:
    """One row: ``rows``, ``chars`` and ``size_mb`` of the rows written out as text."""
    totals = df.select(row_chars(df.schema, exact).alias("n")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("chars"),
    )
    return totals.withColumn("size_mb", F.round(F.col("chars") / MEGABYTE, 2))


def null_counts(df: DataFrame) -> DataFrame:
    """``column_name``, ``nulls`` for every column, from one aggregate."""
    names = [sql_name(c) for c in df.columns]
    counts = df.agg(*[F.expr(f"count_if({n} IS NULL) AS {n}") for n in names])
    return counts.unpivot([], names, "column_name", "nulls")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows"))


FILE_SKETCH = 14
"""Size of a sketch of files, as a power of two: sixteen kilobytes, whatever the number of files."""

FILE_SKETCH_ERROR = 3 * 0.0065
"""Bound on the relative error of a sketched count: three standard errors. Some hundreds of files count exactly."""


def sketched_count(values: Column) -> Column:
    """Aggregate: about how many distinct values, from sketches that tasks build and the driver merges."""
    return F.hll_sketch_estimate(F.hll_sketch_agg(values, F.lit(FILE_SKETCH)))


def distinct_file_count(df: DataFrame, sketch: bool = False) -> DataFrame:
    """Number of files that gave at least one row. ``df`` must come straight from a file scan.

    ``sketch`` counts by a sketch, within ``FILE_SKETCH_ERROR``, and shuffles no names.
    """
    file = F.col("_metadata.file_path")
    return df.agg((sketched_count(file) if sketch else F.count_distinct(file)).alias("num_files"))


@dataclass(frozen=True)
class LoadProfile:
    """What one pass over a load tells."""

    rows: int
    chars: int
    files: int
    nulls: dict[str, int] = field(default_factory=dict)
    ragged: int = 0

    @property
    def size_mb(self) -> float:
        return megabytes(self.chars)

    @property
    def row_chars(self) -> float:
        """Mean text length of a row."""
        return self.chars / max(self.rows, 1)


def measured(
    scan: DataFrame, load_date: Column, markers: Sequence[str] = ("NULL", "null")
) -> DataFrame:
    """The cleaned columns of a file scan and its load date, with the size of each raw row and a
    hash of its file, and whether it is a record that does not fit its header.

    The size is that of the row as read plus the load date, which replaces a column of that name.
    The helper columns are for ``profile_totals``; a write leaves them out.
    """
    source = scan.drop(LOAD_DATE, RAGGED, FILE)
    misfit = F.col(RAGGED).isNotNull() if RAGGED in scan.columns else F.lit(False)
    dated = T.StructType([*source.schema.fields, T.StructField(LOAD_DATE, T.StringType())])
    return scan.withColumns({
        LOAD_DATE: load_date,
        _SOURCE_FILE: F.xxhash64(source_file(scan)),
    }).select(
        *[c.alias(name) for name, c in cleaned_columns(source, markers).items()],
        LOAD_DATE,
        row_chars(dated).alias(_ROW_CHARS),
        _SOURCE_FILE,
        misfit.alias(RAGGED),
    )


def source_file(scan: DataFrame) -> Column:
    """The file each row of a scan came from."""
    return F.col(FILE if FILE in scan.columns else "_metadata.file_path")


def rejected_rows(
    scan: DataFrame, required: Sequence[str], refuse_ragged: bool, markers: Sequence[str] = ("NULL", "null")
) -> DataFrame:
    """The refused rows of a file scan: why, the file, and the row as delimited text.

    A record that does not fit its header is kept as it stood, any other is written out again.
    """
    source = scan.drop(LOAD_DATE, RAGGED, FILE)
    cleaned = {f"__{name}": c for name, c in cleaned_columns(source, markers).items() if name in required}
    ragged = F.col(RAGGED) if RAGGED in scan.columns else F.lit(None).cast("string")
    as_it_is = {"escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    written = F.to_csv(F.struct(*[F.col(sql_name(c)) for c in source.columns]), as_it_is)
    reason = refusal([f"__{name}" for name in required], ragged.isNotNull() if refuse_ragged else None)
    rows = scan.select("*", source_file(scan).alias("__from")).withColumns(cleaned)
    return rows.select(
        F.ltrim(reason, F.lit("_")).alias("motivo"), F.col("__from").alias("arquivo"),
        F.coalesce(ragged, written).alias("registro"),
    ).where("motivo IS NOT NULL")


def data_columns(rows: DataFrame) -> list[str]:
    """The columns that come from the source: not the load date, not the helper columns."""
    return [c for c in rows.columns if c != LOAD_DATE and not c.startswith("__")]


RAGGED_RECORD = "a record has more or fewer values than its header"


def profile_totals(columns: Sequence[str], refuse_ragged: bool = False) -> dict[str, Column]:
    """Aggregates of a measured load: text size, files, records that do not fit, nulls of each column.

    The files are counted by a sketch of bounded size, so a task sends the driver the same whatever their number.
    ``refuse_ragged`` fails the job, before a write commits anything, on a record that does not fit.
    """
    misfit = F.raise_error(RAGGED_RECORD).cast("int") if refuse_ragged else F.lit(1)
    totals = {
        "read": F.count(F.lit(1)),
        "ragged": F.count(F.when(F.col(RAGGED), misfit)),
        "chars": F.coalesce(F.sum(_ROW_CHARS), F.lit(0)),
        "files": sketched_count(F.col(_SOURCE_FILE)),
    }
    for i, name in enumerate(columns):
        # A plain count is the cheapest aggregate a write can observe for each column.
        totals[f"nulls_{i}"] = F.expr(f"count(1) - count({sql_name(name)})")
    return totals


def load_profile(columns: Sequence[str], totals: Mapping[str, int]) -> LoadProfile:
    """The profile from the totals of a load."""
    nulls = {name: totals[f"nulls_{i}"] for i, name in enumerate(columns)}
    return LoadProfile(totals["rows"], totals["chars"], totals["files"], nulls, totals["ragged"])


def profile_load(
    scan: DataFrame, load_date: str, markers: Sequence[str] = ("NULL", "null")
) -> LoadProfile:
    """Rows, text size, files and nulls of a file scan, in one pass and without a write."""
    rows = measured(scan, F.lit(load_date), markers)
    columns = data_columns(rows)
    totals = [total.alias(name) for name, total in profile_totals(columns).items()]
    row = rows.agg(F.count(F.lit(1)).alias("rows"), *totals).first()
    return load_profile(columns, row.asDict())
