"""Readers of dated stage folders."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.config import load_day
from stratalake.errors import BadInput, MissingPackage, UnsupportedFormat
from stratalake.schemas import FILE, LOAD_DATE, RAGGED
from stratalake.sources import records

FILE_TYPES = ("csv", "txt", "parquet", "avro")

DELIMITED = ("csv", "txt")

AVRO_SOURCE = "org.apache.spark.sql.avro.AvroFileFormat"
"""Fixed value: Spark's Avro source by its class, which is found where the short name is not registered."""

STAGE_FOLDER = "table_ingestion_files"


def stage_path(stage_root: str, table: str, load_date: str) -> str:
    """Folder of the files of one table and date."""
    load_day(load_date)
    return f"{stage_root.rstrip('/')}/{STAGE_FOLDER}/{table}/{load_date}"


def scan_delimited(
    spark: SparkSession,
    path: str | list[str],
    *,
    sep: str = ",",
    multiline: bool = False,
    options: Mapping[str, str] | None = None,
    ragged: bool = False,
) -> DataFrame:
    """Delimited text with a header; every column is text.

    All files must have the header of the first one, or the read fails; ``enforceSchema`` among the
    options lifts that. Quotes inside a quoted value are doubled. ``multiline`` accepts line breaks
    inside values; one task then reads a whole file, where ``records.scan_records`` splits it. ``ragged`` adds
    a column with the text of each record that does not fit the header; values too many are not in the
    others, values too few are null there.
    """

    def reader():
        return (
            spark.read.option("header", True)
            .option("sep", sep)
            .option("escape", '"')
            .option("multiLine", multiline)
            .option("enforceSchema", False)
            .options(**(options or {}))
        )

    scan = reader().csv(path)
    if not ragged:
        return scan
    schema = T.StructType([*scan.schema.fields, T.StructField(RAGGED, T.StringType())])
    return reader().schema(schema).option("columnNameOfCorruptRecord", RAGGED).csv(path)


def scan_avro(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Avro files, by the source that Spark holds, or by its Avro package where that is on the class path."""
    try:
        return spark.read.format(AVRO_SOURCE).load(path)
    except (AnalysisException, Py4JJavaError) as error:
        # No source of that name, or none of its files is Avro.
        if "data source" in str(error).lower() or "Could not read file" in str(error):
            raise MissingPackage(
                f"{path} cannot be read as avro: that needs Avro files, and Spark 4.1 or the"
                " org.apache.spark:spark-avro package on the class path"
            ) from error
        raise


def check_file_type(file_type: str) -> str:
    if file_type not in FILE_TYPES:
        raise UnsupportedFormat(f"file type {file_type!r} is not one of {', '.join(FILE_TYPES)}")
    return file_type


def check_columns(df: DataFrame, path: str = "", sep: str = "") -> DataFrame:
    """A load has more than one column. Looks at the schema; runs a job only to show a bad row."""
    if len([c for c in df.columns if c not in (RAGGED, FILE)]) > 1:
        return df
    df = df.drop(RAGGED, FILE)
    sample = sample_rows(df).collect() if df.columns else []
    shown = [row[0] for row in sample]
    raise BadInput(
        f"{path or 'input'} has {len(df.columns)} column(s) with separator {sep!r}; "
        f"header {df.columns}, first rows {shown}"
    )


def sample_rows(df: DataFrame, rows: int = 1) -> DataFrame:
    """A few rows for a message."""
    return df.limit(rows)


def scan_stage(
    spark: SparkSession,
    path: str | list[str],
    file_type: str = "csv",
    *,
    sep: str = ",",
    multiline: bool = False,
    options: Mapping[str, str] | None = None,
    ragged: bool = False,
) -> DataFrame:
    """Read a stage folder, or some of its files; raises for an unknown type or an input of one column."""
    check_file_type(file_type)
    if file_type in DELIMITED and multiline:
        df = records.scan_records(spark, path, sep=sep, options=options, ragged=ragged)
    elif file_type in DELIMITED:
        df = scan_delimited(spark, path, sep=sep, options=options, ragged=ragged)
    elif file_type == "parquet":
        paths = [path] if isinstance(path, str) else path
        df = spark.read.options(**(options or {})).parquet(*paths)
    else:
        df = scan_avro(spark, path)
    return check_columns(df, path if isinstance(path, str) else path[0], sep)


def add_load_date(df: DataFrame, load_date: str) -> DataFrame:
    """Add the partition column."""
    load_day(load_date)
    return df.withColumn(LOAD_DATE, F.lit(load_date))


def list_files(spark: SparkSession, path: str, recursive: bool = False) -> DataFrame:
    """Files of a folder: ``path``, ``length``, ``modificationTime``. Contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", recursive)
        .load(path)
        .select("path", "length", "modificationTime")
    )


def with_input_file(df: DataFrame, name: str = "file_name") -> DataFrame:
    """Add the file each row was read from. ``df`` must come straight from a file scan."""
    return df.select("*", F.col("_metadata.file_path").alias(name))


def inline_rows(
    spark: SparkSession, rows: Iterable[Sequence], schema: T.StructType | str
) -> DataFrame:
    """Literal rows with a fixed schema, for seeds and fixtures."""
    return spark.createDataFrame([tuple(row) for row in rows], schema)
