"""Exports, landings and purges of stage folders."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from stratalake.errors import AlreadyLanded
from stratalake.sinks.ledger import StagedFile, same_form, staged_files
from stratalake.sources.stage import stage_path
from stratalake.workspace import delete_empty_folder, delete_file, folder_entries, path_exists


def snapshot_export(df: DataFrame, path: str, sep: str = ",") -> None:
    """Write a table as delimited text with a header, spaces kept and quotes doubled.

    Nulls are empty fields. Parts are written in parallel, each with its header.
    """
    (
        df.write.mode("errorifexists")
        .option("header", True)
        .option("sep", sep)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def land_snapshot(
    df: DataFrame, stage_root: str, table: str, load_date: str, sep: str = ","
) -> str:
    """Export to the dated stage folder and return its path. An existing folder is never touched."""
    path = stage_path(stage_root, table, load_date)
    if path_exists(df.sparkSession, path):
        raise AlreadyLanded(f"{path} has been landed before")
    snapshot_export(df, path, sep)
    return path


def first_row_peek(spark: SparkSession, path: str) -> str | None:
    """First line of one file of a landed folder, its header; None when all files are empty."""
    row = spark.read.text(path).limit(1).first()
    return row["value"] if row else None


@dataclass(frozen=True)
class Purge:
    """Outcome of a purge."""

    deleted: int
    kept: int


#: What writers leave beside their files; nothing is loaded from it.
_MARKERS = ("_SUCCESS", "._SUCCESS.crc")


def purge_stage(
    spark: SparkSession, path: str, loaded: Iterable[str | StagedFile] | None = None
) -> Purge:
    """Delete the files of a stage folder; a missing folder is nothing to delete.

    ``loaded`` are the files a load has read, as it listed them or by name; without it they are the
    files listed now. Each of those is deleted by name, several at a time, unless it has changed since that
    listing, and a folder only once it is empty; so a file that arrives or is replaced meanwhile is kept. Only names pass
    through the driver, as they do when Spark plans the scan.
    """
    found = staged_files(spark, path)
    read = None
    if loaded is not None:
        read = {}
        for file in loaded:
            read |= {same_form(file): None} if isinstance(file, str) else {file.key: file.state}

    def may_go(file: StagedFile) -> bool:
        return read is None or (file.key in read and read[file.key] in (None, file.state))

    done = [f.path for f in found if may_go(f)]
    with ThreadPoolExecutor(max_workers=8) as pool:
        deleted = sum(pool.map(lambda name: delete_file(spark, name), done))
    if path_exists(spark, path):
        _delete_empty(spark, path)
    return Purge(deleted, len(found) - len(done))


def _delete_empty(spark: SparkSession, path: str) -> None:
    """Delete the folders at and below a path that hold nothing but markers."""
    for entry, is_folder in folder_entries(spark, path):
        if is_folder:
            _delete_empty(spark, entry)
    left = folder_entries(spark, path)
    if all(not is_folder and entry.rsplit("/", 1)[-1] in _MARKERS for entry, is_folder in left):
        for entry, _ in left:
            delete_file(spark, entry)
        delete_empty_folder(spark, path)
