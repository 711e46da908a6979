"""Delimited files with line breaks inside values, read by as many tasks as plain text."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.errors import BadInput
from stratalake.functions.text import sql_name
from stratalake.schemas import FILE, RAGGED
from stratalake.workspace import new_folder

#: What a task found: whole records, the end of a record begun in an earlier block, the begin of one that goes on.
_WHOLE, _HEAD, _TAIL = 0, 1, 2
_FOUND = "file string, start long, kind int, first boolean, text string"


def _lines(spark: SparkSession, paths: str | list[str], quote: str) -> DataFrame:
    """The physical lines of files, with the block each lies in and whether its quotes are odd in number."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit(quote), F.lit("")))
    # Only line feeds end a line, so that a carriage return inside a value stays what it is.
    return spark.read.option("lineSep", "\n").text(paths).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        (quotes % 2 == 1).alias("odd"),
        "value",
    )


def _block_states(lines: DataFrame) -> dict[tuple[str, int], bool]:
    """For each block, whether it begins inside a quoted value: the parity of all quotes before it.

    A row a block: the driver gets as many as Spark plans the scan with.
    """
    parity = lines.groupBy("file", "start").agg((F.count_if("odd") % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    states = parity.select("file", "start", (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1).alias("inside"))
    return {(r["file"], r["start"]): r["inside"] for r in states.collect()}


def _assemble(states: Mapping[tuple[str, int], bool]):
    """A function of the lines of a task: the records that begin and end in one block, and the parts of others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: tuple[str, int] | None = None
        open_lines: list[str] = []
        # A record that was begun before this block, or in it, and has not ended yet.
        headless = inside = at_top = False

        def fragment(kind: int, first: bool) -> tuple:
            return (*block, kind, first, "\n".join(open_lines))

        for batch in batches:
            out: list[tuple] = []
            files, starts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
            odd, values = batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_pylist()
            edges = np.flatnonzero(np.r_[True, starts[1:] != starts[:-1]]) if len(starts) else []
            changes = set(edges) | {i for i in range(1, len(files)) if files[i] is not files[i - 1] and files[i] != files[i - 1]}
            for i, value in enumerate(values):
                if i in changes and (files[i], int(starts[i])) != block:
                    if open_lines:
                        out.append(fragment(_HEAD if headless else _TAIL, at_top))
                    block, open_lines = (files[i], int(starts[i])), []
                    if block not in states:
                        raise ValueError(f"block {block} was not there when the quotes were counted")
                    inside = headless = states[block]
                    at_top = block[1] == 0
                open_lines.append(value)
                inside ^= bool(odd[i])
                if not inside:
                    out.append(fragment(_HEAD if headless else _WHOLE, at_top))
                    open_lines, headless, at_top = [], False, False
            if out:
                yield _batch(out)
        if open_lines:
            yield _batch([fragment(_HEAD if headless else _TAIL, at_top)])

    return run


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
    columns = [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=["file", "start", "kind", "first", "text"])


def records_of(spark: SparkSession, paths: str | list[str], quote: str = '"') -> DataFrame:
    """The records of delimited files: ``file``, ``first`` (the header of its file) and ``text``.

    A line break belongs to a value where the quotes before it, in its file, are odd in number; doubled quotes
    do not change that. One pass counts the quotes of each block, their running parity tells how each
    block begins, and a second pass puts the lines of a block together. Of a record that lies across blocks each task
    has a part; only those are shuffled. The records are stored, for the reads that follow.

    A quote inside an unquoted value is not valid in such files; one that ends inside a quoted value raises.
    """
    lines = _lines(spark, paths, quote)
    states = _block_states(lines)
    found = lines.mapInArrow(_assemble(states), _FOUND)
    path = new_folder(spark, "records")
    found.write.partitionBy("kind").parquet(path)
    stored = spark.read.schema(_FOUND).parquet(path)
    whole = stored.where(F.col("kind") == _WHOLE).select("file", "first", "text")
    # At most two parts a block: each begin opens a record, the ends that follow it are its other parts.
    in_file = Window.partitionBy("file").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    parts = stored.where(F.col("kind") != _WHOLE).withColumn("nth", F.count_if(F.col("kind") == _TAIL).over(in_file))
    pieces = F.array_sort(F.collect_list(F.struct("start", "kind", "text")))
    split = parts.groupBy("file", "nth").agg(
        F.bool_or("first").alias("first"), F.concat_ws("\n", F.transform(pieces, lambda p: p["text"])).alias("text")
    )
    open_end = split.where(F.length("text") % 2 != F.length(F.replace(F.col("text"), F.lit(quote), F.lit(""))) % 2)
    if broken := open_end.select("file").first():
        raise BadInput(f"{broken['file']} ends inside a quoted value")
    return whole.unionByName(split.select("file", "first", "text"))


def scan_records(
    spark: SparkSession,
    paths: str | list[str],
    *,
    sep: str = ",",
    options: Mapping[str, str] | None = None,
    ragged: bool = False,
) -> DataFrame:
    """Delimited files with line breaks inside values, each with one header; every column is text.

    As :func:`stratalake.sources.stage.scan_delimited` reads them, but split. The file of each row is the column ``FILE``.
    """
    how = {"sep": sep, "escape": '"', "multiLine": "true", "lineSep": "\n", **(options or {})}
    quote = how.get("quote", '"')
    records = records_of(spark, paths, quote).withColumn("text", F.rtrim(F.col("text"), F.lit("\r")))
    header = records.where("first").select("text").orderBy("file").first()
    if header is None:
        raise BadInput(f"{paths} hold no header")
    places = ", ".join(f"c{i} STRING" for i in range(header["text"].count(sep) + 1))
    probe = spark.range(1).select(F.from_csv(F.lit(header["text"]), places, how).alias("r")).first()["r"]
    names = [name for name in probe if name is not None]
    ddl = ", ".join(f"{sql_name(n)} STRING" for n in (*names, RAGGED))
    parsed = F.from_csv("text", ddl, how | {"columnNameOfCorruptRecord": RAGGED, "mode": "PERMISSIVE"})
    same = F.when(F.col("first") & (F.col("text") != header["text"]), F.raise_error("a file has another header than the first"))
    # A header that differs fails the read; the others are left out, as are empty lines.
    kept = (F.coalesce(same.cast("boolean"), ~F.col("first"))) & (F.col("text") != "")
    rows = records.where(kept).select(parsed.alias("r"), F.col("file").alias(FILE))
    columns = [F.col(f"r.{sql_name(n)}").alias(n) for n in (*names, *([RAGGED] if ragged else []))]
    return rows.select(*columns, FILE)
