"""Small files of a slice put together to files of the target size."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from stratalake.config import Lake, LakeTable
from stratalake.errors import LakeError
from stratalake.functions.text import sql_name
from stratalake.operators.quality import fingerprint_totals
from stratalake.sinks.ledger import Fingerprint, Ledger, staged_files
from stratalake.sinks.tables import TABLE_FORMAT, slice_path
from stratalake.workspace import (
    delete_file,
    delete_path,
    folder_entries,
    move_file,
    new_folder,
    path_exists,
    read_text,
    write_text,
)


@dataclass(frozen=True)
class Compaction:
    """Data files of a slice before and after, and the bytes that were written anew."""

    before: int
    after: int
    rewritten_bytes: int


def _plan_path(lake: Lake, table: LakeTable, load_date: str) -> str:
    return f"{lake.root}/_compacting/{lake.database(table.database)}/{table.name}/{load_date}.json"


def finish_compaction(spark: SparkSession, lake: Lake, table: LakeTable, load_date: str) -> bool:
    """Carry out the exchange of files that a run wrote down and did not finish; false where there is none.

    Each step may have been done already. Loads call this before they touch a slice.
    """
    path = _plan_path(lake, table, load_date)
    if not path_exists(spark, path):
        return False
    plan = json.loads(read_text(spark, path))
    folder = slice_path(lake, table, load_date)
    for name in plan["merged"]:
        if path_exists(spark, name):
            move_file(spark, name, folder)
    for name in plan["old"]:
        delete_file(spark, name)
    delete_path(spark, plan["merged_in"])
    delete_file(spark, path)
    spark.catalog.refreshTable(table.full_name(lake))
    return True


def compact_slice(
    spark: SparkSession, lake: Lake, table: LakeTable, load_date: str, target_bytes: int | None = None
) -> Compaction:
    """Rewrite the files of a slice that are smaller than the target as ceil(their bytes / target) files.

    Spark packs the listed files to read tasks of that many bytes, and each task writes one file: nothing is
    shuffled and larger files are not touched. The new files are written elsewhere and read back; only if they
    hold the same rows (count and fingerprint) the exchange is written down and then done: new files in, old ones out.
    A run that dies before that leaves the slice as it was, one that dies later is finished by the next
    compaction or load. Between the two moves a reader may see rows twice, so compact a slice that nobody reads.
    """
    finish_compaction(spark, lake, table, load_date)
    if Ledger(spark, lake, table, load_date).cut_off:
        raise LakeError(f"a load of {table.name} of {load_date} was cut off: repeat it before its slice is compacted")
    target = target_bytes or lake.target_file_bytes
    folder = slice_path(lake, table, load_date)
    files = staged_files(spark, folder)
    small = [f for f in files if f.length < target]
    total = sum(f.length for f in small)
    wanted = -(-total // target)
    if len(small) <= wanted or len(small) < 2:
        return Compaction(len(files), len(files), 0)
    # A task is closed once the next file does not fit: with room for one more beyond the mean there are no more
    # tasks than wanted.
    limit = -(-total // wanted) + max(f.length for f in small)
    session = spark.newSession()
    for name, value in (("maxPartitionBytes", limit), ("openCostInBytes", 0), ("minPartitionNum", 1)):
        session.conf.set(f"spark.sql.files.{name}", value)
    schema = spark.table(table.full_name(lake)).drop(*table.partition_by).schema
    rows = session.read.schema(schema).format(TABLE_FORMAT).load([f.path for f in small])
    merged_in = new_folder(spark, "compacted")
    read = Observation()
    out = rows.observe(read, *_totals(rows))
    name = f"junto-{uuid.uuid4().hex}"
    out.write.option("mapreduce.output.basename", name).format(TABLE_FORMAT).save(merged_in)
    merged = spark.read.schema(schema).format(TABLE_FORMAT).load(merged_in)
    found = merged.agg(*_totals(merged)).first().asDict()
    if Fingerprint.of(found) != Fingerprint.of(read.get):
        delete_path(spark, merged_in)
        raise LakeError(f"the compacted files of {table.name} of {load_date} hold other rows; the slice is unchanged")
    new = [n for n, _ in folder_entries(spark, merged_in) if n.rsplit("/", 1)[-1].startswith(name)]
    plan = {"merged_in": merged_in, "merged": new, "old": [f.path for f in small]}
    write_text(spark, _plan_path(lake, table, load_date), json.dumps(plan))
    finish_compaction(spark, lake, table, load_date)
    return Compaction(len(files), len(files) - len(small) + len(new), total)


def _totals(rows: DataFrame) -> list:
    return [F.count(F.lit(1)).alias("rows"), *fingerprint_totals({c: F.col(sql_name(c)) for c in rows.columns})]
