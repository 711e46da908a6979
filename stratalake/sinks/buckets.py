"""Copies of slices laid out by a join key, so that joins on it need no shuffle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.config import Lake, LakeTable
from stratalake.errors import BadInput
from stratalake.functions.text import sql_name, sql_text
from stratalake.operators.joins import find_hot_keys
from stratalake.operators.profile import sampled_row_chars
from stratalake.schemas import LOAD_DATE
from stratalake.sinks.tables import TABLE_FORMAT, drop_partition, table_exists
from stratalake.sources.tables import slice_of
from stratalake.workspace import path_exists

HOT = "chave_quente"
"""Partition column of a layout: 1 for the rows of hot keys, which fill no bucket evenly."""


@dataclass(frozen=True)
class BucketLayout:
    """A copy of a table in ``buckets`` files a load date, by a hash of ``key``.

    Two tables join without a shuffle if both have a layout by the join key with as many buckets. With
    ``split_hot``, the rows of keys with more than ``Lake.rows_per_task`` rows lie in a partition of their own.
    """

    source: LakeTable
    key: str
    buckets: int
    split_hot: bool = False

    @property
    def table(self) -> LakeTable:
        columns = [f for f in self.source.schema.fields if f.name not in self.source.partition_by]
        parts = [T.StructField(LOAD_DATE, T.StringType()), T.StructField(HOT, T.IntegerType())]
        return LakeTable(
            self.source.database,
            f"{self.source.name}_por_{self.key}",
            T.StructType([*columns, *parts]),
            (LOAD_DATE, HOT),
        )


def create_layout(spark: SparkSession, lake: Lake, layout: BucketLayout) -> None:
    """Create the table of a layout, where it is absent, with the columns its source has by now."""
    table = layout.table
    if table_exists(spark, lake, table):
        stored = spark.sql(f"DESCRIBE TABLE EXTENDED {table.full_name(lake)}").where("col_name = 'Num Buckets'").first()
        if stored is None or int(stored.data_type) != layout.buckets:
            raise BadInput(f"{table.name} does not have {layout.buckets} buckets")
        return
    has_data = path_exists(spark, table.path(lake))
    source = spark.table(layout.source.full_name(lake)).schema
    columns = [f"{sql_name(f.name)} {f.dataType.simpleString()}" for f in source if f.name not in layout.source.partition_by]
    parts = [f"{f.name} {f.dataType.simpleString()}" for f in table.schema.fields if f.name in table.partition_by]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table.full_name(lake)} ({', '.join([*columns, *parts])}) "
        f"USING {TABLE_FORMAT} PARTITIONED BY ({', '.join(table.partition_by)}) "
        f"CLUSTERED BY ({sql_name(layout.key)}) INTO {layout.buckets} BUCKETS LOCATION {sql_text(table.path(lake))}"
    )
    if has_data:
        spark.catalog.recoverPartitions(table.full_name(lake))


def put_layout(spark: SparkSession, lake: Lake, layout: BucketLayout, load_date: str) -> dict[int, int]:
    """Lay out one load date of the source, in place of what the layout held of it; rows by ``HOT``.

    The rows are shuffled once, here, so that each bucket is one file; rows of hot keys are dealt by a hash of
    the whole row to tasks of ``rows_per_task`` rows, but to no more tasks than a shuffle has, unless
    their files would be larger than the target. Null is a key as any other. An empty slice leaves an empty layout.
    Columns that the source got since the layout was made are added to it.
    """
    create_layout(spark, lake, layout)
    name = layout.table.full_name(lake)
    rows = slice_of(spark.table(layout.source.full_name(lake)), load_date).drop(*layout.source.partition_by)
    known = {f.name.lower() for f in spark.table(name).schema.fields}
    if new := [f for f in rows.schema.fields if f.name.lower() not in known]:
        listed = ", ".join(f"{sql_name(f.name)} {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({listed})")
    order = [f.name for f in spark.table(name).schema.fields if f.name not in layout.table.partition_by]
    rows = rows.select(*(F.col(sql_name(c)) for c in order))
    key = F.col(sql_name(layout.key))
    even = rows.withColumn(HOT, F.lit(0))
    parts = [even.repartition(layout.buckets, key)]
    hot = find_hot_keys(rows, layout.key, lake.rows_per_task) if layout.split_hot else None
    tasks = hot.agg(F.sum("__salts")).first()[0] if hot is not None else None
    if tasks:
        # A small rows_per_task makes no more files, and no more blocks of a shuffle, than the bytes ask for.
        per_file = lake.rows_per_file(sampled_row_chars(rows))
        shuffle = int(spark.conf.get("spark.sql.shuffle.partitions"))
        tasks = min(tasks, max(shuffle, -(-tasks * lake.rows_per_task // per_file)))
        same = key.eqNullSafe(F.col("__hot"))
        parts = [
            even.join(F.broadcast(hot), same, "left_anti").repartition(layout.buckets, key),
            rows.join(F.broadcast(hot), same, "left_semi").withColumn(HOT, F.lit(1))
            .repartition(int(tasks), F.xxhash64(*order, F.spark_partition_id())),
        ]
    whole = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    # Dynamic: only partitions that rows go to are replaced, once the new files are committed.
    columns = ", ".join(map(sql_name, order))
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        spark.sql(
            f"INSERT OVERWRITE TABLE {name} PARTITION ({LOAD_DATE} = {sql_text(load_date)}, {HOT}) "
            f"SELECT {columns}, {HOT} FROM {{rows}}",
            rows=whole,
        )
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    # A partition that no row went to was not replaced.
    for part, place in ((parts[0], 0), *([(rows.limit(0), 1)] if not tasks else [])):
        if part.isEmpty():
            drop_partition(spark, lake, layout.table, {LOAD_DATE: load_date, HOT: str(place)})
    counts = slice_of(spark.table(name), load_date).groupBy(HOT).count().collect()
    return {r[HOT]: r["count"] for r in counts}


def layout_scan(
    spark: SparkSession, lake: Lake, layout: BucketLayout, load_date: str
) -> tuple[DataFrame, DataFrame | None]:
    """The even rows of a load date, read by bucket, and those of hot keys, if there are any.

    A layout that does not hold as many rows as its source, or was written before the source's files were, is out of
    date and refused; footers and listings tell.
    """
    if not table_exists(spark, lake, layout.table):
        raise BadInput(f"there is no layout {layout.table.name}")
    source = slice_of(spark.table(layout.source.full_name(lake)), load_date)
    rows = slice_of(spark.table(layout.table.full_name(lake)), load_date)
    at, count = F.col("_metadata.file_modification_time"), F.count(F.lit(1)).alias("rows")
    want = source.agg(count, F.max(at).alias("at")).first()
    got = rows.agg(count, F.min(at).alias("at"), F.count_if(F.col(HOT) == 1).alias("hot")).first()
    if want.rows != got.rows or (want.rows and want.at > got.at):
        raise BadInput(f"the layout {layout.table.name} of {load_date} is out of date: {got.rows} of {want.rows} rows")
    parts = [rows.where(F.col(HOT) == h).drop(*layout.table.partition_by) for h in (0, 1)]
    return parts[0], parts[1] if got.hot else None
