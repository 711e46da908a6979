"""What several operators share: stored steps, file systems of tasks, ranks and word rules."""

from __future__ import annotations

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stratalake.workspace import delete_path, new_folder

#: A word of the mixing and joining contracts: what lies between ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows written to the shared folder and read back, so that lost executors cost no lineage."""
    path = new_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*frames: DataFrame) -> None:
    """Delete the folders of stored rows that nothing reads any more."""
    for df in frames:
        for file in df.inputFiles()[:1]:
            delete_path(df.sparkSession, file.rsplit("/", 1)[0])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """A file system that tasks can use, and the path of the folder within it."""
    return fs.FileSystem.from_uri(uri if ":/" in uri else f"file://{uri}")


def utf8_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long"))


def word_count(text: Column) -> Column:
    """The words of a text, 0 of null; no array of them is made: each word becomes one letter, and the letters count."""
    letters = F.translate(F.regexp_replace(text, rf"{WORD}[\x20\x09-\x0D]*", "x"), " \t\n\x0b\x0c\r", "")
    return F.coalesce(F.length(letters).cast("long"), F.lit(0).cast("long"))


def unit_interval(*columns: Column, bits: int = 30) -> Column:
    """A repeatable whole number in [0, 2^bits), as good as random."""
    return F.pmod(F.xxhash64(*columns), F.lit(1 << bits))


def in_training_part(doc_id: Column) -> Column:
    """Rows that labels may be learned from: crc32 of the id as text, modulo 4, is not 2."""
    return F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % 4 != 2


def ranked(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """Rows numbered from 0 in a total order, by range partitions and the counts before each."""
    parted = stored(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "ranked"
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parted.groupBy("_part").count().select(
        F.col("_part").alias("_at"),
        F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_before"),
    )
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        parted.join(F.broadcast(offsets), F.col("_part") == F.col("_at"))
        .withColumn(name, F.col("_before") + within - 1)
        .drop("_part", "_at", "_before")
    )


def numbered(df: DataFrame, group: str, key: Column, order: list[Column], rows: int, groups: int,
             name: str, per_bucket: int = 50_000) -> DataFrame:
    """Rows numbered from 0 without gaps within each group, however large the group.

    ``key`` deals the rows of a group to buckets; rows are numbered within a bucket and the counts of
    the buckets before it are added, so no task sees a whole group.
    """
    buckets = max(16, rows // (max(1, groups) * per_bucket) + 1)
    dealt = df.withColumn("_bucket", F.pmod(key, F.lit(buckets)))
    before = Window.partitionBy(group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dealt.groupBy(group, "_bucket").count()
        .withColumn("_before", F.coalesce(F.sum("count").over(before), F.lit(0)))
        .select(group, "_bucket", "_before")
    )
    within = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(*order))
    return (
        dealt.withColumn("_within", within)
        .join(offsets, [group, "_bucket"])
        .withColumn(name, F.col("_before") + F.col("_within") - 1)
        .drop("_before", "_within", "_bucket")
    )


def id_hash(column: Column) -> Column:
    """The first 32 bits of the md5 of an id as text, the same in Spark and in SQL."""
    digest = F.md5(F.coalesce(column.cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def placed(df: DataFrame, groups: list[str], order: list[Column], name: str, total: str) -> DataFrame:
    """Rows numbered from 0 within their group in a total order, and the rows of the group.

    Rows are dealt to ranges of the groups and the order, so a group of any size fills as many partitions
    as it needs; a row's number is its place in the partition and the counts of its group in those before.
    ``order`` should tell the rows of a group apart: rows that it does not are kept in one partition.
    Null is a group of its own. The result is stored.
    """
    ranges = [F.col(g).asc_nulls_first() for g in groups]
    parted = stored(df.repartitionByRange(*ranges, *order).withColumn("_part", F.spark_partition_id()), "parted")
    of_group = Window.partitionBy(*groups)
    before = of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each partition and each group within it.
    offsets = parted.groupBy("_part", *groups).agg(F.count("*").alias("_here")).select(
        F.col("_part").alias("_at"),
        *(F.col(g).alias(f"_at_{g}") for g in groups),
        F.coalesce(F.sum("_here").over(before), F.lit(0)).alias("_before"),
        F.sum("_here").over(of_group).alias(total),
    )
    within = F.row_number().over(Window.partitionBy("_part", *groups).orderBy(*order))
    same = F.col("_part") == F.col("_at")
    for g in groups:
        same &= F.col(g).eqNullSafe(F.col(f"_at_{g}"))
    numbered_rows = parted.withColumn("_within", within).join(offsets, same)
    result = stored(
        numbered_rows.select(*df.columns, (F.col("_before") + F.col("_within") - 1).alias(name), total), "placed"
    )
    discard(parted)
    return result


#: A CTE for SQL, ``bits``: the table of the byte-wise checksum.
SQL_BITS = """bits AS (SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS crcs)"""


def sql_crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text in UTF-8; needs ``bits`` in its FROM clause."""
    return f"""xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
        regexp_extract_all(hex(encode({text})), '..'), lambda p: CAST('0x' || p AS BIGINT))),
        lambda c, b: xor(c >> 8, crcs[CAST(xor(c, b) & 255 AS BIGINT) + 1])))"""
