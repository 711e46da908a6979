"""Lookups that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.workspace import new_folder

BROADCAST_KEYS = 1_000_000
"""Hot keys that may be broadcast: a key and a number each."""

SALTS_PER_TASK = 4
"""Salts of one key for each task of a shuffle: enough that they deal its rows evenly; more spread them no further."""

_SALT = "__salt"
_SALTS = "__salts"
_HOT = "__hot"


def find_hot_keys(df: DataFrame, key: str, rows_per_task: int) -> DataFrame:
    """The keys with more rows than one task should take, and the tasks to spread each over.

    Counted exactly, with counts combined in each task before the shuffle; a null key is a key. There are
    at most rows/``rows_per_task`` of them. They are stored, so that both sides of a join read the same
    small table, by the tasks that add up the counts: one task for all would read the counts of every key.
    """
    counts = df.groupBy(F.col(key).alias(_HOT)).agg(F.count(F.lit(1)).alias("rows"))
    hot = counts.where(F.col("rows") > rows_per_task).select(
        _HOT, F.ceil(F.col("rows") / rows_per_task).cast("int").alias(_SALTS)
    )
    path = new_folder(df.sparkSession, "hot-keys")
    hot.write.parquet(path)
    return df.sparkSession.read.schema(hot.schema).parquet(path)


def _to_broadcast(hot: DataFrame) -> DataFrame:
    """The hot keys that are salted: all, or where they are too many to broadcast those with most rows.

    Facts that met a larger table would be shuffled by the bare key once more, hot rows together. A key beyond those
    kept has fewer rows than a part in ``BROADCAST_KEYS`` of them; it is joined as any other key.
    """
    most = SALTS_PER_TASK * int(hot.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hot = hot.withColumn(_SALTS, F.least(_SALTS, F.lit(most)))
    kept, least = 0, 1
    # One row for each number of salts, at most ``most`` of them.
    for row in hot.groupBy(_SALTS).count().orderBy(F.desc(_SALTS)).collect():
        kept += row["count"]
        if kept > BROADCAST_KEYS:
            least = row[_SALTS] + 1
            break
    return F.broadcast(hot.where(F.col(_SALTS) >= least))


def salted(facts: DataFrame, lookup: DataFrame, key: str, hot: DataFrame):
    """Both sides with a salt column.

    Each fact row of a hot key gets one of the salts of its key, from a hash of the row and of the
    partition it is in. Both are the same when a lost task runs again, and equal copies of a row
    still spread. The lookup rows of a hot key are repeated once for each salt; a key has no more salts than spread its rows.
    """
    hot = _to_broadcast(hot)
    salts = F.coalesce(F.col(_SALTS), F.lit(1))
    row_hash = F.xxhash64(*facts.columns, F.spark_partition_id())
    facts = (
        facts.withColumn(_SALT, row_hash)
        .join(hot, F.col(key).eqNullSafe(F.col(_HOT)), "left")
        .withColumn(_SALT, F.pmod(F.col(_SALT), salts).cast("int"))
        .drop(_SALTS, _HOT)
    )
    lookup = (
        lookup.join(hot, F.col(key) == F.col(_HOT), "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), salts - 1)))
        .drop(_SALTS, _HOT)
    )
    return facts, lookup


def lookup_join(
    facts: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "left",
    *,
    hot: DataFrame | None = None,
    broadcast_lookup: bool = False,
) -> DataFrame:
    """Join facts to a lookup table on one key.

    ``broadcast_lookup`` is for a lookup whose size has been checked. Otherwise both sides are
    shuffled by the key, with the hot keys salted. Rows without a key match nothing; when there
    are many, they are salted too and so do not gather in one task.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a lookup join is left or inner, not {how!r}")
    if broadcast_lookup:
        return facts.join(F.broadcast(lookup), key, how)
    if hot is None:
        return facts.join(lookup, key, how)
    columns = facts.columns
    left, right = salted(facts, lookup, key, hot)
    joined = left.join(right, [key, _SALT], how)
    added = [c for c in lookup.columns if c != key]
    return joined.select(*columns, *added)
