"""What changed between two snapshots of a table, and the current state they add up to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.text import sql_name
from stratalake.operators.quality import row_hash

CHANGE = "mudanca"
"""Column with the kind of a change."""

INSERT, UPDATE, DELETE = "insert", "update", "delete"


def latest_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each key: the greatest in ``order``, by all columns in a tie; null orders first.

    An aggregate that each task combines before the shuffle, so a key with most of the rows costs no more than
    another; a window would send all rows of a key to one task. Null is a key like others.
    """
    rest = [c for c in rows.columns if c not in keys]
    # Structs compare column by column, null before all values.
    ranked = F.struct(*[F.col(sql_name(c)).alias(f"o{i}") for i, c in enumerate(order)],
                      *[F.col(sql_name(c)).alias(f"v{i}") for i, c in enumerate(rest)])
    newest = rows.groupBy(*[F.col(sql_name(k)) for k in keys]).agg(F.max(ranked).alias("__newest"))
    columns = {c: F.col(f"__newest.v{i}") for i, c in enumerate(rest)}
    return newest.select(*[columns.get(c, F.col(sql_name(c))).alias(c) for c in rows.columns])


def _hashed(rows: DataFrame, keys: Sequence[str]) -> Column:
    return row_hash({c: F.col(sql_name(c)) for c in rows.columns if c not in keys})


def snapshot_changes(before: DataFrame, after: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inserts, updates and deletes that turn one snapshot into another, with the column ``CHANGE`` in front.

    Keys are unique in a snapshot; null is a key like others. The two sides meet by their keys with a hash of their
    other columns only, and a key that is in both with one hash goes no further; a null and an absent column are
    the same. A delete has the row as it was before, an insert or update as it is after; a column that one side
    lacks is null there.
    """
    names = [*after.columns, *[c for c in before.columns if c not in after.columns]]

    def side(rows: DataFrame, name: str) -> DataFrame:
        there = F.struct(*[F.col(sql_name(c)) for c in rows.columns if c not in keys])
        return rows.select(
            *[F.col(sql_name(k)).alias(f"{name}_{k}") for k in keys],
            _hashed(rows, keys).alias(f"{name}_hash"), there.alias(f"{name}_row"),
        )

    old, new = side(before, "old"), side(after, "new")
    same_key = F.lit(True)
    for k in keys:
        same_key &= F.col(sql_name(f"old_{k}")).eqNullSafe(F.col(sql_name(f"new_{k}")))
    met = old.join(new, same_key, "full")
    kind = (
        F.when(F.col("old_hash").isNull(), INSERT)
        .when(F.col("new_hash").isNull(), DELETE)
        .when(F.col("old_hash") != F.col("new_hash"), UPDATE)
    )
    changed = met.withColumn(CHANGE, kind).where(F.col(CHANGE).isNotNull())

    def value(name: str) -> Column:
        if name in keys:
            gone = F.col(CHANGE) == DELETE
            return F.when(gone, F.col(sql_name(f"old_{name}"))).otherwise(F.col(sql_name(f"new_{name}")))
        old_value = F.col(f"old_row.{sql_name(name)}") if name in before.columns else F.lit(None)
        new_value = F.col(f"new_row.{sql_name(name)}") if name in after.columns else F.lit(None)
        return F.when(F.col(CHANGE) == DELETE, old_value).otherwise(new_value)

    return changed.select(CHANGE, *[value(name).alias(name) for name in names])


def apply_changes(current: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The current state after changes: a row of a changed key is replaced or gone, all others stay.

    Changes of one batch have a key once. An anti join keeps untouched rows as they are; nothing is grouped.
    """
    touched = changes.select(*[F.col(sql_name(k)).alias(f"__{k}") for k in keys])
    same_key = F.lit(True)
    for k in keys:
        same_key &= F.col(sql_name(k)).eqNullSafe(F.col(sql_name(f"__{k}")))
    kept = current.join(touched, same_key, "left_anti")
    put = changes.where(F.col(CHANGE) != DELETE).drop(CHANGE)
    return kept.unionByName(put, allowMissingColumns=True)
