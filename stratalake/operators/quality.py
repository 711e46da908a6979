"""Checks of a load, and their results as DataFrames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.errors import QualityError
from stratalake.functions.text import sql_name


def row_hash(values: Mapping[str, Column]) -> Column:
    """64 bits of a row: each value with its column's name, nulls left out.

    A column that was added later, and so is null, changes nothing; nor does the order of the columns. A hash of several
    values passes over nulls, so no array without them is built for each row.
    """
    parts = [
        F.when(values[name].isNotNull(), F.xxhash64(F.lit(name.lower()), values[name]))
        for name in sorted(values, key=str.lower)
    ]
    return F.xxhash64(*parts)


def fingerprint_totals(values: Mapping[str, Column], kept: Column | None = None) -> list[Column]:
    """Aggregates that tell one multiset of rows from another: the sum and the exclusive or of their hashes."""
    hashed = row_hash(values)
    return hash_totals(hashed if kept is None else F.when(kept, hashed))


def hash_totals(hashed: Column) -> list[Column]:
    """The same aggregates of hashes that rows hold already; a null hash counts for nothing."""
    return [
        F.sum(hashed.cast("decimal(20,0)")).alias("fingerprint_sum"),
        F.bit_xor(hashed).alias("fingerprint_xor"),
    ]


def required_columns(columns: Sequence[str], required: Sequence[str]) -> None:
    """Raise when a required column is absent."""
    missing = [name for name in required if name not in columns]
    if missing:
        raise QualityError(f"required columns are missing: {', '.join(missing)}")


def required_not_null(nulls: Mapping[str, int], required: Sequence[str]) -> dict[str, int]:
    """Raise when a required column has nulls; return the other columns that have some."""
    required_columns(list(nulls), required)
    bad = {name: nulls[name] for name in required if nulls[name] > 0}
    if bad:
        raise QualityError(f"required columns hold nulls: {bad}")
    return {name: n for name, n in nulls.items() if n > 0 and name not in required}


MISFIT = "more or fewer values than the header"

REQUIRED_IS_NULL = "a required column holds a null: "


def fail_on_null(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The same rows, where a null in a required column fails the job that reads them."""
    return df.withColumns({
        name: F.coalesce(F.col(sql_name(name)), F.raise_error(REQUIRED_IS_NULL + name))
        for name in required
    })


def refusal(required: Sequence[str], misfit: Column | None = None) -> Column:
    """Why a row is refused: a record that does not fit its header, or the first required column that is null.

    Null for a good row.
    """
    reason = F.lit(None).cast("string")
    for name in reversed(required):
        reason = F.when(F.col(sql_name(name)).isNull(), f"{name} is null").otherwise(reason)
    return reason if misfit is None else F.when(misfit, MISFIT).otherwise(reason)


def null_report(counts: DataFrame, required: Sequence[str]) -> DataFrame:
    """``null_counts`` with the verdict of each column: ok, error for a required one, else noted."""
    needed = F.col("column_name").isin(*required)
    verdict = (
        F.when(F.col("nulls") == 0, "ok").when(needed, "error").otherwise("noted")
    )
    return counts.select("column_name", "nulls", needed.alias("required"), verdict.alias("verdict"))


def reconcile(loaded: DataFrame, in_slice: DataFrame) -> DataFrame:
    """One row: rows loaded, rows now in the slice, and whether they differ."""
    left = loaded.select(F.lit(1).alias("l"), F.lit(0).alias("s"))
    right = in_slice.select(F.lit(0).alias("l"), F.lit(1).alias("s"))
    counts = left.unionAll(right).agg(
        F.coalesce(F.sum("l"), F.lit(0)).alias("rows_loaded"),
        F.coalesce(F.sum("s"), F.lit(0)).alias("rows_in_slice"),
    )
    return counts.withColumn("alert", F.col("rows_loaded") != F.col("rows_in_slice"))


def reconcile_content(loaded: DataFrame, in_slice: DataFrame) -> DataFrame:
    """One row: rows loaded, rows now in the slice, whether their counts and whether their contents differ.

    Contents are compared by an order-free fingerprint of all columns, so a lost row and a doubled one do not
    cancel out. Columns are compared by name; one that only one side has must be null throughout.
    """

    def summed(df: DataFrame, side: str) -> DataFrame:
        values = {c: F.col(sql_name(c)).cast("string") for c in df.columns}
        found = df.agg(F.count(F.lit(1)).alias("rows"), *fingerprint_totals(values))
        return found.select(*[F.col(c).alias(f"{c}_{side}") for c in found.columns])

    def differs(name: str) -> Column:
        return ~F.col(f"{name}_loaded").eqNullSafe(F.col(f"{name}_slice"))

    both = summed(loaded, "loaded").crossJoin(summed(in_slice, "slice"))  # one row each
    return both.select(
        F.col("rows_loaded"),
        F.col("rows_slice").alias("rows_in_slice"),
        differs("rows").alias("count_alert"),
        (differs("rows") | differs("fingerprint_sum") | differs("fingerprint_xor")).alias("alert"),
    )


def metrics_complete(columns: Sequence[str], flag: str = "execution_succes") -> Column:
    """True when every metric but the flag itself is set."""
    complete = F.lit(True)
    for name in columns:
        if name != flag:
            complete = complete & F.col(name).isNotNull()
    return complete


def complete(metrics: Mapping[str, object], flag: str = "execution_succes") -> bool:
    """The same for metrics still on the driver."""
    return all(value is not None for name, value in metrics.items() if name != flag)
