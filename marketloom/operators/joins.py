"""Joins on keys of which one may hold much of a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 100_000
SLICE_ROWS = 1_000_000


def has_at_most(df: DataFrame, rows: int) -> bool:
    """Whether the table has no more than ``rows`` rows, counting no further."""
    return df.select(F.lit(1)).limit(rows + 1).count() <= rows


def sliced_join(
    spread: DataFrame, repeated: DataFrame, key: str, spread_by: str, slice_rows: int = SLICE_ROWS
) -> DataFrame:
    """Inner join in which a key with many ``spread`` rows is worked on by many tasks.

    Rows of such a key go to slices by the hash of ``spread_by``, and its
    ``repeated`` rows are copied into each of them. Every pair meets in exactly
    one slice, so the result is that of the plain join.
    """
    # At most rows / slice_rows keys, which grow with the table: whether they are few enough to be
    # broadcast is left to adaptive execution.
    heavy = (
        spread.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_rows"))
        .filter(F.col("_rows") > slice_rows)
        .select(key, F.ceil(F.col("_rows") / slice_rows).cast("int").alias("_slices"))
    )
    slices = F.coalesce("_slices", F.lit(1))
    here = spread.join(heavy, key, "left").withColumn(
        "_slice", F.pmod(F.xxhash64(spread_by), slices).cast("int")
    )
    copies = repeated.join(heavy, key, "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), slices - 1))
    )
    joined = here.drop("_slices").join(copies.drop("_slices"), [key, "_slice"])
    return joined.drop("_slice")


def join_small(
    table: DataFrame,
    small: DataFrame,
    key: str,
    spread_by: str,
    broadcast_rows: int = BROADCAST_ROWS,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """Inner join with a table that is broadcast if it has few rows.

    Otherwise both are shuffled, and the rows of a heavy key in ``table`` are
    spread over slices.
    """
    if has_at_most(small, broadcast_rows):
        return table.join(F.broadcast(small), key)
    return sliced_join(table, small, key, spread_by, slice_rows)
