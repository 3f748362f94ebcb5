"""Global positions and running totals without sending the table through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from odolake.session import checkpoint

_ROW_BITS = 33  # monotonically_increasing_id keeps the partition number above bit 33


def running_total(df: DataFrame, order: list[Column | str], weight: Column | str, name: str) -> DataFrame:
    """Running total of ``weight`` over the whole table in the given (total) order.

    The table is range-partitioned and sorted once and written to a reliable checkpoint, which
    pins the partitions. Every partition then adds up its own rows, and the totals of the partitions
    before it (one row per partition) come in as an offset.
    """
    weight = F.col(weight) if isinstance(weight, str) else weight
    stamped = checkpoint(
        df.withColumn("_w", weight).orderBy(*order).withColumn("_at", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_at", _ROW_BITS))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        stamped.groupBy("_part")
        .agg(F.sum("_w").alias("_sum"))
        .select("_part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    # At most one offset row per partition of the sort, so broadcasting them is always safe.
    return (
        stamped.withColumn("_run", F.sum("_w").over(inside))
        .join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_run") + F.col("_before"))
        .drop("_part", "_at", "_w", "_run", "_before")
    )


def with_position(df: DataFrame, order: list[Column | str], name: str = "position") -> DataFrame:
    """Position 1, 2, 3 … of every row in a total order of the whole table."""
    return running_total(df, order, F.lit(1).cast("bigint"), name)


def zip_rows(left: DataFrame, right: DataFrame, left_order: list, right_order: list) -> DataFrame:
    """Pair the n-th row of one table with the n-th row of the other; the shorter one ends it."""
    return with_position(left, left_order).join(with_position(right, right_order), "position")
