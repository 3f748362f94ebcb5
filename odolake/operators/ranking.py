"""Top lists, membership and the pairing of two ranked lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def top_per_group(df: DataFrame, group: list[str], order: list[Column]) -> DataFrame:
    """First row of each group. The order must be total.

    Spark keeps only each task's best row per group before the shuffle (``WindowGroupLimit``),
    so a hot group does not pile up in one task.
    """
    first = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") == 1).drop("_rank")


def drop_repeats(df: DataFrame, subset: list[str], order: list[Column]) -> DataFrame:
    """One row per value of the ``subset`` columns, the first one by ``order``, which must be total. Nulls are one value."""
    return top_per_group(df, subset, order)


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    return df.orderBy(*order).limit(k)


def in_list(df: DataFrame, ids: DataFrame, on: str) -> DataFrame:
    """Rows whose key is in a list of ids taken from another table."""
    return df.join(ids.select(on).distinct(), on, "left_semi")


def pair_by_rank(left: DataFrame, right: DataFrame, left_order: list[Column], right_order: list[Column]) -> DataFrame:
    """Pair two top-k lists by rank; the longer list keeps its tail with nulls.

    Both inputs come out of ``top_k``, so the windows without partition see k rows at most.
    """
    rank = F.row_number()
    a = left.withColumn("rank", rank.over(Window.orderBy(*left_order)))
    b = right.withColumn("rank", rank.over(Window.orderBy(*right_order)))
    return a.join(b, "rank", "full_outer")
