"""Group summaries and imputation."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from odolake.functions.numbers import exact_mean
from odolake.operators.joining import join_salted
from odolake.operators.ordering import running_total


def impute_group_mean(df: DataFrame, group: str, value: str) -> DataFrame:
    """Missing values become the mean of their group."""
    means = df.groupBy(group).agg(exact_mean(F.col(value)).alias("_mean"))
    return join_salted(df, means, group, "left").withColumn(value, F.coalesce(value, "_mean")).drop("_mean")


def group_mean(df: DataFrame, group: str, value: str, name: str = "mean_value") -> DataFrame:
    return df.groupBy(group).agg(exact_mean(F.col(value)).alias(name))


def above_group_mean(df: DataFrame, group: str, value: str) -> DataFrame:
    """Rows whose value is above the mean of their group.

    The means are combined map-side; rows of a hot group meet them in several tasks.
    """
    means = group_mean(df, group, value, "_mean")
    return join_salted(df, means, group).where(F.col(value) > F.col("_mean")).drop("_mean")


def column_means(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.agg(*[exact_mean(F.col(c)).alias(f"mean_{c}") for c in cols])


QUARTILES = {"p25": 0.25, "p50": 0.5, "p75": 0.75}


def group_describe(df: DataFrame, group: str, value: str) -> DataFrame:
    """Count, mean, sample deviation, extremes and exact quartiles (linear interpolation) per group.

    Equal values are counted first. Their running count in (group, value) order gives every value
    its rank range, so a quartile is found by comparing ranks and no group is gathered in a task.
    """
    present = df.where(F.col(value).isNotNull())
    stats = present.groupBy(group).agg(
        F.count(value).alias("count"),
        exact_mean(F.col(value)).alias("mean"),
        F.stddev_samp(value).alias("std"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
    )
    counted = present.groupBy(group, value).agg(F.count(F.lit(1)).alias("_n"))
    ranked = running_total(counted, [group, value], "_n", "_upto").withColumn("_from", F.col("_upto") - F.col("_n"))
    spans = ranked.groupBy(group).agg(F.min("_from").alias("_base"), F.max("_upto").alias("_end"))

    def at_rank(rank) -> F.Column:
        inside = (F.col("_from") - F.col("_base") <= rank) & (rank < F.col("_upto") - F.col("_base"))
        return F.max(F.when(inside, F.col(value)))

    last = F.col("_end") - F.col("_base") - 1
    picks = []
    for name, q in QUARTILES.items():
        spot = F.lit(q) * last
        picks += [
            at_rank(F.floor(spot)).alias(f"_lo_{name}"),
            at_rank(F.ceil(spot)).alias(f"_hi_{name}"),
            F.max(spot - F.floor(spot)).alias(f"_part_{name}"),
        ]
    quartiles = (
        join_salted(ranked, spans, group)
        .groupBy(group)
        .agg(*picks)
        .select(
            group,
            *[
                (F.col(f"_lo_{q}") + (F.col(f"_hi_{q}") - F.col(f"_lo_{q}")) * F.col(f"_part_{q}")).alias(q)
                for q in QUARTILES
            ],
        )
    )
    return stats.join(quartiles, group)
