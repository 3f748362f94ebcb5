"""Scaling, cluster labels and consumption models on tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from odolake.functions.numbers import exact_mean, fixed_point, half_up
from odolake.operators.joining import join_salted
from odolake.session import checkpoint


def standardize(df: DataFrame, cols: list[str], suffix: str = "_std") -> DataFrame:
    """``(x - mean) / population deviation``; the statistics are one row, read as scalar subqueries."""
    out = {}
    for c in cols:
        mean = df.agg(F.avg(c)).scalar()
        deviation = df.agg(F.stddev_pop(c)).scalar()
        out[c + suffix] = F.try_divide(F.col(c) - mean, deviation)
    return df.withColumns(out)


def assign_cluster(df: DataFrame, features: list[str], centroids: list[list[float]], name: str = "cluster") -> DataFrame:
    """Label of the nearest given centroid; ties go to the lower label."""

    def squared(centroid: list[float]) -> Column:
        total = F.lit(0.0)
        for c, at in zip(features, centroid):
            total = total + (F.col(c) - F.lit(at)) * (F.col(c) - F.lit(at))
        return total

    scored = F.array(*[F.struct(squared(c).alias("d"), F.lit(i).alias("label")) for i, c in enumerate(centroids)])
    return df.withColumn(name, F.array_min(scored)["label"])


def rank_clusters(df: DataFrame, cluster: str, by: str) -> DataFrame:
    """Add ``is_best``: the cluster with the highest mean; cluster numbers carry no order."""
    means = df.groupBy(cluster).agg(exact_mean(F.col(by)).alias("_m"))
    best = means.agg(F.max_by(cluster, F.struct("_m", F.negative(cluster)))).scalar()
    return df.withColumn("is_best", F.col(cluster) == best)


def categories(df: DataFrame, column: str) -> list[str]:
    """Sorted distinct values, as columns of a wide encoding; for many values use ``one_hot_rows``."""
    found = df.select(column).where(F.col(column).isNotNull()).distinct().collect()
    return sorted(row[0] for row in found)


def one_hot_rows(df: DataFrame, key: list[str], column: str, drop_first: bool = True) -> DataFrame:
    """The encoding as rows (key, category, 1) without zeros: any number of categories, nothing on the driver."""
    rows = df.where(F.col(column).isNotNull()).select(*key, F.col(column).alias("category"), F.lit(1).alias("value"))
    if not drop_first:
        return rows
    first = df.agg(F.min(column)).scalar()
    return rows.where(F.col("category") != first)


def one_hot(df: DataFrame, column: str, drop_first: bool = True) -> DataFrame:
    """One 0/1 column per category, without the alphabetically first one."""
    kept = categories(df, column)[1 if drop_first else 0 :]
    flags = {f"{column}_{value}": F.coalesce((F.col(column) == value).cast("int"), F.lit(0)) for value in kept}
    return df.withColumns(flags).drop(column)


def holdout(key: Column, second: Column | None = None, train_tenths: int = 7) -> Column:
    """True for training rows; depends on the key only, so it survives any repartitioning."""
    ten = F.lit(10)
    # Only last digits matter; reducing first keeps large keys from overflowing.
    mixed = F.pmod(key, ten) * F.lit(7919) + (F.pmod(second, ten) if second is not None else F.lit(0))
    return F.pmod(mixed, ten) < train_tenths


def simple_regression(df: DataFrame, y: str, x: str) -> DataFrame:
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def factor_regression(df: DataFrame, y: str, x: str, factor: str) -> DataFrame:
    """Least squares of ``y`` on ``x`` and a one-hot factor (first category dropped).

    With one factor the solution is closed: the common slope comes from the deviations within each
    category, and a category's level is its mean ``y`` less slope times mean ``x``. So one map-side
    combined aggregate per category replaces the wide dummy matrix, for any number of categories.
    Returns ``variable``, ``coefficient``, ``coefficient_abs``; the row ``(intercept)`` is the
    first category's level.
    """
    rows = df.where(F.col(y).isNotNull() & F.col(x).isNotNull() & F.col(factor).isNotNull())
    cells = checkpoint(
        rows.groupBy(factor).agg(
            F.count(F.lit(1)).alias("_n"),
            F.avg(x).alias("_mx"),
            F.avg(y).alias("_my"),
            F.covar_pop(x, y).alias("_cxy"),
            F.var_pop(x).alias("_vx"),
        )
    )
    slope = F.try_divide(F.sum(F.col("_cxy") * F.col("_n")), F.sum(F.col("_vx") * F.col("_n")))
    model = cells.agg(
        F.struct(
            slope.alias("slope"),
            F.min(factor).alias("first"),
            F.min_by("_mx", factor).alias("first_mx"),
            F.min_by("_my", factor).alias("first_my"),
        )
    ).scalar()
    level = F.col("_my") - model["slope"] * F.col("_mx")
    base = model["first_my"] - model["slope"] * model["first_mx"]

    def line(variable: Column, coefficient: Column) -> Column:
        return F.struct(variable.alias("variable"), coefficient.alias("coefficient"))

    lines = F.when(
        F.col(factor) == model["first"],
        F.array(line(F.lit(x), model["slope"]), line(F.lit("(intercept)"), base)),
    ).otherwise(F.array(line(F.concat(F.lit(f"{factor}_"), F.col(factor)), level - base)))
    return cells.select(F.inline(lines)).withColumn("coefficient_abs", F.abs("coefficient"))


def rank_coefficients(coefficients: DataFrame, digits: int = 6) -> DataFrame:
    """Feature coefficients by size of the number itself, with its fixed-point text."""
    features = coefficients.where(F.col("variable") != "(intercept)")
    return features.withColumn("coefficient_text", fixed_point(half_up(F.col("coefficient_abs"), digits))).orderBy(
        F.desc("coefficient_abs"), "variable"
    )


def factor_predictions(df: DataFrame, coefficients: DataFrame, x: str, factor: str, name: str = "predicted") -> DataFrame:
    """Predictions of ``factor_regression``; categories without a coefficient use the base level."""
    value = lambda which: coefficients.where(F.col("variable") == which).agg(F.max("coefficient")).scalar()
    levels = coefficients.where(F.col("variable").startswith(f"{factor}_")).select(
        F.substr("variable", F.lit(len(factor) + 2)).alias(factor), F.col("coefficient").alias("_shift")
    )
    joined = join_salted(df, levels, factor, "left")
    predicted = value("(intercept)") + value(x) * F.col(x) + F.coalesce("_shift", F.lit(0.0))
    return joined.withColumn(name, predicted).drop("_shift")


def regression_errors(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    error = F.col(actual) - F.col(predicted)
    return df.agg(F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("mse"))
