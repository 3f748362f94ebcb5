import random

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import functions as F

from odolake.operators import clustering, models, summary
from odolake.plans import costs

SCHEMA = "nome_usuario string, dist_km double, media_consumo_km_l double"


def vehicles(spark, sizes=(385, 14, 78)):
    """Three groups like the ones met in practice: the rest, long trips, economical vehicles."""
    rng = random.Random(1)
    centres = [(9.39, 9.22), (575.27, 10.94), (7.14, 20.82)]
    rows = []
    for group, ((d, k), n) in enumerate(zip(centres, sizes)):
        rows += [(f"v{group}", abs(rng.gauss(d, d / 5)), rng.gauss(k, 1.0)) for _ in range(n)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("seed", [0, 1])
def test_kmeans_finds_the_groups(spark, seed):
    found = clustering.kmeans_clusters(vehicles(spark), ["dist_km", "media_consumo_km_l"], seed=seed)
    ranked = models.rank_clusters(found, "cluster", "media_consumo_km_l")
    sizes = ranked.groupBy("nome_usuario", "cluster").count().collect()
    assert sorted(r["count"] for r in sizes) == [14, 78, 385]
    assert {r.nome_usuario for r in ranked.where("is_best").select("nome_usuario").distinct().collect()} == {"v2"}


def test_kmeans_does_not_depend_on_partitions(spark):
    rng = random.Random(8)
    rows = [(f"v{i % 7}", rng.uniform(0, 100), rng.uniform(5, 25)) for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    fits = []
    for made in (df, df.repartition(7), df.orderBy(F.desc("dist_km")).coalesce(1)):
        fits.append(clustering.fit_kmeans(made, ["dist_km", "media_consumo_km_l"], k=4, seed=3))
    assert fits[0] == fits[1] == fits[2] and fits[0].converged and fits[0].iterations > 2
    checks = fits[0].certificate(df).collect()
    assert sorted(r.cluster for r in checks) == [0, 1, 2, 3] and sum(r.n_rows for r in checks) == 600
    assert all(r.n_nearest == r.n_rows and r.is_mean and r.converged for r in checks)
    cut = clustering.fit_kmeans(df, ["dist_km", "media_consumo_km_l"], k=4, seed=3, max_iter=1)
    assert not cut.converged and not all(r.is_mean for r in cut.certificate(df).collect())


def test_kmeans_of_few_rows_and_missing_features(spark):
    rows = [("a", 1.0, 5.0), ("a", 1.0, 5.0), ("b", 9.0, 5.0), ("c", None, 5.0), ("d", float("nan"), 5.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    fit = clustering.fit_kmeans(df, ["dist_km", "media_consumo_km_l"], k=3)
    assert [round(c["dist_km"], 3) for c in fit.centres()] == [1.0, 9.0]
    assert sorted((r.nome_usuario, r.cluster) for r in fit.transform(df).collect()) == [("a", 0), ("a", 0), ("b", 1)]
    none = df.where("dist_km < 0")
    assert clustering.kmeans_clusters(none, ["dist_km", "media_consumo_km_l"]).isEmpty()


def test_chain_from_fit_to_swap_on_separable_groups(spark):
    """The group with the best economy is found by the fit, whatever its number, and drives the others' routes."""
    sizes = {"FAR_CAR": (600.0, 10.0), "OLD_CAR": (10.0, 8.0), "NEW_CAR": (10.0, 21.0)}
    rows = [(f"{name}_{i % 2}", d + i / 100, k + (i % 2) / 10) for name, (d, k) in sizes.items() for i in range(40)]
    found = clustering.kmeans_clusters(spark.createDataFrame(rows, SCHEMA), ["dist_km", "media_consumo_km_l"])
    ranked = models.rank_clusters(found, "cluster", "media_consumo_km_l")
    price = spark.createDataFrame([(6.0,)], "media double")
    worst = costs.worst_vehicles(costs.vehicle_totals(ranked.where("NOT is_best"), price))
    best = costs.best_vehicles(costs.vehicle_totals(ranked.where("is_best"), price))
    swap = costs.swap_simulation(worst, best, price).orderBy("rank").collect()
    assert [r.nome_usuario_original for r in swap] == ["OLD_CAR_0", "OLD_CAR_1", "FAR_CAR_0", "FAR_CAR_1"]
    assert [r.nome_usuario_simulado for r in swap] == ["NEW_CAR_1", "NEW_CAR_0", None, None]
    old = sum(10.0 + i / 100 for i in range(0, 40, 2))
    assert swap[0].dist_km_original == pytest.approx(old, abs=0.01)
    assert swap[0].custo_viagem_simulado == pytest.approx(old / 21.1 * 6.0, abs=0.01)


def test_assign_cluster_takes_the_nearest(spark):
    df = spark.createDataFrame([(0.0, 0.0), (9.0, 9.0), (5.0, 5.0)], "x double, y double")
    found = models.assign_cluster(df, ["x", "y"], [[0.0, 0.0], [10.0, 10.0]]).collect()
    assert [r.cluster for r in found] == [0, 1, 0]


def test_standardize_is_population_based(spark):
    values = [1.0, 2.0, 3.0, 10.0]
    df = spark.createDataFrame([(v, 5.0) for v in values], "x double, c double")
    rows = models.standardize(df, ["x", "c"]).orderBy("x").collect()
    expected = (np.array(values) - np.mean(values)) / np.std(values)
    assert [r.x_std for r in rows] == pytest.approx(list(expected))
    assert {r.c_std for r in rows} == {None}


def test_one_hot_drops_the_first_category(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, "c")], "id int, user string")
    found = models.one_hot(df, "user").orderBy("id")
    assert found.columns == ["id", "user_b", "user_c"]
    assert [tuple(r) for r in found.collect()] == [(1, 1, 0), (2, 0, 0), (3, 0, 1)]
    assert models.categories(df, "user") == ["a", "b", "c"]


def regression_rows(spark):
    rng = random.Random(2)
    level = {"a": 1.0, "b": -3.0, "c": 10.0, "d": 4.0}
    rows = []
    for i in range(400):
        user = rng.choice("aaaaaaabcd")
        x = rng.uniform(0, 50)
        rows.append((i, user, x, 0.7 * x + level[user] + rng.gauss(0, 0.3)))
    return spark.createDataFrame(rows, "id int, user string, x double, y double")


def test_factor_regression_equals_the_one_hot_fit(spark):
    df = regression_rows(spark)
    found = {r.variable: r.coefficient for r in models.factor_regression(df, "y", "x", "user").collect()}
    indexer = StringIndexer(inputCol="user", outputCol="_i", stringOrderType="alphabetDesc").fit(df)
    encoded = OneHotEncoder(inputCol="_i", outputCol="_v", dropLast=True)
    indexed = indexer.transform(df)
    data = VectorAssembler(inputCols=["x", "_v"], outputCol="features").transform(encoded.fit(indexed).transform(indexed))
    fitted = LinearRegression(labelCol="y").fit(data)
    names = ["x"] + [f"user_{label}" for label in indexer.labels[:-1]]
    assert found["(intercept)"] == pytest.approx(fitted.intercept, abs=1e-6)
    for name, value in zip(names, fitted.coefficients):
        assert found[name] == pytest.approx(value, abs=1e-6)
    assert set(found) == {"(intercept)", *names}

    predicted = models.factor_predictions(df, models.factor_regression(df, "y", "x", "user"), "x", "user")
    [errors] = models.regression_errors(predicted, "y", "predicted").collect()
    evaluator = RegressionEvaluator(labelCol="y", predictionCol="prediction")
    ours = fitted.transform(data)
    assert errors.mae == pytest.approx(evaluator.evaluate(ours, {evaluator.metricName: "mae"}), abs=1e-9)
    assert errors.mse == pytest.approx(evaluator.evaluate(ours, {evaluator.metricName: "mse"}), abs=1e-9)


def test_coefficients_rank_by_number_not_text(spark):
    df = spark.createDataFrame([("a", -10.0), ("b", 9.0), ("c", 0.5)], "variable string, coefficient double")
    ranked = models.rank_coefficients(df.withColumn("coefficient_abs", F.abs("coefficient"))).collect()
    assert [(r.variable, r.coefficient_text) for r in ranked] == [("a", "10.000000"), ("b", "9.000000"), ("c", "0.500000")]


def test_holdout_survives_repartitioning(spark):
    df = spark.range(0, 1000)
    a = df.where(models.holdout(F.col("id"))).orderBy("id").collect()
    b = df.repartition(7).where(models.holdout(F.col("id"))).orderBy("id").collect()
    assert a == b and len(a) == 700


def test_describe_equals_pandas(spark):
    rng = random.Random(5)
    rows = [("hot", float(rng.randint(0, 30))) for _ in range(500)] + [("small", rng.random()) for _ in range(7)] + [("one", 3.0), ("one", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    expected = pd.DataFrame(rows, columns=["g", "v"]).groupby("g")["v"].describe()
    for r in summary.group_describe(df, "g", "v").collect():
        want = expected.loc[r.g]
        got = [r["count"], r["mean"], r["min"], r["p25"], r["p50"], r["p75"], r["max"]]
        assert got == pytest.approx([want[c] for c in ("count", "mean", "min", "25%", "50%", "75%", "max")])
        if r["count"] > 1:
            assert r["std"] == pytest.approx(want["std"])


def test_impute_and_above_mean(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("a", None), ("b", 5.0)], "g string, v double")
    assert sorted(r.v for r in summary.impute_group_mean(df, "g", "v").collect()) == [1.0, 2.0, 3.0, 5.0]
    assert [r.v for r in summary.above_group_mean(df, "g", "v").collect()] == [3.0]


def test_one_hot_rows_has_no_limit(spark):
    df = spark.range(5000).selectExpr("id", "concat('c', lpad(id, 5, '0')) AS c")
    found = models.one_hot_rows(df, ["id"], "c")
    assert found.count() == 4999
    assert found.where("category = 'c00000'").isEmpty()
