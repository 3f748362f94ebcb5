"""Trip view, trip cost, worst and best vehicles, and the swap simulation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from odolake.functions import clock
from odolake.functions.numbers import half_up, null_if_nan_text
from odolake.functions.text import vehicle_make, vehicle_model
from odolake.operators.joining import every_salt, salted
from odolake.operators.ranking import pair_by_rank, top_k


def trip_key(trip_id: Column, user: Column) -> Column:
    return F.concat(trip_id.cast("string"), F.lit("__"), user)


def trip_view(road: DataFrame, measured: DataFrame) -> DataFrame:
    """Road distances joined with the metric distances of the same trip.

    ``road`` keeps dates, times and numbers as text with ``'nan'``; they are typed here.
    """
    api = road.select(
        "id_unico",
        "nome_usuario",
        null_if_nan_text(F.col("data_inicio_rota"), "date").alias("data_inicio_rota"),
        null_if_nan_text(F.col("data_fim_rota"), "date").alias("data_fim_rota"),
        F.nullif(F.col("inicio_rota"), F.lit("nan")).alias("hora_inicio_rota"),
        F.nullif(F.col("fim_rota"), F.lit("nan")).alias("hora_fim_rota"),
        null_if_nan_text(F.col("distancia_real_km_api"), "double").alias("distancia_real_km_api"),
    )
    metric = measured.select(
        trip_key(F.col("id_rota"), F.col("nome_usuario")).alias("id_unico"),
        "dist_euclidiana",
        "dist_manhattan",
        "dist_minkowski",
    )
    return api.join(metric, "id_unico").withColumn(
        "duracao_viagem",
        clock.view_seconds(
            F.col("data_inicio_rota"), F.col("data_fim_rota"), F.col("hora_inicio_rota"), F.col("hora_fim_rota")
        ),
    )


def trip_cost(view: DataFrame, economy: DataFrame, prices: DataFrame) -> DataFrame:
    """Litres and cost per trip. ``economy`` and ``prices`` come from ``mean_economy``/``mean_prices``.

    Trips without economy drop out; trips without a price keep null price and cost. Economy and prices are small against
    the trips and joined first, so trips are joined once, by vehicle and salt, as most trips may be of a few vehicles.
    Repeated trip rows hash alike, meet in the same task of that join, and are removed there without a shuffle of their own.
    """
    trips = view.where(F.col("data_inicio_rota").isNotNull()).select(
        "id_unico",
        "nome_usuario",
        F.col("data_inicio_rota").alias("data_rota"),
        F.col("hora_inicio_rota").alias("inicio_viagem"),
        F.col("hora_fim_rota").alias("fim_viagem"),
        F.col("dist_euclidiana").alias("dist_km"),
        vehicle_make(F.col("nome_usuario")).alias("marca"),
        vehicle_model(F.col("nome_usuario")).alias("modelo"),
    )
    known = economy.where(F.col("media_consumo_km_l").isNotNull())
    price = prices.select(F.col("produto").alias("tipo_combustivel"), "preco_medio_revenda")
    priced = known.join(price, "tipo_combustivel", "left")
    keys = ["marca", "modelo", "_salt"]
    trips = salted(trips).repartition(*keys).distinct()
    return (
        trips.join(every_salt(priced), keys)
        .withColumn("litros", F.try_divide(F.col("dist_km"), F.col("media_consumo_km_l")))
        .withColumn("custo_trajeto", F.col("litros") * F.col("preco_medio_revenda"))
        .select(
            "id_unico",
            "nome_usuario",
            "tipo_combustivel",
            "data_rota",
            "inicio_viagem",
            "fim_viagem",
            "media_consumo_km_l",
            "dist_km",
            "litros",
            "preco_medio_revenda",
            "custo_trajeto",
        )
    )


def cluster_input(costs: DataFrame, fuel: str = "gas") -> DataFrame:
    """Distinct rows for clustering, one fuel only."""
    return (
        costs.where(F.col("tipo_combustivel") == fuel)
        .select("nome_usuario", F.lit(1).alias("tipo_combustivel"), "dist_km", "media_consumo_km_l", "custo_trajeto")
        .dropDuplicates()
    )


def vehicle_totals(clustered: DataFrame, price: DataFrame, all_runs: bool = True, run: str | None = None) -> DataFrame:
    """Distance and cost per vehicle. ``price`` is a one-row table, read as a scalar subquery.

    With ``all_runs=False`` only the latest value of the column ``run`` counts.
    """
    if not all_runs:
        clustered = clustered.where(F.col(run) == clustered.agg(F.max(run)).scalar())
    totals = clustered.groupBy("nome_usuario", "media_consumo_km_l").agg(
        F.sum(F.col("dist_km").cast("decimal(18,6)")).cast("double").alias("_dist")
    )
    cost = F.try_divide(F.col("_dist"), F.col("media_consumo_km_l")) * price.scalar()
    return totals.select(
        "nome_usuario",
        "media_consumo_km_l",
        half_up(F.col("_dist"), 2).alias("dist_km"),
        half_up(cost, 2).alias("custo_viagem"),
    )


def _listed(totals: DataFrame, order: Column, k: int) -> DataFrame:
    chosen = top_k(totals, [order, F.col("nome_usuario")], k)
    return chosen.withColumn("media_consumo_km_l", half_up(F.col("media_consumo_km_l"), 2))


def worst_vehicles(totals: DataFrame, k: int = 5) -> DataFrame:
    return _listed(totals, F.col("media_consumo_km_l").asc(), k)


def best_vehicles(totals: DataFrame, k: int = 5) -> DataFrame:
    return _listed(totals, F.col("media_consumo_km_l").desc(), k)


def swap_simulation(worst: DataFrame, best: DataFrame, price: DataFrame) -> DataFrame:
    """The n-th best vehicle drives the routes of the n-th worst; lists may differ in length."""
    a = worst.select(
        F.col("nome_usuario").alias("nome_usuario_original"),
        F.col("media_consumo_km_l").alias("media_consumo_km_original"),
        F.col("dist_km").alias("dist_km_original"),
        F.col("custo_viagem").alias("custo_viagem_original"),
    )
    b = best.select(
        F.col("nome_usuario").alias("nome_usuario_simulado"),
        F.col("media_consumo_km_l").alias("media_consumo_km_l_simulado"),
    )
    pairs = pair_by_rank(
        a,
        b,
        [F.col("media_consumo_km_original").asc(), F.col("nome_usuario_original")],
        [F.col("media_consumo_km_l_simulado").desc(), F.col("nome_usuario_simulado")],
    )
    simulated = F.try_divide(F.col("dist_km_original"), F.col("media_consumo_km_l_simulado")) * price.scalar()
    return pairs.withColumn("custo_viagem_simulado", half_up(simulated, 2))
