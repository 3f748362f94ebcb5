"""Trip view, trip cost, vehicle rankings and the swap simulation."""

from __future__ import annotations

from pyspark.sql import functions as F

from odolake.operators import clustering, models
from odolake.plans import costs, fuel
from odolake.queries import standins
from odolake.queries.learning import TRIP_FEATURES, sql_kmeans
from odolake.queries.standins import (
    COSTS,
    MEASURED,
    ROAD,
    STATE,
    mean_price,
    measured,
    prices,
    road_trips,
    rounded,
    sql_clock,
    sql_mean,
    sql_round,
)
from odolake.session import checkpoint

def concat_key_join(spark, sf_dir):
    """Inner join on a key put together from two columns."""
    road = road_trips(spark, sf_dir).select("id_unico", "data_inicio_rota")
    metric = measured(spark, sf_dir).select(
        costs.trip_key(F.col("id_rota"), F.col("nome_usuario")).alias("id_unico"), "id_rota", "dist_euclidiana"
    )
    return road.join(metric, "id_unico").select("id_unico", "id_rota", "dist_euclidiana")


def trip_view(spark, sf_dir):
    return costs.trip_view(road_trips(spark, sf_dir), measured(spark, sf_dir))


def trip_cost(spark, sf_dir):
    """The flagship: points to distances, economy and prices to cost per trip, dearest distance first."""
    found = standins.trip_cost(spark, sf_dir).orderBy(F.desc("dist_km"), "id_unico", "tipo_combustivel")
    return rounded(found, ["media_consumo_km_l", "litros", "preco_medio_revenda", "custo_trajeto"])


def distinct_trips(spark, sf_dir):
    """Clustering input: distinct rows of one fuel."""
    return rounded(costs.cluster_input(standins.trip_cost(spark, sf_dir)), ["media_consumo_km_l", "custo_trajeto"])


def clustered(spark, sf_dir):
    """Trips with the labels of a fit, stored once: the rankings and the simulation read them several times."""
    trips = checkpoint(costs.cluster_input(standins.trip_cost(spark, sf_dir)))
    labelled = clustering.fit_kmeans(trips, TRIP_FEATURES).transform(trips, "cluster_consumo")
    return models.rank_clusters(checkpoint(labelled), "cluster_consumo", "media_consumo_km_l")


def kmeans_assign(spark, sf_dir):
    found = clustered(spark, sf_dir).select("nome_usuario", "dist_km", "media_consumo_km_l", "cluster_consumo", "is_best")
    return rounded(found, ["media_consumo_km_l"])


def _price(spark, sf_dir, pattern):
    return fuel.mean_price_like(prices(spark, sf_dir), pattern, STATE)


def _worst_and_best(spark, sf_dir):
    """Totals per vehicle: best vehicles come from the most economical cluster, worst ones from the others."""
    labelled, price = clustered(spark, sf_dir), _price(spark, sf_dir, "%GAS%")
    return (
        costs.vehicle_totals(labelled.where(~F.col("is_best")), price),
        costs.vehicle_totals(labelled.where(F.col("is_best")), price),
    )


def worst_k(spark, sf_dir):
    worst, _ = _worst_and_best(spark, sf_dir)
    return costs.worst_vehicles(worst).orderBy("custo_viagem", "nome_usuario")


def best_k(spark, sf_dir):
    _, best = _worst_and_best(spark, sf_dir)
    return costs.best_vehicles(best).orderBy("custo_viagem", "nome_usuario")


def swap_simulation(spark, sf_dir):
    """Three best vehicles on the routes of the five worst: two ranks stay without a partner."""
    worst, best = _worst_and_best(spark, sf_dir)
    return costs.swap_simulation(
        costs.worst_vehicles(worst), costs.best_vehicles(best, k=3), _price(spark, sf_dir, "%GASOLINA%")
    )


QUERIES = {
    "concat_key_join": concat_key_join,
    "trip_view": trip_view,
    "trip_cost": trip_cost,
    "distinct_trips": distinct_trips,
    "kmeans_assign": kmeans_assign,
    "worst_k": worst_k,
    "best_k": best_k,
    "swap_simulation": swap_simulation,
}

_VIEW_CLOCK = f"nullif(abs(({sql_clock('hora_fim_rota')}) - ({sql_clock('hora_inicio_rota')})), 0)"


CLUSTERED = f"""{COSTS}, grouped AS (
    SELECT DISTINCT nome_usuario, dist_km, media_consumo_km_l, custo_trajeto FROM costs WHERE tipo_combustivel = 'gas'),
{sql_kmeans('grouped', TRIP_FEATURES)},
clustered AS (SELECT * EXCLUDE (cluster), cluster AS cluster_consumo FROM km),
best_cluster AS (
    SELECT cluster_consumo AS c FROM clustered GROUP BY cluster_consumo
    ORDER BY {sql_mean('media_consumo_km_l')} DESC, cluster_consumo LIMIT 1),
labelled AS (SELECT *, cluster_consumo = (SELECT c FROM best_cluster) AS is_best FROM clustered),
totals AS (
    SELECT is_best, nome_usuario, media_consumo_km_l, {sql_round('d', 2)} AS dist_km,
           {sql_round(f"d / media_consumo_km_l * {mean_price('%GAS%')}", 2)} AS custo_viagem
    FROM (SELECT is_best, nome_usuario, media_consumo_km_l,
                 CAST(sum(CAST(dist_km AS DECIMAL(18,6))) AS DOUBLE) AS d
          FROM labelled GROUP BY is_best, nome_usuario, media_consumo_km_l) AS t),
worst AS (
    SELECT nome_usuario, {sql_round('media_consumo_km_l', 2)} AS media_consumo_km_l, dist_km, custo_viagem
    FROM (SELECT * FROM totals WHERE NOT is_best ORDER BY totals.media_consumo_km_l, nome_usuario LIMIT 5) AS w),
best AS (
    SELECT nome_usuario, {sql_round('media_consumo_km_l', 2)} AS media_consumo_km_l, dist_km, custo_viagem
    FROM (SELECT * FROM totals WHERE is_best ORDER BY totals.media_consumo_km_l DESC, nome_usuario LIMIT 5) AS b)"""

ORACLES = {
    "concat_key_join": f"""WITH {ROAD}, {MEASURED}
        SELECT id_unico, id_rota, dist_euclidiana FROM road JOIN measured AS m
        ON concat(CAST(m.id_rota AS VARCHAR), '__', m.nome_usuario) = id_unico""",
    "trip_view": f"""WITH {ROAD}, {MEASURED}
        SELECT road.*, dist_euclidiana, dist_manhattan, dist_minkowski,
               CASE WHEN data_inicio_rota <= data_fim_rota THEN {_VIEW_CLOCK} END AS duracao_viagem
        FROM road JOIN measured AS m ON concat(CAST(m.id_rota AS VARCHAR), '__', m.nome_usuario) = id_unico""",
    "trip_cost": f"""WITH {COSTS}
        SELECT id_unico, nome_usuario, tipo_combustivel, data_rota, inicio_viagem, fim_viagem,
               {sql_round('media_consumo_km_l')} AS media_consumo_km_l, dist_km, {sql_round('litros')} AS litros,
               {sql_round('preco_medio_revenda')} AS preco_medio_revenda,
               {sql_round('custo_trajeto')} AS custo_trajeto
        FROM costs""",
    "distinct_trips": f"""WITH {COSTS}
        SELECT nome_usuario, 1 AS tipo_combustivel, dist_km, {sql_round('media_consumo_km_l')} AS media_consumo_km_l,
               {sql_round('custo_trajeto')} AS custo_trajeto
        FROM (SELECT DISTINCT nome_usuario, dist_km, media_consumo_km_l, custo_trajeto FROM costs
              WHERE tipo_combustivel = 'gas') AS t""",
    "kmeans_assign": f"""WITH RECURSIVE {CLUSTERED}
        SELECT nome_usuario, dist_km, {sql_round('media_consumo_km_l')} AS media_consumo_km_l, cluster_consumo, is_best
        FROM labelled""",
    "worst_k": f"WITH RECURSIVE {CLUSTERED} SELECT * FROM worst",
    "best_k": f"WITH RECURSIVE {CLUSTERED} SELECT * FROM best",
    "swap_simulation": f"""WITH RECURSIVE {CLUSTERED},
        a AS (SELECT *, row_number() OVER (ORDER BY media_consumo_km_l, nome_usuario) AS rank FROM worst),
        b AS (SELECT * FROM (
            SELECT *, row_number() OVER (ORDER BY media_consumo_km_l DESC, nome_usuario) AS rank FROM best) AS r
            WHERE rank <= 3)
        SELECT rank, a.nome_usuario AS nome_usuario_original, a.media_consumo_km_l AS media_consumo_km_original,
               a.dist_km AS dist_km_original, a.custo_viagem AS custo_viagem_original,
               b.nome_usuario AS nome_usuario_simulado, b.media_consumo_km_l AS media_consumo_km_l_simulado,
               {sql_round(f"a.dist_km / b.media_consumo_km_l * {mean_price('%GASOLINA%')}", 2)}
                   AS custo_viagem_simulado
        FROM a FULL OUTER JOIN b USING (rank)""",
}
