"""The given tables seen as trip tables, in Spark and as SQL fragments.

Points are ``events`` (a trip is one user on one day, the file order is ``event_id``), vehicles and
prices are ``part``, stored road responses are ``orders``, measured trips are ``lineitem``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from odolake.functions.clock import duration_text
from odolake.functions.numbers import half_up
from odolake.functions.text import VEHICLE_LABELS, assign_label
from odolake.operators.trips import measured_trips, trip_distances, trip_table
from odolake.plans import costs, fuel

TRIP = ["user_id", "trip_date"]
STATE = "RIO DE JANEIRO"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rounded(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: half_up(F.col(c), digits) for c in cols})


def sql_round(expr: str, digits: int = 6) -> str:
    return f"(floor(({expr}) * 1e{digits} + 0.5) / 1e{digits})"


def sql_micro(expr: str) -> str:
    return f"CAST(floor(({expr}) * 1e6 + 0.5) AS BIGINT)"


def sql_mean(expr: str) -> str:
    return f"avg({expr})"


def sql_clock(time: str) -> str:
    return " + ".join(
        f"CAST(split_part({time}, ':', {i}) AS BIGINT) * {unit}" for i, unit in ((1, 3600), (2, 60), (3, 1))
    )


def sql_clock_of(ts: str) -> str:
    return f"(hour({ts}) * 3600 + minute({ts}) * 60 + second({ts}))"


def sql_hms(ts: str) -> str:
    return f"strftime({ts}, '%H:%M:%S')"


def sql_label(key: str) -> str:
    labels = ", ".join(f"'{label}'" for label in VEHICLE_LABELS)
    return f"([{labels}])[CAST(({key}) * 7919 % {len(VEHICLE_LABELS)} AS INTEGER) + 1]"


def sql_haversine(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"sin(radians({lat2} - {lat1}) / 2) * sin(radians({lat2} - {lat1}) / 2) + cos(radians({lat1}))"
        f" * cos(radians({lat2})) * sin(radians({lon2} - {lon1}) / 2) * sin(radians({lon2} - {lon1}) / 2)"
    )
    return f"2 * 6371e0 * asin(sqrt(least({a}, 1e0)))"


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "user_id",
        F.to_date("ts").alias("trip_date"),
        F.col("event_id").alias("seq"),
        "ts",
        (F.col("value") % F.lit(90.0)).alias("latitude"),
        F.get_json_object("props", "$.k").cast("double").alias("longitude"),
        F.col("value").alias("elevacao"),
    )


POINTS = """points AS (
    SELECT user_id, CAST(ts AS DATE) AS trip_date, event_id AS seq, ts, value % CAST(90 AS DOUBLE) AS latitude,
           CAST(props->>'$.k' AS DOUBLE) AS longitude, value AS elevacao
    FROM events)"""

_DX, _DY = "(longitude - plon)", "(latitude - plat)"
EUCLID = f"sqrt({_DX} * {_DX} + {_DY} * {_DY}) * 1e3"
MANHATTAN = f"(abs({_DX}) + abs({_DY})) * 1e3"
MINKOWSKI = f"pow(pow(abs({_DX}), 3e0) + pow(abs({_DY}), 3e0), CAST(1 AS DOUBLE) / 3) * 1e3"

DISTANCES = f"""{POINTS}, pairs AS (
    SELECT *, lag(latitude) OVER w AS plat, lag(longitude) OVER w AS plon, lag(elevacao) OVER w AS pele,
           row_number() OVER w AS rn
    FROM points WINDOW w AS (PARTITION BY user_id, trip_date ORDER BY seq)),
distances AS (
    SELECT user_id, trip_date, count(*) AS n_points,
           count(CASE WHEN plat IS NOT NULL AND plon IS NOT NULL THEN 1 END) AS n_segments,
           CAST(coalesce(sum({sql_micro(EUCLID)}), 0) AS DOUBLE) / 1e6 AS dist_euclidiana,
           CAST(coalesce(sum({sql_micro(MANHATTAN)}), 0) AS DOUBLE) / 1e6 AS dist_manhattan,
           CAST(coalesce(sum({sql_micro(MINKOWSKI)}), 0) AS DOUBLE) / 1e6 AS dist_minkowski,
           arg_min(ts, seq) AS start_first_point, max(CASE WHEN rn = 2 THEN ts END) AS start_second_point,
           arg_max(ts, seq) AS end_point
    FROM pairs GROUP BY user_id, trip_date)"""


def distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trip_distances(points(spark, sf_dir), TRIP)


# --- vehicles, economy and prices out of part -------------------------------------------------


def economy(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("p_type")
    return table(spark, sf_dir, "part").select(
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("make"),
        F.concat_ws(" ", F.split_part("p_name", F.lit(" "), F.lit(2)), "p_brand").alias("model"),
        F.when(kind.isin("ECONOMY", "STANDARD"), "gas").otherwise(F.lower(kind)).alias("fuel_type"),
        F.col("p_size").cast("double").alias("city_km_l"),
        (F.col("p_retailprice") / F.lit(100.0)).alias("highway_km_l"),
    )


ECONOMY = """economy AS (
    SELECT split_part(p_name, ' ', 1) AS make, concat_ws(' ', split_part(p_name, ' ', 2), p_brand) AS model,
           CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'gas' ELSE lower(p_type) END AS fuel_type,
           CAST(p_size AS DOUBLE) AS city_km_l, p_retailprice / 1e2 AS highway_km_l
    FROM part)"""

MEAN_ECONOMY = f"""{ECONOMY}, model_means AS (
    SELECT make, model, fuel_type, avg((city_km_l + highway_km_l) / 2) AS per_model FROM economy GROUP BY ALL),
mean_economy AS (
    SELECT make AS marca, split_part(model, ' ', 1) AS modelo, fuel_type AS tipo_combustivel,
           avg(DISTINCT per_model) AS media_consumo_km_l
    FROM model_means GROUP BY ALL)"""

_PRODUCTS = {
    "ECONOMY": "GASOLINA COMUM",
    "STANDARD": "GASOLINA ADITIVADA",
    "PROMO": "ETANOL HIDRATADO",
    "SMALL": "OLEO DIESEL",
    "MEDIUM": "GLP",
}


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    product = F.lit("GNV")
    for kind, name in _PRODUCTS.items():
        product = F.when(F.col("p_type") == kind, name).otherwise(product)
    state = F.when(F.col("p_size") % 3 == 0, STATE).when(F.col("p_size") % 3 == 1, "SAO PAULO").otherwise("BAHIA")
    return table(spark, sf_dir, "part").select(
        state.alias("estado"),
        product.alias("produto"),
        (F.col("p_retailprice") / F.lit(100.0)).alias("preco_medio_revenda"),
    )


_CASES = " ".join(f"WHEN '{kind}' THEN '{name}'" for kind, name in _PRODUCTS.items())
PRICES = f"""prices AS (
    SELECT CASE p_size % 3 WHEN 0 THEN '{STATE}' WHEN 1 THEN 'SAO PAULO' ELSE 'BAHIA' END AS estado,
           CASE p_type {_CASES} ELSE 'GNV' END AS produto, p_retailprice / 1e2 AS preco_medio_revenda
    FROM part)"""

MEAN_PRICES = f"""{PRICES}, state_words AS (
    SELECT split_part(produto, ' ', 1) AS word, preco_medio_revenda FROM prices WHERE estado = '{STATE}'),
mean_prices AS (
    SELECT '{STATE}' AS estado, coalesce(nullif(word, 'GASOLINA'), 'gas') AS produto,
           avg(preco_medio_revenda) AS preco_medio_revenda
    FROM state_words GROUP BY word)"""


def mean_price(pattern: str) -> str:
    return (
        "(SELECT avg(preco_medio_revenda) FROM prices"
        f" WHERE estado = '{STATE}' AND produto LIKE '{pattern}')"
    )


# --- trip cost --------------------------------------------------------------------------------


def vehicle_of_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle label of a user, like ``SMALL_RING``: the part with the user's number."""
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("user_id"), F.upper(F.replace("p_name", F.lit(" "), F.lit("_"))).alias("nome_usuario")
    )


def trip_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = trip_table(measured_trips(distances(spark, sf_dir)))
    view = trips.join(vehicle_of_user(spark, sf_dir), "user_id").select(
        costs.trip_key(F.col("user_id"), F.col("trip_date").cast("string")).alias("id_unico"),
        "nome_usuario",
        F.col("data_viagem").alias("data_inicio_rota"),
        F.col("hora_inicio").alias("hora_inicio_rota"),
        F.col("hora_fim").alias("hora_fim_rota"),
        "dist_euclidiana",
    )
    return costs.trip_cost(
        view, fuel.mean_economy(economy(spark, sf_dir)), fuel.mean_prices(prices(spark, sf_dir), STATE)
    )


COSTS = f"""{DISTANCES}, {MEAN_ECONOMY}, {MEAN_PRICES}, priced_vehicles AS (
    SELECT mean_economy.*, preco_medio_revenda FROM mean_economy LEFT JOIN mean_prices ON produto = tipo_combustivel),
drives AS (
    SELECT DISTINCT user_id || '__' || trip_date AS id_unico, upper(replace(p_name, ' ', '_')) AS nome_usuario,
           lower(split_part(p_name, ' ', 1)) AS marca, lower(split_part(p_name, ' ', 2)) AS modelo,
           start_first_point, end_point, dist_euclidiana AS dist_km
    FROM distances JOIN part ON p_partkey = user_id WHERE n_segments > 0),
costs AS (
    SELECT id_unico, nome_usuario, tipo_combustivel, CAST(start_first_point AS DATE) AS data_rota,
           {sql_hms('start_first_point')} AS inicio_viagem, {sql_hms('end_point')} AS fim_viagem, media_consumo_km_l,
           dist_km, dist_km / media_consumo_km_l AS litros, preco_medio_revenda,
           dist_km / media_consumo_km_l * preco_medio_revenda AS custo_trajeto
    FROM drives JOIN priced_vehicles USING (marca, modelo))"""


# --- road responses out of orders, measured trips out of lineitem -----------------------------


def road_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text table as the road-distance step stores it, with ``'nan'`` for missing values."""
    key = F.col("o_orderkey")
    label = assign_label(key)
    missing = lambda every, value: F.when(key % every == 0, "nan").otherwise(value)
    start, end = F.to_date("o_orderdate"), F.date_add(F.to_date("o_orderdate"), (key % 5 - 1).cast("int"))
    end_clock = F.when(key % 17 == 0, key * 7919 % 86400).otherwise(key * 104729 % 86400)
    return table(spark, sf_dir, "orders").select(
        costs.trip_key(key, label).alias("id_unico"),
        label.alias("nome_usuario"),
        missing(11, start.cast("string")).alias("data_inicio_rota"),
        missing(19, end.cast("string")).alias("data_fim_rota"),
        missing(23, duration_text(key * 7919 % 86400)).alias("inicio_rota"),
        duration_text(end_clock).alias("fim_rota"),
        missing(13, (F.col("o_totalprice") / F.lit(1000.0)).cast("string")).alias("distancia_real_km_api"),
    )


def _sql_hms_of(seconds: str) -> str:
    return f"printf('%02d:%02d:%02d', ({seconds}) // 3600, ({seconds}) % 3600 // 60, ({seconds}) % 60)"


ROAD = f"""road AS (
    SELECT concat(CAST(o_orderkey AS VARCHAR), '__', {sql_label('o_orderkey')}) AS id_unico,
           {sql_label('o_orderkey')} AS nome_usuario,
           CASE WHEN o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS data_inicio_rota,
           CASE WHEN o_orderkey % 19 <> 0
                THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 5 - 1 AS INTEGER) END AS data_fim_rota,
           CASE WHEN o_orderkey % 23 <> 0 THEN {_sql_hms_of('o_orderkey * 7919 % 86400')} END AS hora_inicio_rota,
           CASE WHEN o_orderkey % 17 = 0 THEN {_sql_hms_of('o_orderkey * 7919 % 86400')}
                ELSE {_sql_hms_of('o_orderkey * 104729 % 86400')} END AS hora_fim_rota,
           CASE WHEN o_orderkey % 13 <> 0 THEN o_totalprice / 1e3 END AS distancia_real_km_api
    FROM orders)"""


def measured(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = lambda c: F.sum(F.col(c).cast("decimal(18,2)")).cast("double")
    by_order = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(
        total("l_quantity").alias("dist_euclidiana"),
        total("l_extendedprice").alias("dist_manhattan"),
        F.max("l_quantity").alias("dist_minkowski"),
    )
    return by_order.select(
        F.col("l_orderkey").alias("id_rota"),
        assign_label(F.col("l_orderkey")).alias("nome_usuario"),
        "dist_euclidiana",
        "dist_manhattan",
        "dist_minkowski",
    )


MEASURED = f"""measured AS (
    SELECT l_orderkey AS id_rota, {sql_label('l_orderkey')} AS nome_usuario,
           CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS dist_euclidiana,
           CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS dist_manhattan,
           max(l_quantity) AS dist_minkowski
    FROM lineitem GROUP BY l_orderkey)"""
