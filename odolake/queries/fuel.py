"""Vehicle economy and fuel prices."""

from __future__ import annotations

from pyspark.sql import functions as F

from odolake.plans import fuel
from odolake.queries.standins import (
    MEAN_ECONOMY,
    MEAN_PRICES,
    PRICES,
    STATE,
    economy,
    mean_price,
    prices,
    rounded,
    sql_round,
    table,
    vehicle_of_user,
)


def economy_convert(spark, sf_dir):
    vehicles = table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_size").cast("double").alias("city_mpg"),
        F.col("p_retailprice").alias("highway_mpg"),
        F.col("p_retailprice").alias("combination_mpg"),
    )
    return rounded(fuel.economy_in_km_per_litre(vehicles), ["city_km_l", "highway_km_l"])


def nested_avg(spark, sf_dir):
    return rounded(fuel.mean_economy(economy(spark, sf_dir)), ["media_consumo_km_l"])


def token_price_avg(spark, sf_dir):
    return rounded(fuel.mean_prices(prices(spark, sf_dir), STATE), ["preco_medio_revenda"])


def price_like_avg(spark, sf_dir):
    """Mean price of all products like ``%GAS%`` in one state."""
    return rounded(fuel.mean_price_like(prices(spark, sf_dir), "%GAS%", STATE), ["media"])


def distinct_pairs(spark, sf_dir):
    return fuel.request_keys(vehicle_of_user(spark, sf_dir))


QUERIES = {
    "economy_convert": economy_convert,
    "nested_avg": nested_avg,
    "token_price_avg": token_price_avg,
    "price_like_avg": price_like_avg,
    "distinct_pairs": distinct_pairs,
}

ORACLES = {
    "economy_convert": f"""SELECT p_partkey, {sql_round('p_size * 1.609344e0 / 3.785411784e0')} AS city_km_l,
               {sql_round('p_retailprice * 1.609344e0 / 3.785411784e0')} AS highway_km_l FROM part""",
    "nested_avg": f"""WITH {MEAN_ECONOMY} SELECT marca, modelo, tipo_combustivel,
               {sql_round('media_consumo_km_l')} AS media_consumo_km_l FROM mean_economy""",
    "token_price_avg": f"""WITH {MEAN_PRICES} SELECT estado, produto,
               {sql_round('preco_medio_revenda')} AS preco_medio_revenda FROM mean_prices""",
    "price_like_avg": f"WITH {PRICES} SELECT {sql_round(mean_price('%GAS%'))} AS media",
    "distinct_pairs": """SELECT DISTINCT split_part(lower(replace(p_name, ' ', '_')), '_', 1) AS marca,
               split_part(lower(replace(p_name, ' ', '_')), '_', 2) AS modelo FROM part""",
}
