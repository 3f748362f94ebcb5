"""Vehicle economy and fuel prices."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from odolake.functions.numbers import exact_mean, mpg_to_km_per_litre
from odolake.functions.text import first_word, vehicle_make, vehicle_model

# How price products map to fuel types of the economy table.
PRODUCT_TO_FUEL = {"GASOLINA": "gas"}


def economy_in_km_per_litre(vehicles: DataFrame) -> DataFrame:
    """Replace the miles-per-gallon columns by km per litre."""
    return vehicles.withColumns(
        {
            "city_km_l": mpg_to_km_per_litre(F.col("city_mpg")),
            "highway_km_l": mpg_to_km_per_litre(F.col("highway_mpg")),
        }
    ).drop("city_mpg", "highway_mpg", "combination_mpg")


def mean_economy(economy: DataFrame) -> DataFrame:
    """Mean km/l per make, first word of the model and fuel: a mean over the models' distinct means."""
    middle = (F.col("city_km_l") + F.col("highway_km_l")) / 2
    per_model = economy.groupBy("make", "model", "fuel_type").agg(exact_mean(middle).alias("_mean"))
    distinct = per_model.select(
        F.col("make").alias("marca"),
        first_word(F.col("model")).alias("modelo"),
        F.col("fuel_type").alias("tipo_combustivel"),
        "_mean",
    ).distinct()
    return distinct.groupBy("marca", "modelo", "tipo_combustivel").agg(
        exact_mean(F.col("_mean")).alias("media_consumo_km_l")
    )


def mean_prices(prices: DataFrame, state: str, product_to_fuel: dict[str, str] = PRODUCT_TO_FUEL) -> DataFrame:
    """Mean price in one state by the first word of the product, named like the fuel types."""
    word = first_word(F.col("produto"))
    by_word = (
        prices.where(F.col("estado") == state)
        .groupBy("estado", word.alias("_word"))
        .agg(exact_mean(F.col("preco_medio_revenda")).alias("preco_medio_revenda"))
    )
    fuel = F.col("_word")
    for product, name in product_to_fuel.items():
        fuel = F.when(F.col("_word") == product, name).otherwise(fuel)
    return by_word.select("estado", fuel.alias("produto"), "preco_medio_revenda")


def mean_price_like(prices: DataFrame, pattern: str, state: str | None = None) -> DataFrame:
    """One mean price over all products that match a LIKE pattern, optionally in one state."""
    rows = prices.where(F.col("produto").like(pattern))
    if state is not None:
        rows = rows.where(F.col("estado") == state)
    return rows.agg(exact_mean(F.col("preco_medio_revenda")).alias("media"))


def request_keys(trips: DataFrame) -> DataFrame:
    """The distinct (make, model) pairs to ask the vehicle service for."""
    label = F.col("nome_usuario")
    return trips.select(vehicle_make(label).alias("marca"), vehicle_model(label).alias("modelo")).distinct()
