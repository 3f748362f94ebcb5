"""Bronze, silver and gold point tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from odolake.functions import clock, responses, text
from odolake.operators.nearest import nearest_place

SILVER_COLUMNS = ["id_rota", "nome_usuario", "seq", "latitude", "longitude", "elevacao", "data", "hora"]


def silver_points(bronze: DataFrame, file_name: str = "file_name") -> DataFrame:
    """Split the time, read trip id and user from the file name, fix the column order."""
    ts = clock.parse_point_time(F.col("time_point"))
    return bronze.withColumns(
        {
            "data": clock.date_part(ts),
            "hora": clock.time_text(ts),
            "id_rota": text.trip_id(F.col(file_name)),
            "nome_usuario": text.trip_user(F.col(file_name)),
        }
    ).select(*SILVER_COLUMNS)


def has_trip_key() -> Column:
    """False for points of files with an unreadable name; those belong in quarantine."""
    return F.col("id_rota").isNotNull() & F.col("nome_usuario").isNotNull()


def trip_locations(points: DataFrame, trip: list[str], places: DataFrame, key: str, **grid) -> DataFrame:
    """One place lookup per trip, on its final point."""
    last = points.groupBy(*trip).agg(
        F.max_by("latitude", "seq").alias("latitude"), F.max_by("longitude", "seq").alias("longitude")
    )
    return nearest_place(last, places, key, **grid)


def gold_points(silver: DataFrame, locations: DataFrame, trip: list[str], loaded_at: Column | None = None) -> DataFrame:
    """Every point gets city, state and country of its trip, and the load time.

    ``locations`` has one row per trip with an ``address`` map.
    """
    address = F.col("address")
    place = locations.select(
        *trip,
        responses.address_city(address).alias("cidade"),
        responses.address_state(address).alias("estado"),
        responses.address_country(address).alias("pais"),
    )
    loaded = loaded_at if loaded_at is not None else F.current_timestamp()
    return silver.join(place, trip, "left").withColumn("data_carga_banco", loaded)


def input_report(inputs: dict[str, DataFrame]) -> DataFrame:
    """One row per named input with its number of rows, also for inputs without any."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("input"), "n_rows", (F.col("n_rows") == 0).alias("is_empty"))
        for name, df in inputs.items()
    ]
    return reduce(DataFrame.unionAll, counted)
