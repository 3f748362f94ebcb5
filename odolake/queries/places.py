"""Nearest place of each trip's final point, and the gold layer built on it."""

from __future__ import annotations

from pyspark.sql import functions as F

from odolake.plans import layers
from odolake.queries.standins import POINTS, TRIP, points, table


def _places(spark, sf_dir):
    """Suppliers as places: two of their numbers serve as coordinates."""
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey",
        (F.col("s_acctbal") % F.lit(90.0)).alias("place_latitude"),
        (F.col("s_suppkey") * 37 % 100).cast("double").alias("place_longitude"),
    )


def trip_location(spark, sf_dir):
    return layers.trip_locations(points(spark, sf_dir), TRIP, _places(spark, sf_dir), "s_suppkey")


def gold_points(spark, sf_dir):
    """Every point with the place of its trip's final point."""
    found = trip_location(spark, sf_dir).drop("latitude", "longitude")
    entry = lambda name, value: F.struct(F.lit(name).alias("key"), value.alias("value"))
    address = F.map_from_entries(
        F.array(
            entry("city", F.col("s_name")),
            entry("ISO3166-2-lvl4", F.concat(F.lit("BR-"), F.col("s_nationkey"))),
            entry("country_code", F.lit("br")),
        )
    )
    addresses = table(spark, sf_dir, "supplier").select("s_suppkey", address.alias("address"))
    locations = found.join(addresses, "s_suppkey").drop("s_suppkey")
    loaded_at = F.lit("2024-03-29 10:00:00").cast("timestamp_ntz")
    return layers.gold_points(points(spark, sf_dir), locations, TRIP, loaded_at).drop("ts", "elevacao")


QUERIES = {"trip_location": trip_location, "gold_points": gold_points}

_LOCATED = f"""{POINTS}, final AS (
    SELECT user_id, trip_date, arg_max(latitude, seq) AS latitude, arg_max(longitude, seq) AS longitude
    FROM points GROUP BY user_id, trip_date),
places AS (
    SELECT s_suppkey, s_acctbal % CAST(90 AS DOUBLE) AS place_latitude,
           CAST(s_suppkey * 37 % 100 AS DOUBLE) AS place_longitude FROM supplier),
spots AS (SELECT DISTINCT latitude, longitude FROM final),
near AS (
    SELECT latitude, longitude,
           min({{'d': asin(sqrt(least(1.0, pow(sin(radians(place_latitude - latitude) / 2), 2)
                          + cos(radians(latitude)) * cos(radians(place_latitude))
                          * pow(sin(radians(place_longitude - longitude) / 2), 2)))), 'k': s_suppkey}}) AS best
    FROM spots, places GROUP BY latitude, longitude),
located AS (
    SELECT user_id, trip_date, latitude, longitude, best.k AS s_suppkey FROM final JOIN near USING (latitude, longitude))"""

ORACLES = {
    "trip_location": f"WITH {_LOCATED} SELECT * FROM located",
    "gold_points": f"""WITH {_LOCATED}
        SELECT p.user_id, p.trip_date, seq, p.latitude, p.longitude, s_name AS cidade,
               'BR-' || CAST(s_nationkey AS VARCHAR) AS estado, 'BR' AS pais,
               TIMESTAMP '2024-03-29 10:00:00' AS data_carga_banco
        FROM points AS p JOIN located AS l ON p.user_id = l.user_id AND p.trip_date = l.trip_date
        JOIN supplier AS s ON s.s_suppkey = l.s_suppkey""",
}
