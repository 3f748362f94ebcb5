"""Fields of stored service responses (JSON text)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ROUTE_SCHEMA = "routes ARRAY<STRUCT<summary: STRUCT<distance: DOUBLE, duration: DOUBLE>>>"
FEATURES_SCHEMA = "elements ARRAY<STRUCT<tags: MAP<STRING, STRING>>>"
ADDRESS_SCHEMA = "MAP<STRING, STRING>"
VEHICLES_SCHEMA = (
    "ARRAY<STRUCT<class: STRING, cylinders: INT, displacement: DOUBLE, drive: STRING, fuel_type: STRING, "
    "make: STRING, model: STRING, transmission: STRING, year: INT, city_mpg: DOUBLE, highway_mpg: DOUBLE, "
    "combination_mpg: DOUBLE>>"
)


def _route_summary(body: Column) -> Column:
    return F.get(F.from_json(body, ROUTE_SCHEMA)["routes"], F.lit(0))["summary"]


def route_km(body: Column) -> Column:
    """Road distance of the first route in km; null if the response has none."""
    return _route_summary(body)["distance"] / F.lit(1000.0)


def route_seconds(body: Column) -> Column:
    return _route_summary(body)["duration"]


def first_filled(address: Column, keys: list[str]) -> Column:
    """Value of the first key that is present and not empty."""
    return F.coalesce(*[F.nullif(F.try_element_at(address, F.lit(key)), F.lit("")) for key in keys])


def address_city(address: Column) -> Column:
    return first_filled(address, ["county", "city", "suburb"])


def address_state(address: Column) -> Column:
    return F.try_element_at(address, F.lit("ISO3166-2-lvl4"))


def address_country(address: Column) -> Column:
    return F.upper(F.try_element_at(address, F.lit("country_code")))
