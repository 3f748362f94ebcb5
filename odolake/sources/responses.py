"""Stored service responses: a table of request key, HTTP ``status`` and ``body`` text."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from odolake.functions import responses

OK = 200


def accepted(stored: DataFrame) -> DataFrame:
    return stored.where(F.col("status") == OK)


def refused(stored: DataFrame) -> DataFrame:
    """Responses with another status, for the report."""
    return stored.where(~F.col("status").eqNullSafe(F.lit(OK)))


def route_distances(stored: DataFrame) -> DataFrame:
    """Road distance and duration per request; both null if the response carries no route."""
    return stored.withColumns(
        {
            "distancia_real_km_api": responses.route_km(F.col("body")),
            "duracao_s": responses.route_seconds(F.col("body")),
        }
    ).drop("body")


def with_route(distances: DataFrame) -> DataFrame:
    return distances.where(F.col("distancia_real_km_api").isNotNull())


def route_rejects(distances: DataFrame) -> DataFrame:
    return distances.where(F.col("distancia_real_km_api").isNull())


def vehicle_rows(keys: DataFrame, stored: DataFrame, on: list[str]) -> DataFrame:
    """One row per vehicle in the JSON arrays stored for the wanted keys."""
    found = keys.join(accepted(stored), on, "left")
    return found.select(*on, F.inline(F.from_json("body", responses.VEHICLES_SCHEMA)))


def vehicle_rejects(keys: DataFrame, stored: DataFrame, on: list[str]) -> DataFrame:
    """The wanted keys without vehicles, with the reason: no response, its status, or unreadable text."""
    answers = stored.withColumn("_answered", F.lit(True))
    rows = F.from_json("body", responses.VEHICLES_SCHEMA)
    # A text that is no array of objects parses to null or to rows without a single field.
    readable = rows.isNotNull() & F.exists(rows, lambda r: ~r.eqNullSafe(F.lit(None)) & (F.to_json(r) != "{}"))
    empty = F.trim(F.col("body")).rlike(r"^\[\s*\]$")
    reason = (
        F.when(F.col("_answered").isNull(), "missing")
        .when(~F.col("status").eqNullSafe(F.lit(OK)), F.concat(F.lit("status "), F.coalesce(F.col("status").cast("string"), F.lit("none"))))
        .when(F.coalesce(~(readable | empty), F.lit(True)), "unreadable")
    )
    found = keys.join(answers, on, "left").withColumn("reason", reason)
    return found.where(F.col("reason").isNotNull()).select(*on, "reason")


def feature_names(stored: DataFrame, keep: list[str]) -> DataFrame:
    """Name of every map feature with tags, ``Unnamed`` where the tags have none, with its position."""
    features = F.from_json("body", responses.FEATURES_SCHEMA)["elements"]
    return (
        stored.select(*keep, F.posexplode(features).alias("pos", "_e"))
        .where(F.col("_e.tags").isNotNull())
        .select(*keep, "pos", F.coalesce(F.try_element_at("_e.tags", F.lit("name")), F.lit("Unnamed")).alias("name"))
    )


def first_seen_names(names: DataFrame, order: list[str]) -> DataFrame:
    """Each name once, with the place where it was first seen."""
    return names.groupBy("name").agg(F.min(F.struct(*order)).alias("_at")).select("name", "_at.*")
