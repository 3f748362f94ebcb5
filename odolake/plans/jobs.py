"""The three recurring jobs over one lake folder: trip layers, reference tables, and models.

Layers and tables are parquet folders below ``lake``. The layer jobs are incremental: each run takes the batches that no
earlier run has taken, and a trip may come in any number of them. The others replace their tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from odolake.functions import clock, responses as fields
from odolake.functions.numbers import half_up
from odolake.operators import clustering, models, trips
from odolake.operators.joining import join_salted
from odolake.plans import costs, fuel, layers
from odolake.session import checkpoint
from odolake.sinks import writers
from odolake.sources import delimited, gpx, responses
from odolake.streaming.ingest import new_batches, new_files, read_batches, refresh

TRIP = ["id_rota", "nome_usuario"]

BRONZE_SCHEMA = (
    "file_name STRING, trk_name STRING, trk_idx INT, seg_idx INT, pt_idx INT, seq BIGINT, latitude DOUBLE, "
    "longitude DOUBLE, elevacao DOUBLE, time_point STRING"
)
SILVER_SCHEMA = (
    "id_rota STRING, nome_usuario STRING, seq BIGINT, latitude DOUBLE, longitude DOUBLE, elevacao DOUBLE, "
    "data DATE, hora STRING"
)
GOLD_SCHEMA = SILVER_SCHEMA + ", cidade STRING, estado STRING, pais STRING, data_carga_banco TIMESTAMP"
PRICE_SCHEMA = (
    "data_inicial DATE, data_final DATE, estado STRING, municipio STRING, produto STRING, "
    "numero_de_postos_pesquisados INT, unidade_de_medida STRING, preco_medio_revenda DOUBLE, "
    "desvio_padrao_revenda DOUBLE, preco_minimo_revenda DOUBLE, preco_maximo_revenda DOUBLE, "
    "coef_de_variacao_revenda DOUBLE"
)
ECONOMY_COLUMNS = [
    "classe",
    "cylinders",
    "displacement",
    "drive",
    "fuel_type",
    "make",
    "model",
    "transmission",
    "year",
    "city_km_l",
    "highway_km_l",
]


PLACE = ["cidade", "estado", "pais"]


def layer(lake: str, name: str) -> str:
    return f"{lake.rstrip('/')}/{name}"


def read_layer(spark: SparkSession, lake: str, name: str) -> DataFrame:
    """All batches of an incremental layer."""
    return read_batches(spark, layer(lake, name))


def read_table(spark: SparkSession, lake: str, name: str) -> DataFrame:
    return spark.read.parquet(layer(lake, f"tables/{name}"))


def bronze_job(spark: SparkSession, landing: str, lake: str, archive: str | None = None) -> None:
    """New GPX files to points; broken files to quarantine."""
    documents = new_files(spark, landing, "xml", gpx.GPX_SCHEMA, archive, rowTag="gpx", mode="PERMISSIVE")
    outputs = {
        layer(lake, "bronze"): lambda batch: gpx.points(gpx.intact(batch)),
        layer(lake, "quarantine"): gpx.quarantine,
    }
    named = documents.withColumn("file_name", F.col("_metadata.file_name"))
    refresh(named, outputs, layer(lake, "progress/bronze"))


def _follow(spark: SparkSession, lake: str, name: str, schema: str, outputs: dict, progress: str) -> None:
    """The new batches of a layer through the functions of ``outputs``."""
    source = layer(lake, name)
    targets = {layer(lake, target): transform for target, transform in outputs.items()}
    refresh(new_batches(spark, source), targets, layer(lake, f"progress/{progress}"), (source, schema))


def silver_job(spark: SparkSession, lake: str) -> None:
    """New points get trip id, vehicle, date and time; points of unreadable file names are kept apart."""

    def clean(batch: DataFrame) -> DataFrame:
        as_csv = F.regexp_replace("file_name", r"\.gpx(\.gz)?$", ".csv")
        return layers.silver_points(batch.withColumn("file_name", as_csv))

    outputs = {
        "silver": lambda batch: clean(batch).where(layers.has_trip_key()),
        "unnamed": lambda batch: clean(batch).where(~layers.has_trip_key()),
    }
    _follow(spark, lake, "bronze", BRONZE_SCHEMA, outputs, "silver")


def gold_job(spark: SparkSession, lake: str, places: DataFrame, key: str, loaded_at: Column | None = None) -> None:
    """New points get city, state and country of the final point of their trip in this batch; see ``located_points``.

    ``places`` has ``key``, ``place_latitude``, ``place_longitude`` and an ``address`` map.
    """

    def locate(batch: DataFrame) -> DataFrame:
        found = layers.trip_locations(batch, TRIP, places, key).select(*TRIP, key)
        return layers.gold_points(batch, found.join(places.select(key, "address"), key, "left"), TRIP, loaded_at)

    _follow(spark, lake, "silver", SILVER_SCHEMA, {"gold": locate}, "gold")


def _timed(points: DataFrame) -> DataFrame:
    return points.withColumn("ts", clock.combine(F.col("data"), F.col("hora")))


def _fold():
    return trips.distance_fold(TRIP, [*PLACE, "data_carga_banco"])


def load_job(spark: SparkSession, lake: str) -> None:
    """New gold points to one state per trip and batch; ``distances`` puts them together."""
    _follow(spark, lake, "gold", GOLD_SCHEMA, {"tables/trip_states": lambda batch: _fold().states(_timed(batch))}, "load")


def trip_states(spark: SparkSession, lake: str) -> DataFrame:
    """One state per trip. Points are read again only for trips whose batches interleave."""
    return trips.whole_states(_fold(), read_layer(spark, lake, "tables/trip_states"), _timed(read_layer(spark, lake, "gold")))


def distances(spark: SparkSession, lake: str) -> DataFrame:
    """Measures, times and place of every trip, in however many batches it came."""
    return trips.trip_table(trips.distance_facts(_fold(), trip_states(spark, lake), [*PLACE, "data_carga_banco"]))


def located_points(spark: SparkSession, lake: str) -> DataFrame:
    """All gold points with the place of their trip's final point, also where a later batch moved that point."""
    states = trip_states(spark, lake)
    place = states.select(*TRIP, *[F.col(f"_last_{c}").alias(c) for c in PLACE])
    return join_salted(read_layer(spark, lake, "gold").drop(*PLACE), place, TRIP, "left")


def trip_job(spark: SparkSession, lake: str, stored: DataFrame) -> None:
    """Tables of trips out of their states: distances, trips of one point, and road distances.

    ``stored`` has the responses of the road service (``id_unico``, ``status``, ``body``). No point is read.
    """
    facts = checkpoint(distances(spark, lake))
    writers.overwrite(trips.measured_trips(facts), layer(lake, "tables/distances"))
    writers.overwrite(trips.trip_rejects(facts).select(*TRIP, "n_points"), layer(lake, "tables/rejects"))

    ends = _fold().facts(trip_states(spark, lake)).select(
        costs.trip_key(F.col("id_rota"), F.col("nome_usuario")).alias("id_unico"),
        "nome_usuario",
        F.to_date("first_ts").alias("data_inicio_rota"),
        F.to_date("last_ts").alias("data_fim_rota"),
        clock.time_text(F.col("first_ts")).alias("inicio_rota"),
        clock.time_text(F.col("last_ts")).alias("fim_rota"),
        F.col("first_latitude").alias("latitude_inicial"),
        F.col("first_longitude").alias("longitude_inicial"),
        F.col("last_latitude").alias("latitude_final"),
        F.col("last_longitude").alias("longitude_final"),
        *[F.col(f"last_{c}").alias(c) for c in PLACE],
    )
    found = responses.route_distances(responses.accepted(stored))
    road = checkpoint(ends.join(found, "id_unico", "left"))
    writers.overwrite(responses.with_route(road), layer(lake, "tables/road"))
    writers.overwrite(responses.route_rejects(road).select("id_unico", "status"), layer(lake, "tables/road_rejects"))


def reference_job(spark: SparkSession, lake: str, sheets: str, stored: DataFrame) -> None:
    """Fuel prices from sheet exports, economy of the vehicles met from stored responses (``marca``, ``modelo``).

    Unreadable lines of the sheets, and the wanted vehicles without an answer, with the reason, go to reject tables.
    """
    lines = delimited.sheet_lines(spark, sheets)
    writers.overwrite(delimited.sheet_rows(lines, PRICE_SCHEMA), layer(lake, "tables/prices"))
    writers.overwrite(delimited.sheet_rejects(lines, PRICE_SCHEMA), layer(lake, "tables/price_rejects"))
    keys = ["marca", "modelo"]
    wanted = checkpoint(fuel.request_keys(read_table(spark, lake, "distances")))
    vehicles = responses.vehicle_rows(wanted, stored, keys).withColumnRenamed("class", "classe")
    writers.overwrite(fuel.economy_in_km_per_litre(vehicles).select(*ECONOMY_COLUMNS), layer(lake, "tables/economy"))
    writers.overwrite(responses.vehicle_rejects(wanted, stored, keys), layer(lake, "tables/economy_rejects"))


def trip_cost(spark: SparkSession, lake: str, state: str) -> DataFrame:
    view = costs.trip_view(read_table(spark, lake, "road"), read_table(spark, lake, "distances"))
    economy = fuel.mean_economy(read_table(spark, lake, "economy"))
    return costs.trip_cost(view, economy, fuel.mean_prices(read_table(spark, lake, "prices"), state))


def model_job(spark: SparkSession, lake: str, state: str, run_id: str, k: int = 3, top: int = 5, all_runs: bool = False) -> None:
    """Cluster the trips of one run, list worst and best vehicles, simulate the swap, fit the litres model.

    The model's mean absolute and mean squared error on the trips held out go to a table of their own.
    """
    cost = trip_cost(spark, lake, state)
    writers.overwrite(cost, layer(lake, "tables/trip_cost"))
    cost = read_table(spark, lake, "trip_cost")
    found = clustering.kmeans_clusters(costs.cluster_input(cost), ["dist_km", "media_consumo_km_l"], k)
    ranked = models.rank_clusters(found, "cluster", "media_consumo_km_l")
    writers.write_snapshot(ranked, layer(lake, "tables/clustered"), run_id)

    clustered = read_table(spark, lake, "clustered").withColumn("run_id", F.col("run_id").cast("string"))
    prices = read_table(spark, lake, "prices")
    mean = fuel.mean_price_like(prices, "%GAS%", state)
    total = lambda rows: costs.vehicle_totals(rows, mean, True)
    if not all_runs:
        clustered = clustered.where(F.col("run_id") == run_id)
    worst = costs.worst_vehicles(total(clustered.where(~F.col("is_best"))), top)
    best = costs.best_vehicles(total(clustered.where(F.col("is_best"))), top)
    swap = costs.swap_simulation(worst, best, fuel.mean_price_like(prices, "%GASOLINA%", state))
    writers.overwrite(swap, layer(lake, "tables/simulation"))

    is_train = models.holdout(F.xxhash64("id_unico"))
    fitted = checkpoint(models.factor_regression(cost.where(is_train), "litros", "dist_km", "nome_usuario"))
    held_out = models.factor_predictions(cost.where(~is_train), fitted, "dist_km", "nome_usuario")
    errors = models.regression_errors(held_out, "litros", "predicted")
    writers.overwrite(writers.with_load_time(errors, name="data_execucao"), layer(lake, f"tables/regression_errors/run_id={run_id}"))
    staging = models.rank_coefficients(fitted).select(
        F.col("variable").alias("variavel"),
        half_up(F.col("coefficient")).alias("coeficiente"),
        half_up(F.col("coefficient_abs")).alias("coeficiente_abs"),
    )
    path = layer(lake, f"tables/regression/run_id={run_id}")
    clean = staging.withColumn("variavel", F.replace("variavel", F.lit("nome_usuario_"), F.lit("")))
    writers.overwrite(writers.with_load_time(clean, name="data_execucao"), path)
