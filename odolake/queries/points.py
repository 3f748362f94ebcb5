"""Trip measures, times and durations."""

from __future__ import annotations

from pyspark.sql import functions as F

from odolake.functions import clock
from odolake.operators import trips
from odolake.plans import layers
from odolake.queries.standins import (
    DISTANCES,
    POINTS,
    TRIP,
    distances,
    points,
    rounded,
    sql_clock_of,
    sql_haversine,
    sql_hms,
    sql_micro,
    sql_round,
    table,
)

_ENDS = f"""{POINTS}, ends AS (
    SELECT user_id, trip_date,
           arg_min(latitude, seq) AS first_latitude, arg_min(longitude, seq) AS first_longitude,
           arg_min(ts, seq) AS first_ts, arg_max(latitude, seq) AS last_latitude,
           arg_max(longitude, seq) AS last_longitude, arg_max(ts, seq) AS last_ts
    FROM points GROUP BY user_id, trip_date)"""


def trip_distance(spark, sf_dir):
    return trips.trip_table(trips.measured_trips(distances(spark, sf_dir))).drop("data_viagem")


def trip_rejects(spark, sf_dir):
    return trips.trip_rejects(distances(spark, sf_dir)).select(*TRIP, "n_points", "n_segments")


def empty_input(spark, sf_dir):
    """A layer without files for this run: the plan runs through and gives no rows."""
    none = points(spark, sf_dir).where(F.col("seq") < 0)
    return trips.measured_trips(trips.trip_distances(none, TRIP)).select(*TRIP, "n_points", "dist_euclidiana")


def trip_endpoints(spark, sf_dir):
    return trips.trip_endpoints(points(spark, sf_dir), TRIP)


def endpoint_distance(spark, sf_dir):
    ends = trips.trip_endpoints(points(spark, sf_dir), TRIP, ["latitude", "longitude"])
    orders = {"dist_euclidiana": 2, "dist_manhattan": 1, "dist_minkowski": 3}
    return rounded(trips.endpoint_distances(ends, orders), list(orders)).select(*TRIP, *orders)


_E = {c: sql_round(c, 10) for c in ("first_latitude", "first_longitude", "last_latitude", "last_longitude")}
_EX = f"({_E['last_longitude']} - {_E['first_longitude']})"
_EY = f"({_E['last_latitude']} - {_E['first_latitude']})"


def haversine_km(spark, sf_dir):
    ends = trips.trip_endpoints(points(spark, sf_dir), TRIP, ["latitude", "longitude"])
    return rounded(trips.endpoint_geodesic_km(ends), ["dist_linear_km"], 4).select(*TRIP, "dist_linear_km")


def _segmented(spark, sf_dir):
    """Points of half a day are a track, of a quarter a segment."""
    return points(spark, sf_dir).withColumns({"trk": F.floor(F.hour("ts") / 12), "seg": F.floor(F.hour("ts") / 6)})


def elevation_profile(spark, sf_dir):
    return trips.elevation_profile(_segmented(spark, sf_dir), TRIP, ["trk", "seg"])


def elevation_smoothed(spark, sf_dir):
    """Climb and descent of smoothed elevations, in small chunks, so that many segments have chunk borders."""
    found = trips.elevation_profile(_segmented(spark, sf_dir), TRIP, ["trk", "seg"], smooth=True, chunk=512)
    return found.select(*TRIP, "n_points", "uphill", "downhill")


def input_report(spark, sf_dir):
    """Rows per input of a run; an input without rows is reported, not left out."""
    found = points(spark, sf_dir)
    return layers.input_report({"points": found, "late": found.where(F.col("seq") < 0)})


def first_last_window(spark, sf_dir):
    """First and last value of every trip with its clock duration, one row per trip."""
    ends = trips.trip_endpoints(points(spark, sf_dir), TRIP)
    timed = ends.withColumns(
        {"inicio_rota": clock.time_text(F.col("first_ts")), "fim_rota": clock.time_text(F.col("last_ts"))}
    )
    return timed.withColumn(
        "tempo_viagem", clock.clock_nonzero_seconds(F.col("inicio_rota"), F.col("fim_rota"))
    ).drop("first_ts", "last_ts")


def loaded_on(spark, sf_dir):
    loaded = points(spark, sf_dir).withColumn("data_carga_banco", F.col("ts"))
    report = trips.loaded_trips(loaded, TRIP, F.to_date(F.lit("2024-01-15")))
    return rounded(report, ["dist_linear_km", "dist_manhattan"], 4).select(
        F.concat_ws("__", "user_id", "data_rota", "inicio_rota").alias("id_unico"),
        "data_rota",
        "inicio_rota",
        "fim_rota",
        "tempo_viagem",
        "dist_linear_km",
        "dist_manhattan",
    ).orderBy("id_unico", "data_rota", F.desc("dist_manhattan"))


def datetime_split(spark, sf_dir):
    """Times as text with a zone, some unreadable: lenient parse, strict parse, date, time, combined."""
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("+00:00"))
    text = F.when(F.col("event_id") % 7 == 0, "not a date").otherwise(stamp)
    plain = F.when(F.col("event_id") % 5 == 0, stamp).otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    parsed = table(spark, sf_dir, "events").select(
        "event_id", clock.parse_point_time(text).alias("time_point"), clock.parse_strict(plain).alias("strict")
    )
    return parsed.withColumns(
        {"data": clock.date_part(F.col("time_point")), "hora": clock.time_text(F.col("time_point"))}
    ).withColumn("combined", clock.combine(F.col("data"), F.col("hora")))


def clock_duration(spark, sf_dir):
    """The three duration rules and the true elapsed time, over spans that also end before they start."""
    shift = F.col("event_id") * 7919 % 200000 - 50000
    shift = F.when(F.col("event_id") % 9 == 0, 0).otherwise(shift)
    spans = table(spark, sf_dir, "events").select(
        "event_id",
        F.date_trunc("second", "ts").cast("timestamp_ntz").alias("a"),
        F.timestamp_add("SECOND", shift, F.date_trunc("second", "ts").cast("timestamp_ntz")).alias("b"),
    )
    start, end = clock.time_text(F.col("a")), clock.time_text(F.col("b"))
    return spans.select(
        "event_id",
        clock.clock_abs_seconds(start, end).alias("script_seconds"),
        clock.clock_nonzero_seconds(start, end).alias("two_branch_seconds"),
        clock.view_seconds(F.to_date("a"), F.to_date("b"), start, end).alias("view_seconds"),
        clock.elapsed_seconds(F.col("a"), F.col("b")).alias("elapsed_seconds"),
    )


def format_duration(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", clock.duration_text(F.col("o_totalprice")).alias("duracao")
    )


QUERIES = {
    "trip_distance": trip_distance,
    "trip_rejects": trip_rejects,
    "empty_input": empty_input,
    "trip_endpoints": trip_endpoints,
    "endpoint_distance": endpoint_distance,
    "haversine_km": haversine_km,
    "elevation_profile": elevation_profile,
    "elevation_smoothed": elevation_smoothed,
    "input_report": input_report,
    "first_last_window": first_last_window,
    "loaded_on": loaded_on,
    "datetime_split": datetime_split,
    "clock_duration": clock_duration,
    "format_duration": format_duration,
}

_ABS_CLOCK = f"abs({sql_clock_of('end_point')} - {sql_clock_of('start_first_point')})"
_TRIP_CLOCK = f"nullif(abs({sql_clock_of('last_ts')} - {sql_clock_of('first_ts')}), 0)"
_SPAN_CLOCK = f"abs({sql_clock_of('b')} - {sql_clock_of('a')})"

_SEGMENT = "PARTITION BY user_id, trip_date, hour(ts) // 6 ORDER BY seq"
_CLIMBS = f"""climbs AS (
    SELECT user_id, trip_date, hour(ts) // 6 AS seg, elevacao, {{value}} - lag({{value}}) OVER ({_SEGMENT}) AS step FROM points)"""
_SMOOTH = f"""means AS (
    SELECT *, lag(elevacao) OVER w * 0.3e0 + elevacao * 0.4e0 + lead(elevacao) OVER w * 0.3e0 AS mean
    FROM points WINDOW w AS ({_SEGMENT}))"""
_UP, _DOWN = (f"CAST(coalesce(sum({sql_micro(step)}), 0) AS DOUBLE) / 1e6" for step in (
    "CASE WHEN step > 0 THEN step ELSE step * 0 END", "CASE WHEN step < 0 THEN -step ELSE step * 0 END"))

ORACLES = {
    "trip_distance": f"""WITH {DISTANCES}
        SELECT *, {sql_hms('start_first_point')} AS hora_inicio, {sql_hms('end_point')} AS hora_fim,
               CAST({_ABS_CLOCK} AS BIGINT) AS tempo_viagem,
               date_sub('second', start_first_point, end_point) AS tempo_decorrido
        FROM distances WHERE n_segments > 0""",
    "trip_rejects": f"""WITH {DISTANCES}
        SELECT user_id, trip_date, n_points, n_segments FROM distances WHERE n_segments = 0""",
    "empty_input": f"""WITH {DISTANCES}
        SELECT user_id, trip_date, n_points, dist_euclidiana FROM distances WHERE n_points < 0""",
    "trip_endpoints": f"WITH {_ENDS} SELECT * FROM ends",
    "endpoint_distance": f"""WITH {_ENDS}
        SELECT user_id, trip_date, {sql_round(f'sqrt({_EX} * {_EX} + {_EY} * {_EY}) * 1e3')} AS dist_euclidiana,
               {sql_round(f'(abs({_EX}) + abs({_EY})) * 1e3')} AS dist_manhattan,
               {sql_round(f'pow(pow(abs({_EX}), 3e0) + pow(abs({_EY}), 3e0), CAST(1 AS DOUBLE) / 3) * 1e3')}
                   AS dist_minkowski
        FROM ends""",
    "haversine_km": f"""WITH {_ENDS}
        SELECT user_id, trip_date,
               {sql_round(sql_haversine('first_latitude', 'first_longitude', 'last_latitude', 'last_longitude'), 4)}
                   AS dist_linear_km
        FROM ends""",
    "elevation_profile": f"""WITH {POINTS}, {_CLIMBS.format(value='elevacao')}
        SELECT user_id, trip_date, count(*) AS n_points, count(DISTINCT seg) AS n_segments, count(DISTINCT seg // 2) AS n_tracks,
               min(elevacao) AS min_elevation, max(elevacao) AS max_elevation, {_UP} AS uphill, {_DOWN} AS downhill
        FROM climbs GROUP BY user_id, trip_date""",
    "elevation_smoothed": f"""WITH {POINTS}, {_SMOOTH}, {_CLIMBS.format(value='coalesce(mean, elevacao)').replace('FROM points', 'FROM means')}
        SELECT user_id, trip_date, count(*) AS n_points, {_UP} AS uphill, {_DOWN} AS downhill
        FROM climbs GROUP BY user_id, trip_date""",
    "input_report": """SELECT 'points' AS input, count(*) AS n_rows, count(*) = 0 AS is_empty FROM events
        UNION ALL SELECT 'late', 0, true""",
    "first_last_window": f"""WITH {POINTS}, f AS (
            SELECT DISTINCT user_id, trip_date,
                   first_value(latitude) OVER w AS first_latitude, first_value(longitude) OVER w AS first_longitude,
                   last_value(latitude) OVER w AS last_latitude, last_value(longitude) OVER w AS last_longitude,
                   first_value(ts) OVER w AS first_ts, last_value(ts) OVER w AS last_ts
            FROM points
            WINDOW w AS (PARTITION BY user_id, trip_date ORDER BY seq
                         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
        SELECT user_id, trip_date, first_latitude, first_longitude, last_latitude, last_longitude,
               {sql_hms('first_ts')} AS inicio_rota, {sql_hms('last_ts')} AS fim_rota,
               CAST({_TRIP_CLOCK} AS BIGINT) AS tempo_viagem
        FROM f""",
    "loaded_on": f"""WITH {_ENDS}
        SELECT concat_ws('__', user_id, CAST(first_ts AS DATE), {sql_hms('first_ts')}) AS id_unico,
               CAST(first_ts AS DATE) AS data_rota, {sql_hms('first_ts')} AS inicio_rota,
               {sql_hms('last_ts')} AS fim_rota, CAST({_TRIP_CLOCK} AS BIGINT) AS tempo_viagem,
               {sql_round(sql_haversine('first_latitude', 'first_longitude', 'last_latitude', 'last_longitude'), 4)}
                   AS dist_linear_km,
               {sql_round('(abs(last_longitude - first_longitude) + abs(last_latitude - first_latitude)) * 1e3', 4)}
                   AS dist_manhattan
        FROM ends WHERE trip_date = DATE '2024-01-15' AND {_TRIP_CLOCK} IS NOT NULL""",
    "datetime_split": f"""SELECT event_id, t AS time_point,
               CASE WHEN event_id % 5 <> 0 THEN date_trunc('second', ts) END AS strict,
               CAST(t AS DATE) AS data, {sql_hms('t')} AS hora, date_trunc('second', t) AS combined
        FROM (SELECT event_id, ts, CASE WHEN event_id % 7 <> 0 THEN ts END AS t FROM events) AS e""",
    "clock_duration": f"""WITH spans AS (
            SELECT event_id, date_trunc('second', ts) AS a,
                   date_trunc('second', ts) + to_seconds(CASE WHEN event_id % 9 = 0 THEN 0
                       ELSE event_id * 7919 % 200000 - 50000 END) AS b FROM events)
        SELECT event_id, CAST({_SPAN_CLOCK} AS BIGINT) AS script_seconds,
               CAST(nullif({_SPAN_CLOCK}, 0) AS BIGINT) AS two_branch_seconds,
               CASE WHEN CAST(a AS DATE) = CAST(b AS DATE) AND b > a THEN CAST({_SPAN_CLOCK} AS BIGINT)
                    WHEN CAST(a AS DATE) = CAST(b AS DATE) AND a > b THEN CAST({_SPAN_CLOCK} AS BIGINT)
                    WHEN CAST(a AS DATE) < CAST(b AS DATE) THEN CAST(nullif({_SPAN_CLOCK}, 0) AS BIGINT)
               END AS view_seconds,
               CAST(epoch(b) - epoch(a) AS BIGINT) AS elapsed_seconds
        FROM spans""",
    "format_duration": """SELECT o_orderkey, printf('%02d:%02d:%02d', s // 3600, s % 3600 // 60, s % 60) AS duracao
        FROM (SELECT o_orderkey, CAST(floor(o_totalprice) AS BIGINT) AS s FROM orders) AS o""",
}
