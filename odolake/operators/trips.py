"""Trip measures from the point table: one output row per trip.

A point table has trip key columns, ``seq`` (file order of the points), ``latitude``,
``longitude``, ``elevacao`` and ``ts``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from odolake.functions import clock, distance
from odolake.functions.numbers import from_micro, half_up, micro
from odolake.operators.consecutive import CHUNK, Fold, fold_consecutive
from odolake.session import checkpoint


def _pair_distance(formula, **kwargs):
    def measure(prev, cur):
        return micro(
            formula(prev["latitude"], prev["longitude"], cur["latitude"], cur["longitude"], **kwargs)
        )

    return measure


def _has_previous(prev, cur) -> Column:
    return F.when(prev["latitude"].isNotNull() & prev["longitude"].isNotNull(), F.lit(1))


def distance_fold(trip: list[str], last: list[str] = ()) -> Fold:
    """The states that trip distances are made of; ``last`` names more columns whose value at the last point is kept."""
    return Fold(
        trip,
        "seq",
        ["latitude", "longitude", "ts", *last],
        {
            "n_segments": _has_previous,
            "dist_euclidiana": _pair_distance(distance.euclidean),
            "dist_manhattan": _pair_distance(distance.manhattan),
            "dist_minkowski": _pair_distance(distance.minkowski, p=3),
        },
        second=["ts"],
    )


def distance_facts(fold: Fold, states: DataFrame, last: list[str] = ()) -> DataFrame:
    return fold.facts(states).select(
        *fold.keys,
        F.col("n_rows").alias("n_points"),
        F.col("n_segments").cast("bigint").alias("n_segments"),
        *[from_micro(F.col(c)).alias(c) for c in ("dist_euclidiana", "dist_manhattan", "dist_minkowski")],
        F.col("first_ts").alias("start_first_point"),
        F.col("second_ts").alias("start_second_point"),
        F.col("last_ts").alias("end_point"),
        *[F.col(f"last_{c}").alias(c) for c in last],
    )


def trip_distances(points: DataFrame, trip: list[str], chunk: int = CHUNK) -> DataFrame:
    """Summed distances between consecutive points, with start, second and end time.

    Trips of one point have ``n_segments`` 0; see ``measured_trips`` and ``trip_rejects``.
    """
    fold = distance_fold(trip)
    return distance_facts(fold, fold.states(points, chunk))


def whole_states(fold: Fold, kept: DataFrame, points: DataFrame) -> DataFrame:
    """One state per trip out of ``kept``, the states of all batches; ``points`` holds the points of the same batches.

    A trip may come in any number of batches. Where their stretches interleave, its points are folded again, each point
    once; only the points of such trips are shuffled.
    """
    merged = checkpoint(fold.merge(kept))
    mixed = merged.where("_overlaps").select(*fold.keys)
    again = points.join(mixed, fold.keys, "left_semi").dropDuplicates([*fold.keys, fold.seq])
    return merged.where("NOT _overlaps").unionByName(fold.states(again))


def measured_trips(distances: DataFrame) -> DataFrame:
    return distances.where(F.col("n_segments") > 0)


def trip_rejects(distances: DataFrame) -> DataFrame:
    """Trips without a segment; the others are not affected by them."""
    return distances.where(F.col("n_segments") == 0)


def trip_table(distances: DataFrame, start: str = "start_first_point") -> DataFrame:
    """Date, clock times and both durations next to the distances."""
    begin, end = F.col(start), F.col("end_point")
    times = distances.withColumns(
        {
            "data_viagem": F.to_date(begin),
            "hora_inicio": clock.time_text(begin),
            "hora_fim": clock.time_text(end),
        }
    )
    return times.withColumns(
        {
            "tempo_viagem": clock.clock_abs_seconds(F.col("hora_inicio"), F.col("hora_fim")),
            "tempo_decorrido": clock.elapsed_seconds(begin, end),
        }
    )


def trip_endpoints(points: DataFrame, trip: list[str], cols: list[str] = ("latitude", "longitude", "ts")) -> DataFrame:
    """First and last value per trip in point order, combined map-side, so no trip is collected."""
    return points.groupBy(*trip).agg(
        *[F.min_by(c, "seq").alias(f"first_{c}") for c in cols],
        *[F.max_by(c, "seq").alias(f"last_{c}") for c in cols],
    )


def _endpoints_of(ends: DataFrame, digits: int | None):
    names = ["first_latitude", "first_longitude", "last_latitude", "last_longitude"]
    return [half_up(F.col(c), digits) if digits else F.col(c) for c in names]


def endpoint_distances(ends: DataFrame, orders: dict[str, float], digits: int = 10) -> DataFrame:
    """Distances of any order between the rounded endpoints: ``orders`` maps a column name to p."""
    place = _endpoints_of(ends, digits)
    return ends.withColumns({name: distance.minkowski(*place, p=p) for name, p in orders.items()})


def endpoint_geodesic_km(ends: DataFrame, name: str = "dist_linear_km") -> DataFrame:
    return ends.withColumn(name, distance.haversine_km(*_endpoints_of(ends, None)))


def elevation_profile(
    points: DataFrame, trip: list[str], segment: list[str] = (), smooth: bool = False, chunk: int = CHUNK
) -> DataFrame:
    """Point, segment and track count, elevation extremes, climb and descent.

    Climb and descent are differences of neighbours within a segment: ``segment`` names its columns, the first of which is
    the track. Without them a trip is one segment of one track. With ``smooth`` an elevation first becomes 0.4 of itself
    and 0.3 of each neighbour in its segment; the ends of a segment and points beside a missing value stay as they are.
    """
    segment = list(segment)
    if smooth:
        points = _smoothed(points, [*trip, *segment], chunk)

    def climb(prev, cur):
        return micro(F.greatest(cur["elevacao"] - prev["elevacao"], F.lit(0.0)))

    def descent(prev, cur):
        return micro(F.greatest(prev["elevacao"] - cur["elevacao"], F.lit(0.0)))

    # greatest() skips nulls, so a missing elevation counts as no climb; guard against that.
    def known(measure):
        return lambda prev, cur: F.when(prev["elevacao"].isNotNull() & cur["elevacao"].isNotNull(), measure(prev, cur))

    facts = fold_consecutive(
        points,
        [*trip, *segment],
        "seq",
        ["elevacao"],
        {"uphill": known(climb), "downhill": known(descent)},
        aggs={"min_elevation": ("min", "elevacao"), "max_elevation": ("max", "elevacao")},
        chunk=chunk,
    )
    tracks = facts.groupBy(*trip, *segment[:1]).agg(
        F.sum("n_rows").alias("n_points"),
        F.count(F.lit(1)).alias("n_segments"),
        F.min("min_elevation").alias("min_elevation"),
        F.max("max_elevation").alias("max_elevation"),
        F.sum("uphill").alias("uphill"),
        F.sum("downhill").alias("downhill"),
    )
    return tracks.groupBy(*trip).agg(
        F.sum("n_points").alias("n_points"),
        F.sum("n_segments").alias("n_segments"),
        F.count(F.lit(1)).alias("n_tracks"),
        F.min("min_elevation").alias("min_elevation"),
        F.max("max_elevation").alias("max_elevation"),
        from_micro(F.sum("uphill")).alias("uphill"),
        from_micro(F.sum("downhill")).alias("downhill"),
    )


def _smoothed(points: DataFrame, series: list[str], chunk: int) -> DataFrame:
    """Smoothed elevations. The first and last point of a chunk are lent to the chunks beside it, one row each."""
    cut = points.withColumn("_chunk", F.col("seq") - F.pmod(F.col("seq"), F.lit(chunk))).withColumn("_lent", F.lit(False))
    ends = cut.groupBy(*series, "_chunk").agg(
        *[f(F.struct("seq", "elevacao")).alias(name) for name, f in (("_first", F.min), ("_last", F.max))]
    )
    across = Window.partitionBy(*series).orderBy("_chunk")
    near = ends.select(*series, "_chunk", F.lag("_last").over(across).alias("a"), F.lead("_first").over(across).alias("b"))
    lent = near.select(*series, "_chunk", F.explode(F.array("a", "b")).alias("p")).where(F.col("p").isNotNull())
    lent = lent.select(*series, "_chunk", F.col("p.seq").alias("seq"), F.col("p.elevacao").alias("elevacao"), F.lit(True).alias("_lent"))
    along = Window.partitionBy(*series, "_chunk").orderBy("seq")
    before, after = F.lag("elevacao").over(along), F.lead("elevacao").over(along)
    mean = before * F.lit(0.3) + F.col("elevacao") * F.lit(0.4) + after * F.lit(0.3)
    both = cut.unionByName(lent, allowMissingColumns=True).withColumn("_mean", mean)
    smoothed = both.where(~F.col("_lent")).withColumn("elevacao", F.coalesce("_mean", "elevacao"))
    return smoothed.drop("_chunk", "_lent", "_mean")


def loaded_trips(points: DataFrame, trip: list[str], as_of: Column, loaded_at: str = "data_carga_banco") -> DataFrame:
    """Trip report of one load date: endpoints, times, geodesic and Manhattan distance.

    The load date is part of the point rows, so the filter reaches the scan (and prunes partitions
    where the table is partitioned by it). Trips without a usable duration are left out.
    """
    ends = trip_endpoints(points.where(F.to_date(loaded_at) == as_of), trip)
    timed = ends.withColumns(
        {
            "data_rota": F.to_date("first_ts"),
            "inicio_rota": clock.time_text(F.col("first_ts")),
            "fim_rota": clock.time_text(F.col("last_ts")),
        }
    )
    timed = timed.withColumn("tempo_viagem", clock.clock_nonzero_seconds(F.col("inicio_rota"), F.col("fim_rota")))
    timed = timed.where(
        F.col("data_rota").isNotNull() & F.col("inicio_rota").isNotNull() & F.col("tempo_viagem").isNotNull()
    )
    return endpoint_geodesic_km(timed).withColumn(
        "dist_manhattan", distance.manhattan(*_endpoints_of(timed, None))
    )
