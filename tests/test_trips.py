import datetime
import random

import pytest
from pyspark.sql import functions as F

from odolake.operators import trips
from odolake.plans import layers

SCHEMA = "trip string, seq bigint, latitude double, longitude double, elevacao double, ts timestamp_ntz"


def at(minute):
    return datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=minute)


def points(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_three_point_trip(spark):
    rows = [("a", i, 1.5 + i / 10, 2.5 + i / 10, float(i), at(i)) for i in range(3)]
    [row] = trips.trip_distances(points(spark, rows), ["trip"]).collect()
    assert (row.n_points, row.n_segments) == (3, 2)
    assert row.dist_euclidiana == pytest.approx(282.842712, abs=2e-6)
    assert row.dist_manhattan == pytest.approx(400, abs=2e-6)
    assert row.dist_minkowski == pytest.approx(251.984210, abs=2e-6)
    assert (row.start_first_point, row.start_second_point, row.end_point) == (at(0), at(1), at(2))


def test_single_point_trip_is_a_reject_only(spark):
    rows = [("one", 1, 1.0, 1.0, 1.0, at(0)), ("two", 1, 1.0, 1.0, 1.0, at(0)), ("two", 2, 1.0, 2.0, 1.0, at(5))]
    found = trips.trip_distances(points(spark, rows), ["trip"])
    assert [r.trip for r in trips.measured_trips(found).collect()] == ["two"]
    assert [r.trip for r in trips.trip_rejects(found).collect()] == ["one"]


def test_missing_coordinates_break_both_neighbour_segments(spark):
    rows = [("a", 0, 0.0, 0.0, None, at(0)), ("a", 1, None, 1.0, 2.0, at(1)), ("a", 2, 0.0, 2.0, 5.0, at(2)), ("a", 3, 0.0, 3.0, 1.0, at(3))]
    [row] = trips.trip_distances(points(spark, rows), ["trip"]).collect()
    assert row.dist_euclidiana == 1000.0
    [profile] = trips.elevation_profile(points(spark, rows), ["trip"]).collect()
    assert (profile.uphill, profile.downhill) == (3.0, 4.0)


@pytest.mark.parametrize("chunk", [1, 2, 7, 1 << 20])
def test_chunks_do_not_change_any_result(spark, chunk):
    """One trip holds most rows and spans many chunks; gaps in the numbering leave chunks empty."""
    rng = random.Random(3)
    sizes = {"hot": 300, "small": 4, "single": 1}
    rows = []
    for name, size in sizes.items():
        for i, seq in enumerate(sorted(rng.sample(range(size * 5), size))):
            rows.append((name, seq, rng.uniform(-90, 90), rng.uniform(-180, 180), rng.uniform(0, 900), at(i)))
    rng.shuffle(rows)
    df = points(spark, rows)
    found = {r.trip: r for r in trips.trip_distances(df, ["trip"], chunk=chunk).collect()}
    climbs = {r.trip: r for r in trips.elevation_profile(df, ["trip"], chunk=chunk).collect()}
    for name in sizes:
        pts = sorted(r for r in rows if r[0] == name)
        pairs = list(zip(pts, pts[1:]))
        row, profile = found[name], climbs[name]
        assert (row.n_points, row.n_segments) == (len(pts), len(pairs))
        euclid = sum(((a[2] - b[2]) ** 2 + (a[3] - b[3]) ** 2) ** 0.5 * 1000 for a, b in pairs)
        assert row.dist_euclidiana == pytest.approx(euclid, rel=1e-9, abs=1e-3)
        assert row.dist_manhattan >= row.dist_euclidiana >= row.dist_minkowski
        assert row.start_first_point == pts[0][5] and row.end_point == pts[-1][5]
        assert row.start_second_point == (pts[1][5] if len(pts) > 1 else None)
        assert profile.uphill - profile.downhill == pytest.approx(pts[-1][4] - pts[0][4], abs=1e-3)
        assert profile.min_elevation == min(p[4] for p in pts)
    whole = trips.trip_distances(df, ["trip"]).orderBy("trip").collect()
    assert whole == [found[r.trip] for r in whole]


def test_last_point_decides_the_place(spark):
    rows = [("a", i, 0.0, 0.0 if i < 2499 else 10.0, 0.0, at(i)) for i in range(2500)]
    places = spark.createDataFrame([("A", 0.1, 0.1), ("B", 0.1, 9.9)], "city string, place_latitude double, place_longitude double")
    [row] = layers.trip_locations(points(spark, rows), ["trip"], places, "city").collect()
    assert row.city == "B"


def test_silver_and_quarantine(spark):
    rows = [("1__routes__A_B.csv", 0, 1.0, 2.0, 3.0, "2024-01-01 10:00:00+00:00"), ("notes.csv", 0, 1.0, 2.0, 3.0, "x")]
    bronze = spark.createDataFrame(rows, "file_name string, seq bigint, latitude double, longitude double, elevacao double, time_point string")
    silver = layers.silver_points(bronze)
    assert silver.columns == layers.SILVER_COLUMNS
    [good] = silver.where(layers.has_trip_key()).collect()
    assert (good.id_rota, good.nome_usuario, good.hora) == ("1", "A_B", "10:00:00")
    [bad] = silver.where(~layers.has_trip_key()).collect()
    assert bad.data is None and bad.hora is None


def test_gold_keeps_every_point(spark):
    silver = spark.createDataFrame([("1", i) for i in range(5)] + [("2", 0)], "trip string, seq bigint")
    places = spark.createDataFrame([("1", {"city": "X", "country_code": "br"})], "trip string, address map<string,string>")
    gold = layers.gold_points(silver, places, ["trip"]).collect()
    assert len(gold) == 6
    assert {(r.trip, r.cidade, r.pais) for r in gold} == {("1", "X", "BR"), ("2", None, None)}


def test_trip_table_durations(spark):
    rows = [("a", 0, 0.0, 0.0, 0.0, datetime.datetime(2024, 1, 1, 23)), ("a", 1, 0.0, 1.0, 0.0, datetime.datetime(2024, 1, 2, 1))]
    [row] = trips.trip_table(trips.trip_distances(points(spark, rows), ["trip"])).collect()
    assert (row.tempo_viagem, row.tempo_decorrido) == (79200, 7200)
    second = trips.trip_table(trips.trip_distances(points(spark, rows), ["trip"]), "start_second_point")
    assert second.collect()[0].hora_inicio == "01:00:00"


def test_climb_stays_within_segments(spark):
    rows = [("a", 0, 0, 100.0), ("a", 0, 0, 110.0), ("a", 0, 1, 500.0), ("a", 0, 1, 510.0), ("a", 1, 0, 5.0)]
    rows = [(name, trk, seg, seq, e) for seq, (name, trk, seg, e) in enumerate(rows)]
    df = spark.createDataFrame(rows, "trip string, trk int, seg int, seq bigint, elevacao double")
    [row] = trips.elevation_profile(df, ["trip"], ["trk", "seg"]).collect()
    assert (row.uphill, row.downhill, row.n_points, row.n_segments, row.n_tracks) == (20.0, 0.0, 5, 3, 2)
    [whole] = trips.elevation_profile(df, ["trip"]).collect()
    assert (whole.uphill, whole.downhill, whole.n_segments, whole.n_tracks) == (410.0, 505.0, 1, 1)


@pytest.mark.parametrize("chunk", [1, 4, 1 << 20])
def test_smoothing_crosses_chunk_borders(spark, chunk):
    rng = random.Random(9)
    heights = [None if rng.random() < 0.1 else rng.uniform(0, 50) for _ in range(60)]
    rows = [("a", i // 20, i * 3, e) for i, e in enumerate(heights)]
    df = spark.createDataFrame(rows, "trip string, seg int, seq bigint, elevacao double")
    [row] = trips.elevation_profile(df, ["trip"], ["seg"], smooth=True, chunk=chunk).collect()
    up = 0.0
    for at in range(0, 60, 20):
        part = heights[at : at + 20]
        even = list(part)
        for i in range(1, 19):
            if None not in part[i - 1 : i + 2]:
                even[i] = part[i - 1] * 0.3 + part[i] * 0.4 + part[i + 1] * 0.3
        up += sum(max(b - a, 0) for a, b in zip(even, even[1:]) if a is not None and b is not None)
    assert row.uphill == pytest.approx(up, abs=1e-4)
