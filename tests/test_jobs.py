"""All jobs in a row on a handful of trips, then again with one more file."""

import datetime
import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from odolake.plans import jobs
from odolake.sources import delimited
from odolake.streaming.ingest import new_batches, new_files, publish, read_batches, refresh

RJ = "RIO DE JANEIRO"


def gpx(points):
    body = "".join(f'<trkpt lat="{a}" lon="{b}"><ele>1</ele><time>{t}</time></trkpt>' for a, b, t in points)
    return f'<gpx xmlns="http://www.topografix.com/GPX/1/1"><trk><trkseg>{body}</trkseg></trk></gpx>'


def trip(start, step, n, hour):
    return [(start, round(step * i, 6), f"2024-03-29T{hour:02d}:{i:02d}:00Z") for i in range(n)]


def test_whole_run(spark, tmp_path):
    landing, lake, sheets = tmp_path / "landing", str(tmp_path / "lake"), tmp_path / "sheets"
    landing.mkdir()
    sheets.mkdir()
    files = {
        "1__routes__FORD_MUSTANG.gpx": trip(0.0, 0.01, 5, 8),
        "2__routes__HONDA_CIVIC_2016.gpx": trip(0.0, 0.02, 5, 9),
        "3__routes__FORD_MUSTANG.gpx": trip(0.0, 0.5, 5, 10),
        "4__routes__TOYOTA_PRIUS_2017.gpx": trip(0.0, 0.01, 5, 11),
        "5__routes__TOYOTA_PRIUS_2017.gpx": trip(0.0, 0.01, 1, 12),
        "notes.gpx": trip(0.0, 0.01, 2, 13),
    }
    for name, points in files.items():
        (landing / name).write_text(gpx(points))
    (landing / "9__routes__X_Y.gpx").write_text("<gpx><trk>")
    head = "".join(f"note {i}\n" for i in range(9)) + "header\n"
    row = "2024-03-24;2024-03-30;{};CITY;{};10;R$/l;{};0;1;9;0\n"
    (sheets / "w.csv").write_text(head + row.format(RJ, "GASOLINA COMUM", 6.0) + row.format("BAHIA", "GASOLINA COMUM", 9.0) + "subtotal;;\n")

    places = spark.createDataFrame(
        [(1, 0.0, 0.0, {"city": "A", "country_code": "br"}), (2, 0.0, 2.0, {"county": "B", "country_code": "br"})],
        "place int, place_latitude double, place_longitude double, address map<string,string>",
    )

    def layer_jobs():
        jobs.bronze_job(spark, str(landing), lake)
        jobs.silver_job(spark, lake)
        jobs.gold_job(spark, lake, places, "place")
        jobs.load_job(spark, lake)

    route = json.dumps({"routes": [{"summary": {"distance": 1500.0, "duration": 60.0}}]})
    ids = ["1__FORD_MUSTANG", "2__HONDA_CIVIC_2016", "3__FORD_MUSTANG", "4__TOYOTA_PRIUS_2017", "6__HONDA_CIVIC_2022"]
    answers = [(i, 200, route) for i in ids] + [("5__TOYOTA_PRIUS_2017", 200, '{"error": 1}')]
    answers = spark.createDataFrame(answers, "id_unico string, status int, body string")

    layer_jobs()
    jobs.trip_job(spark, lake, answers)
    assert jobs.read_layer(spark, lake, "bronze").count() == 23
    assert jobs.read_layer(spark, lake, "quarantine").count() == 1
    assert jobs.read_layer(spark, lake, "unnamed").count() == 2
    assert jobs.read_layer(spark, lake, "gold").count() == 21
    distances = {r.id_rota: r for r in jobs.read_table(spark, lake, "distances").collect()}
    assert set(distances) == {"1", "2", "3", "4"}
    assert distances["3"].dist_euclidiana == 2000.0 and distances["3"].tempo_viagem == 240
    assert (distances["1"].cidade, distances["3"].cidade, distances["3"].pais) == ("A", "B", "BR")
    assert [r.id_rota for r in jobs.read_table(spark, lake, "rejects").collect()] == ["5"]

    layer_jobs()
    assert jobs.distances(spark, lake).count() == 5
    (landing / "6__routes__HONDA_CIVIC_2022.gpx").write_text(gpx(trip(0.0, 0.02, 5, 14)))
    layer_jobs()
    jobs.trip_job(spark, lake, answers)
    assert jobs.read_table(spark, lake, "distances").count() == 5

    road = jobs.read_table(spark, lake, "road").collect()
    assert {r.id_unico for r in road} == set(ids) and {r.distancia_real_km_api for r in road} == {1.5}
    assert [r.id_unico for r in jobs.read_table(spark, lake, "road_rejects").collect()] == ["5__TOYOTA_PRIUS_2017"]

    def car(make, model, mpg):
        return (make, model, 200, json.dumps([{"class": "car", "make": make, "model": model, "fuel_type": "gas", "city_mpg": mpg, "highway_mpg": mpg}]))

    cars = [car("ford", "mustang", 20), car("honda", "civic", 30), ("toyota", "prius", 500, "")]
    jobs.reference_job(spark, lake, str(sheets), spark.createDataFrame(cars, "marca string, modelo string, status int, body string"))
    assert [tuple(r) for r in jobs.read_table(spark, lake, "economy_rejects").collect()] == [("toyota", "prius", "status 500")]
    cars[2] = car("toyota", "prius", 50)
    jobs.reference_job(spark, lake, str(sheets), spark.createDataFrame(cars, "marca string, modelo string, status int, body string"))
    assert jobs.read_table(spark, lake, "economy").count() == 3 and jobs.read_table(spark, lake, "economy_rejects").isEmpty()
    assert jobs.read_table(spark, lake, "prices").count() == 2
    assert [(r.line, r.text) for r in jobs.read_table(spark, lake, "price_rejects").collect()] == [(12, "subtotal;;")]

    for run in ("1", "2"):
        jobs.model_job(spark, lake, RJ, run)
    cost = jobs.read_table(spark, lake, "trip_cost")
    assert cost.count() == 5
    [dear] = cost.where("id_unico = '3__FORD_MUSTANG'").collect()
    assert dear.litros == dear.dist_km / dear.media_consumo_km_l and dear.preco_medio_revenda == 6.0
    clustered = jobs.read_table(spark, lake, "clustered")
    assert clustered.groupBy("run_id").count().count() == 2 and clustered.count() == 10
    swap = jobs.read_table(spark, lake, "simulation").orderBy("rank").collect()
    assert swap[0].nome_usuario_simulado == "TOYOTA_PRIUS_2017"
    names = jobs.read_table(spark, lake, "regression").select(F.collect_set("variavel")).collect()[0][0]
    errors = jobs.read_table(spark, lake, "regression_errors").collect()
    assert len(errors) == 2 and all(r.mae is None or (r.mae >= 0 and r.mse >= 0) for r in errors)
    assert "dist_km" in names and not [n for n in names if n.startswith("nome_usuario_")]


PLACES = "place int, place_latitude double, place_longitude double, address map<string,string>"


def run_drops(spark, tmp_path, name, drops):
    """Silver points in drops, through the gold and load jobs after each one."""
    lake = str(tmp_path / name)
    places = [(1, 0.0, 0.0, {"city": "A", "country_code": "br"}), (2, 0.0, 9.0, {"city": "B", "country_code": "br"})]
    for i, drop in enumerate(drops):
        publish(spark.createDataFrame(drop, jobs.SILVER_SCHEMA), jobs.layer(lake, "silver"), i)
        jobs.gold_job(spark, lake, spark.createDataFrame(places, PLACES), "place", F.lit("2024-04-01 00:00:00").cast("timestamp"))
        jobs.load_job(spark, lake)
    found = sorted(tuple(r) for r in jobs.distances(spark, lake).collect())
    points = jobs.located_points(spark, lake).select("id_rota", "seq", "cidade").collect()
    return found, sorted(tuple(r) for r in points)


def test_trips_may_span_drops(spark, tmp_path):
    """One trip in three drops, one that interleaves, one whole, one that comes twice: as if all came at once."""
    day = datetime.date(2024, 3, 29)
    rows = [(name, "V", i, 0.0, i * i / 40, 1.0, day, f"10:{i:02d}:00") for name in ("cut", "mixed", "whole") for i in range(20)]
    part = {"cut": lambda i: i // 7, "mixed": lambda i: i % 3, "whole": lambda i: 1}
    drops = [[r for r in rows if part[r[0]](r[2]) == d] for d in range(3)]
    assert all(drops)
    once = run_drops(spark, tmp_path, "once", [rows])
    assert run_drops(spark, tmp_path, "cut", drops) == once
    assert {r[2] for r in once[1]} == {"B"} and len(once[1]) == 60


def test_reading_follows_the_manifests_only(spark, tmp_path):
    target = str(tmp_path / "layer")
    assert read_batches(spark, target, "id long").isEmpty()
    publish(spark.range(3), target, 0)
    publish(spark.range(50), target, 0)  # has its manifest already
    spark.range(9).write.parquet(f"{target}/batches/batch=1-left-by-a-failed-attempt")
    assert read_batches(spark, target).count() == 3
    publish(spark.range(4), target, 1)
    assert read_batches(spark, target).count() == 7


def test_large_sheets_are_read_in_splits(spark, tmp_path):
    lines = [f"note {i}" for i in range(9)] + ["a;b"] + [f"{i};x{i}" if i % 50 else f"broken {i}" for i in range(4000)]
    for name in ("one.csv", "two.csv"):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    try:
        found = delimited.sheet_lines(spark, str(tmp_path))
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
        rows = delimited.sheet_rows(found, "a long, b string").collect()
        bad = delimited.sheet_rejects(found, "a long, b string").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.a, r.b) for r in rows) == sorted((i, f"x{i}") for i in range(4000) if i % 50 for _ in range(2))
    assert sorted((r.file_name, r.line, r.text) for r in bad) == sorted(
        (name, 10 + i, f"broken {i}") for name in ("one.csv", "two.csv") for i in range(0, 4000, 50)
    )


def test_a_repeated_batch_is_read_once_downstream(spark, tmp_path):
    """The second output fails once, the next layer runs in between, then both layers run again."""
    source, first, second, below = (str(tmp_path / name) for name in ("source", "first", "second", "below"))
    spark.range(10).write.parquet(source)
    broken = [True]

    def fragile(batch):
        if broken:
            raise RuntimeError("full disk")
        return batch

    def upper():
        refresh(new_files(spark, source, "parquet", "id long"), {first: lambda b: b, second: fragile}, str(tmp_path / "a"))

    def lower():
        refresh(new_batches(spark, first), {below: lambda b: b}, str(tmp_path / "b"), (first, "id long"))

    def counts():
        return [read_batches(spark, x, "id long").count() for x in (first, second, below)]

    lower()
    with pytest.raises(StreamingQueryException):
        upper()
    lower()
    assert counts() == [10, 0, 10]
    broken.clear()
    upper()
    lower()
    assert counts() == [10, 10, 10]
    spark.range(10, 15).write.mode("append").parquet(source)
    upper()
    lower()
    assert counts() == [15, 15, 15]
