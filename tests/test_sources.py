import gzip
import os

from pyspark.sql import functions as F

from odolake.plans import layers
from odolake.sinks import writers
from odolake.sources import delimited, gpx, pages, responses, tables
from odolake.streaming import ingest

GPX = """<?xml version="1.0"?>
<gpx xmlns="http://www.topografix.com/GPX/1/1" version="1.1">
<trk><name>x</name><trkseg>
<trkpt lat="1.5" lon="2.5"><ele>3</ele><time>2024-03-29T10:00:00Z</time></trkpt>
<trkpt lat="1.6" lon="2.6"/>
</trkseg><trkseg><trkpt lat="1.7" lon="2.7"/></trkseg></trk></gpx>"""


def gpx_dir(tmp_path):
    (tmp_path / "1__routes__A_B.gpx").write_text(GPX)
    with gzip.open(tmp_path / "2__routes__A_C.gpx.gz", "wt") as out:
        out.write(GPX)
    (tmp_path / "3__routes__A_D.gpx").write_text('<gpx><trk><trkseg><trkpt lat="1"')
    return str(tmp_path)


def test_gpx_files(spark, tmp_path):
    documents = gpx.read_gpx(spark, gpx_dir(tmp_path))
    rows = gpx.points(gpx.intact(documents)).orderBy("file_name", "seq").collect()
    assert len(rows) == 6
    assert [(r.seg_idx, r.pt_idx, r.latitude, r.elevacao) for r in rows[:3]] == [(0, 0, 1.5, 3.0), (0, 1, 1.6, None), (1, 0, 1.7, None)]
    assert [r.latitude for r in rows[:3]] == [r.latitude for r in rows[3:]]
    [bad] = gpx.quarantine(documents).collect()
    assert bad.file_name.startswith("3__") and bad.tracks_read == 0 and "trkpt" in bad._corrupt_record


def test_gpx_to_silver(spark, tmp_path):
    found = gpx.points(gpx.intact(gpx.read_gpx(spark, gpx_dir(tmp_path))))
    bronze = found.withColumn("file_name", F.regexp_replace("file_name", r"\.gpx(\.gz)?$", ".csv"))
    silver = layers.silver_points(bronze).where(layers.has_trip_key())
    assert {(r.id_rota, r.nome_usuario) for r in silver.collect()} == {("1", "A_B"), ("2", "A_C")}
    assert silver.where("hora = '10:00:00'").count() == 2


def test_stored_gpx_text(spark):
    df = spark.createDataFrame([("a", GPX.split("\n", 1)[1]), ("b", "<gpx><trk>")], "name string, body string")
    parsed = gpx.parse_gpx(df, "body")
    assert gpx.points(gpx.intact(parsed), ["name"]).count() == 3
    assert [r.name for r in gpx.quarantine(parsed).collect()] == ["b"]


def test_delimited_takes_only_the_suffix(spark, tmp_path):
    (tmp_path / "a.csv").write_text("latitude;longitude;elevacao;time_point\n1.5;2.5;;2024-01-01 10:00:00\n")
    (tmp_path / "b.txt").write_text("latitude;longitude;elevacao;time_point\n9;9;9;9\n")
    schema = "latitude DOUBLE, longitude DOUBLE, elevacao DOUBLE, time_point STRING"
    [row] = delimited.read_delimited(spark, str(tmp_path), schema).collect()
    assert (row.latitude, row.elevacao) == (1.5, None)


def test_empty_folder_flows_through(spark, tmp_path):
    schema = "file_name STRING, seq BIGINT, latitude DOUBLE, longitude DOUBLE, elevacao DOUBLE, time_point STRING"
    empty = delimited.read_delimited(spark, str(tmp_path), schema)
    assert layers.silver_points(empty).isEmpty()


def test_sheet_export(spark, tmp_path):
    head = "".join(f"note {i}\r\n" for i in range(9)) + "ESTADO;PRECO\r\n"
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_bytes((head + f"RJ {name};5.5\r\nSP;\r\n").encode())
    rows = delimited.read_sheet_export(spark, str(tmp_path), "estado STRING, preco DOUBLE").collect()
    assert sorted((r.estado, r.preco) for r in rows) == [("RJ a", 5.5), ("RJ b", 5.5), ("SP", None), ("SP", None)]


def test_one_file_report(spark, tmp_path):
    path = str(tmp_path / "out")
    writers.write_delimited(spark.range(100).repartition(4), path, single_file=True)
    assert len([f for f in os.listdir(path) if f.endswith(".csv")]) == 1


def test_snapshot_repeats_replace_themselves(spark, tmp_path):
    path = str(tmp_path / "runs")
    for run in ("1", "2", "1"):
        writers.write_snapshot(spark.range(3), path, run)
    assert spark.read.parquet(path).count() == 6


def test_table_is_created_once(spark, tmp_path):
    for _ in range(2):
        tables.create_if_absent(spark, "odolake_t", "id BIGINT", str(tmp_path / "t"))
    spark.range(3).write.insertInto("odolake_t")
    assert tables.scan(spark, "odolake_t").count() == 3
    spark.sql("DROP TABLE odolake_t")


def test_responses_and_features(spark):
    stored = spark.createDataFrame(
        [(1, 200, '[{"make":"a","model":"b","city_mpg":20,"highway_mpg":30}]'), (2, 500, "[]"), (3, None, None)],
        "k int, status int, body string",
    )
    rows = responses.vehicle_rows(spark.createDataFrame([(1,), (2,), (4,)], "k int"), stored, ["k"]).collect()
    assert [(r.k, r.make, r.city_mpg) for r in rows] == [(1, "a", 20.0)]
    assert {r.k for r in responses.refused(stored).collect()} == {2, 3}
    body = '{"elements":[{"tags":{"name":"T"}},{"tags":{"x":"y"}},{"id":1},{"tags":{"name":"T"}}]}'
    names = responses.feature_names(spark.createDataFrame([(1, body)], "k int, body string"), ["k"])
    assert [r.name for r in names.orderBy("pos").collect()] == ["T", "Unnamed", "T"]
    first = responses.first_seen_names(names, ["k", "pos"]).orderBy("pos").collect()
    assert [(r.name, r.pos) for r in first] == [("T", 0), ("Unnamed", 1)]


def test_trace_list_page(spark):
    html = (
        '<table><tr><td><a href="/user/a/traces/1">1</a></td></tr>'
        '<tr><td><span class="text-danger">PENDING</span><a href="/user/b/traces/2">2</a></td></tr><tr><td>-</td></tr></table>'
    )
    df = spark.createDataFrame([(1, html)], "page_id int, html string")
    rows = pages.link_rows(df, ["page_id"], "https://www.example.org").orderBy("pos").collect()
    assert [(r.pos, r.url, r.pending) for r in rows] == [
        (0, "https://www.example.org/user/a/traces/1", False),
        (1, "https://www.example.org/user/b/traces/2", True),
    ]


def test_incremental_runs_take_each_file_once(spark, tmp_path):
    landing, target = str(tmp_path / "in"), str(tmp_path / "out")
    archive, progress = str(tmp_path / "old"), str(tmp_path / "progress")

    def run():
        stream = ingest.new_files(spark, landing, "csv", "id BIGINT, v DOUBLE", archive, sep=";", header="true")
        ingest.refresh(stream, {target: lambda batch: batch.groupBy("id").agg(F.sum("v").alias("v"))}, progress)
        return ingest.read_batches(spark, target).count()

    os.makedirs(landing)
    (tmp_path / "in" / "a.csv").write_text("id;v\n1;2\n1;3\n")
    assert run() == 1
    assert run() == 1
    (tmp_path / "in" / "b.csv").write_text("id;v\n2;2\n")
    assert run() == 2
    assert run() == 2
    assert sorted(r.v for r in ingest.read_batches(spark, target).collect()) == [2.0, 5.0]


def test_wanted_keys_without_vehicles_are_told(spark):
    stored = spark.createDataFrame(
        [(1, 200, '[{"make": "opel", "model": "corsa"}]'), (2, 500, ""), (3, 200, "{garbled"), (4, 200, "[]")],
        "k int, status int, body string",
    )
    keys = spark.createDataFrame([(1,), (2,), (3,), (4,), (5,)], "k int")
    found = {r.k: r.reason for r in responses.vehicle_rejects(keys, stored, ["k"]).collect()}
    assert found == {2: "status 500", 3: "unreadable", 5: "missing"}
