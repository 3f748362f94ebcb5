"""Files, tables, GPX documents and incremental ingest: written to the shared folder and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from odolake.operators import ranking, trips
from odolake.queries.standins import DISTANCES, POINTS, TRIP, points, table
from odolake.session import shared_dir
from odolake.sinks import writers
from odolake.sources import delimited, gpx, tables
from odolake.streaming import ingest

_ORDERS = "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"


def csv_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "csv")
    writers.write_delimited(table(spark, sf_dir, "orders"), path)
    return delimited.read_delimited(spark, path, _ORDERS)


def csv_charset(spark, sf_dir):
    """Delimited files in ISO-8859-1, one folder per group."""
    path = shared_dir(spark, "latin")
    accented = F.concat(F.lit("São João - "), F.col("c_name"))
    customers = table(spark, sf_dir, "customer").select("c_custkey", accented.alias("nome"), "c_mktsegment")
    writers.write_delimited(customers, path, encoding="ISO-8859-1", by=["c_mktsegment"])
    return delimited.read_delimited(
        spark, path, "c_custkey BIGINT, nome STRING, c_mktsegment STRING", encoding="ISO-8859-1"
    )


def parquet_roundtrip(spark, sf_dir):
    path = shared_dir(spark, "parquet")
    writers.overwrite(table(spark, sf_dir, "orders"), path)
    return spark.read.parquet(path)


SHEET_ROWS = 5000
PREAMBLE = 9


def _sheets(spark, sf_dir):
    """Sheet exports with nine preamble lines and a header, some thousand orders per sheet; every 97th line is broken."""
    path = shared_dir(spark, "sheets")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    sheet = F.floor(F.col("o_orderkey") / SHEET_ROWS)
    text = F.to_csv(F.struct("o_orderkey", "o_orderpriority", "o_totalprice"), {"sep": ";"})
    broken = F.concat(F.lit("subtotal "), F.col("o_orderkey"), F.lit(";;"))
    data = orders.select(
        sheet.alias("sheet"),
        F.col("o_orderkey").alias("line"),
        F.when(F.col("o_orderkey") % 97 == 0, F.concat(text, F.lit("\n"), broken)).otherwise(text).alias("text"),
    )
    numbers = F.sequence(F.lit(-PREAMBLE - 1).cast("bigint"), F.lit(-1).cast("bigint"))
    head = data.select("sheet").distinct().select("sheet", F.explode(numbers).alias("line"))
    head = head.withColumn(
        "text",
        F.when(F.col("line") == -1, "CHAVE;PRIORIDADE;PRECO").otherwise(F.concat(F.lit("preamble "), F.col("line"))),
    )
    lines = data.unionByName(head).repartition("sheet").sortWithinPartitions("sheet", "line")
    lines.select("sheet", "text").write.partitionBy("sheet").text(path)
    return path


_SHEET = "o_orderkey BIGINT, o_orderpriority STRING, o_totalprice DOUBLE"


def csv_skip_preamble(spark, sf_dir):
    """The data lines of the sheets, typed."""
    return delimited.read_sheet_export(spark, _sheets(spark, sf_dir), _SHEET, PREAMBLE)


def csv_sheet_rejects(spark, sf_dir):
    """The lines of the sheets that are no data, with their line number."""
    lines = delimited.sheet_lines(spark, _sheets(spark, sf_dir), PREAMBLE)
    return delimited.sheet_rejects(lines, _SHEET).select("line", "text")


def csv_single_file(spark, sf_dir):
    """A report of five rows as one file."""
    path = shared_dir(spark, "report")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    writers.write_delimited(ranking.top_k(orders, [F.desc("o_totalprice"), F.asc("o_orderkey")], 5), path, single_file=True)
    rows = delimited.read_delimited(spark, path, "o_orderkey BIGINT, o_totalprice DOUBLE")
    return rows.withColumn("files", F.lit(len(rows.inputFiles())))


def append_load(spark, sf_dir):
    """Two bulk appends into one table, with a fixed load time."""
    path = shared_dir(spark, "append")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    loaded_at = F.lit("2024-03-29 10:00:00").cast("timestamp_ntz")
    writers.append(writers.with_load_time(orders.where(F.col("o_totalprice") < 200000), loaded_at), path)
    writers.append(writers.with_load_time(orders.where(F.col("o_totalprice") >= 200000), loaded_at), path)
    return spark.read.parquet(path)


def overwrite_load(spark, sf_dir):
    """Truncate and reload: only the second load stays."""
    path = shared_dir(spark, "reload")
    writers.overwrite(table(spark, sf_dir, "customer"), path)
    writers.overwrite(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), path)
    return spark.read.parquet(path)


def staged_insert(spark, sf_dir):
    path = shared_dir(spark, "staged")
    staging = table(spark, sf_dir, "part").select(
        F.concat(F.lit("nome_usuario_"), F.upper("p_name")).alias("variavel"), F.col("p_retailprice").alias("coeficiente")
    )
    run_at = F.lit("2024-03-29 10:00:00").cast("timestamp_ntz")
    writers.staged_insert(staging, path, "variavel", "nome_usuario_", run_at)
    return spark.read.parquet(path)


def run_snapshot(spark, sf_dir):
    """Two runs, the first one repeated: each run is there once."""
    path = shared_dir(spark, "runs")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    writers.write_snapshot(orders, path, "20240329_1000")
    writers.write_snapshot(orders.where(F.col("o_totalprice") > 100000), path, "20240330_1000")
    writers.write_snapshot(orders, path, "20240329_1000")
    return spark.read.option("basePath", path).schema("o_orderkey BIGINT, o_totalprice DOUBLE, run_id STRING").parquet(path)


def _catalog_orders(spark, sf_dir):
    name = f"odolake_orders_{uuid.uuid4().hex}"
    path = shared_dir(spark, "table")
    tables.create_if_absent(spark, name, "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE", path)
    tables.create_if_absent(spark, name, "o_orderkey BIGINT, o_custkey BIGINT, o_totalprice DOUBLE", path)
    table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice").write.insertInto(name)
    return name


def table_scan(spark, sf_dir):
    name = _catalog_orders(spark, sf_dir)
    found = tables.scan(spark, name)
    found.schema  # resolved now; the files stay when the table is dropped
    tables.drop(spark, name)
    return found


def view_scan(spark, sf_dir):
    """A view, replaced by another one of the same name, and read by a query text with values."""
    name = _catalog_orders(spark, sf_dir)
    view = f"{name}_view"
    tables.create_or_replace_view(spark, view, f"SELECT o_orderkey FROM {name}")
    tables.create_or_replace_view(
        spark, view, f"SELECT o_custkey, count(*) AS n, max(o_totalprice) AS dearest FROM {name} GROUP BY o_custkey"
    )
    found = tables.scan_query(
        spark, f"SELECT * FROM {view} WHERE dearest >= :least AND n > :n", least=150000.0, n=5
    )
    found.schema
    tables.drop(spark, view, name)
    return found


# --- GPX ------------------------------------------------------------------------------------------

DOC_SPAN = 4096


def _documents(spark, sf_dir):
    """GPX text of the points: a document is one trip within a span of sequence numbers.

    So no document has more than ``DOC_SPAN`` points. Points before and after noon are two segments;
    every 7th point has no elevation and every 11th no time.
    """
    rows = points(spark, sf_dir).withColumn("part", F.floor(F.col("seq") / DOC_SPAN))
    xml = F.concat(
        F.lit('<trkpt lat="'),
        F.col("latitude").cast("string"),
        F.lit('" lon="'),
        F.col("longitude").cast("string"),
        F.lit('">'),
        F.when(F.col("seq") % 7 == 0, "").otherwise(F.concat(F.lit("<ele>"), F.col("elevacao").cast("string"), F.lit("</ele>"))),
        F.when(F.col("seq") % 11 == 0, "").otherwise(F.concat(F.lit("<time>"), F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit("</time>"))),
        F.lit("</trkpt>"),
    )
    entry = F.struct("seq", (F.hour("ts") < 12).alias("am"), xml.alias("xml"))
    grouped = rows.groupBy(*TRIP, "part").agg(F.array_sort(F.collect_list(entry)).alias("pts"))

    def segment(am: bool):
        chosen = F.filter("pts", lambda p: p["am"] == F.lit(am))
        return F.concat(F.lit("<trkseg>"), F.array_join(F.transform(chosen, lambda p: p["xml"]), ""), F.lit("</trkseg>"))

    name = F.concat_ws("__", "user_id", "trip_date", "part")
    return grouped.select(
        name.alias("name"),
        F.concat(
            F.lit('<gpx xmlns="http://www.topografix.com/GPX/1/1" version="1.1"><trk><name>'),
            name,
            F.lit("</name>"),
            segment(True),
            segment(False),
            F.lit("</trk></gpx>"),
        ).alias("body"),
    )


def gpx_points(spark, sf_dir):
    path = shared_dir(spark, "gpx")
    _documents(spark, sf_dir).select("body").write.text(path)
    found = gpx.points(gpx.intact(gpx.read_gpx(spark, path, packed=True)))
    return found.select("trk_name", "trk_idx", "seg_idx", "pt_idx", "latitude", "longitude", "elevacao", "time_point")


def _stored_documents(spark, sf_dir):
    documents = _documents(spark, sf_dir)
    user = F.split_part("name", F.lit("__"), F.lit(1)).cast("bigint")
    cut = F.substr("body", F.lit(1), F.length("body") - 20)
    return documents.withColumn("body", F.when(user % 10 == 0, cut).otherwise(F.col("body")))


def gpx_quarantine(spark, sf_dir):
    """Truncated documents go to quarantine, the others are read."""
    documents = gpx.parse_gpx(_stored_documents(spark, sf_dir), "body")
    return gpx.quarantine(documents).select("name", F.col("_corrupt_record").isNotNull().alias("is_corrupt"))


# --- incremental ------------------------------------------------------------------------------------


def incremental_ingest(spark, sf_dir):
    """Two file drops and three runs: every file is taken once, the third run adds nothing.

    A drop moves to the archive when the next one is taken, so a last one without rows brings both there.
    """
    landing, target = shared_dir(spark, "landing"), shared_dir(spark, "ingested")
    archive, progress = shared_dir(spark, "archive"), shared_dir(spark, "progress")
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")

    def run() -> None:
        stream = ingest.new_files(spark, landing, "parquet", events.schema, archive)
        ingest.refresh(stream, {target: lambda batch: batch.where(F.col("event_id").isNotNull())}, progress)

    writers.append(events.where(F.col("event_type") != "click"), landing)
    run()
    writers.append(events.where(F.col("event_type") == "click"), landing)
    run()
    run()
    writers.append(events.where("false"), landing)
    run()
    moved = spark.read.schema("event_id BIGINT").option("recursiveFileLookup", True).parquet(archive)
    moved = moved.select("event_id", F.lit(True).alias("archived"))
    found = ingest.read_batches(spark, target, events.schema).join(moved, "event_id", "left")
    return found.fillna({"archived": False})


def incremental_trips(spark, sf_dir):
    """Trips that come in three drops each: by time of day, and point by point in turn for every fifth user."""
    landing, target, progress = shared_dir(spark, "points"), shared_dir(spark, "states"), shared_dir(spark, "progress")
    all_points = points(spark, sf_dir)
    schema = all_points.schema
    fold = trips.distance_fold(TRIP)
    drop = F.when(F.col("user_id") % 5 == 0, F.col("seq") % 3).otherwise(F.floor(F.hour("ts") / 8))
    for i in range(3):
        writers.append(all_points.where(drop == i), landing)
        ingest.refresh(ingest.new_files(spark, landing, "parquet", schema), {target: fold.states}, progress)
    whole = trips.whole_states(fold, ingest.read_batches(spark, target), spark.read.schema(schema).parquet(landing))
    facts = trips.measured_trips(trips.distance_facts(fold, whole))
    return facts.select(
        *TRIP, "n_points", "n_segments", "dist_euclidiana", "dist_manhattan", "start_first_point", "start_second_point", "end_point"
    )


QUERIES = {
    "csv_roundtrip": csv_roundtrip,
    "csv_charset": csv_charset,
    "parquet_roundtrip": parquet_roundtrip,
    "csv_skip_preamble": csv_skip_preamble,
    "csv_sheet_rejects": csv_sheet_rejects,
    "csv_single_file": csv_single_file,
    "append_load": append_load,
    "overwrite_load": overwrite_load,
    "staged_insert": staged_insert,
    "run_snapshot": run_snapshot,
    "table_scan": table_scan,
    "view_scan": view_scan,
    "gpx_points": gpx_points,
    "gpx_quarantine": gpx_quarantine,
    "incremental_ingest": incremental_ingest,
    "incremental_trips": incremental_trips,
}

_DOCS = f"""{POINTS}, docs AS (
    SELECT *, concat_ws('__', user_id, trip_date, CAST(seq // {DOC_SPAN} AS BIGINT)) AS trk_name FROM points)"""

ORACLES = {
    "csv_roundtrip": "SELECT * FROM orders",
    "csv_charset": "SELECT c_custkey, 'São João - ' || c_name AS nome, c_mktsegment FROM customer",
    "parquet_roundtrip": "SELECT * FROM orders",
    "csv_skip_preamble": "SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders",
    "csv_sheet_rejects": f"""SELECT line, 'subtotal ' || o_orderkey || ';;' AS text FROM (
            SELECT o_orderkey, {PREAMBLE} + row_number() OVER w + sum(CASE WHEN o_orderkey % 97 = 0 THEN 1 ELSE 0 END) OVER w
                AS line
            FROM orders WINDOW w AS (PARTITION BY o_orderkey // {SHEET_ROWS} ORDER BY o_orderkey)) AS numbered
        WHERE o_orderkey % 97 = 0""",
    "csv_single_file": """SELECT o_orderkey, o_totalprice, 1 AS files FROM orders
        ORDER BY o_totalprice DESC, o_orderkey LIMIT 5""",
    "append_load": """SELECT o_orderkey, o_totalprice, TIMESTAMP '2024-03-29 10:00:00' AS data_carga_banco
        FROM orders""",
    "overwrite_load": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "staged_insert": """SELECT upper(p_name) AS variavel, p_retailprice AS coeficiente,
               TIMESTAMP '2024-03-29 10:00:00' AS data_execucao FROM part""",
    "run_snapshot": """SELECT o_orderkey, o_totalprice, '20240329_1000' AS run_id FROM orders
        UNION ALL SELECT o_orderkey, o_totalprice, '20240330_1000' FROM orders WHERE o_totalprice > 100000""",
    "table_scan": "SELECT o_orderkey, o_custkey, o_totalprice FROM orders",
    "view_scan": """SELECT o_custkey, count(*) AS n, max(o_totalprice) AS dearest FROM orders GROUP BY o_custkey
        HAVING max(o_totalprice) >= 150000 AND count(*) > 5""",
    "gpx_points": f"""WITH {_DOCS}
        SELECT trk_name, 0 AS trk_idx, CASE WHEN hour(ts) < 12 THEN 0 ELSE 1 END AS seg_idx,
               CAST(row_number() OVER (PARTITION BY trk_name, hour(ts) < 12 ORDER BY seq) - 1 AS INTEGER) AS pt_idx,
               latitude, longitude, CASE WHEN seq % 7 <> 0 THEN elevacao END AS elevacao,
               CASE WHEN seq % 11 <> 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ') END AS time_point
        FROM docs""",
    "gpx_quarantine": f"""WITH {_DOCS} SELECT DISTINCT trk_name AS name, true AS is_corrupt FROM docs
        WHERE user_id % 10 = 0""",
    "incremental_ingest": "SELECT event_id, user_id, event_type, value, true AS archived FROM events",
    "incremental_trips": f"""WITH {DISTANCES}
        SELECT user_id, trip_date, n_points, n_segments, dist_euclidiana, dist_manhattan, start_first_point,
               start_second_point, end_point
        FROM distances WHERE n_segments > 0""",
}
