"""Row clean-up, text fields, set operations, membership and rankings."""

from __future__ import annotations

from pyspark.sql import functions as F

from odolake.functions import clock, text
from odolake.functions.numbers import null_if_nan_text
from odolake.operators import ordering, ranking, summary
from odolake.plans import layers
from odolake.queries.standins import (
    rounded,
    sql_hms,
    sql_label,
    sql_mean,
    sql_round,
    table,
)

# --- points as they arrive: some values missing --------------------------------------------------


def _arrived(spark, sf_dir):
    """Events with the value missing in every 7th row and the time in every 11th."""
    events = table(spark, sf_dir, "events")
    return events.withColumns(
        {
            "value": F.when(F.col("event_id") % 7 != 0, F.col("value")),
            "ts": F.when(F.col("event_id") % 11 != 0, F.col("ts")),
        }
    )


_ARRIVED = """arrived AS (
    SELECT event_id, user_id, event_type, CASE WHEN event_id % 7 <> 0 THEN value END AS value,
           CASE WHEN event_id % 11 <> 0 THEN ts END AS ts FROM events)"""


def silver_points(spark, sf_dir):
    """Bronze rows with their file name, through the silver step; unreadable names go to quarantine."""
    bronze = _arrived(spark, sf_dir).select(
        F.when(F.col("user_id") % 10 == 0, "notes.csv")
        .otherwise(F.concat(F.col("user_id").cast("string"), F.lit("__routes__"), F.upper("event_type"), F.lit(".csv")))
        .alias("file_name"),
        F.col("event_id").alias("seq"),
        F.col("value").alias("latitude"),
        F.lit(1.5).alias("longitude"),
        F.col("value").alias("elevacao"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("time_point"),
    )
    return layers.silver_points(bronze).where(layers.has_trip_key())


def dropna_any(spark, sf_dir):
    return _arrived(spark, sf_dir).select("event_id", "value", "ts").dropna("any")


def fill_defaults(spark, sf_dir):
    split = _arrived(spark, sf_dir).select(
        "event_id", F.to_date("ts").cast("string").alias("data"), clock.time_text(F.col("ts")).alias("hora")
    )
    return split.fillna({"data": "1900-01-01", "hora": "00:00:00"})


def mask_filter(spark, sf_dir):
    rows = _arrived(spark, sf_dir).select("event_id", "user_id", "event_type", "value", "ts")
    return rows.where(
        F.col("ts").isNotNull() & F.col("value").isNotNull() & (F.col("event_type") == "click") & (F.col("user_id") == 8)
    )


def null_string_cast(spark, sf_dir):
    """Text columns where missing is ``'nan'``: back to null and typed."""
    rows = _arrived(spark, sf_dir)
    as_text = lambda c: F.coalesce(c.cast("string"), F.lit("nan"))
    raw = rows.select("event_id", as_text(F.col("value")).alias("v"), as_text(F.to_date("ts")).alias("d"))
    return raw.select(
        "event_id",
        null_if_nan_text(F.col("v"), "double").alias("value"),
        null_if_nan_text(F.col("d"), "date").alias("data"),
    )


def impute_mean(spark, sf_dir):
    rows = _arrived(spark, sf_dir).select("event_id", "event_type", "value")
    return rounded(summary.impute_group_mean(rows, "event_type", "value"), ["value"])


def column_means(spark, sf_dir):
    means = summary.column_means(_arrived(spark, sf_dir), ["value", "user_id"])
    return rounded(means, means.columns)


# --- text ---------------------------------------------------------------------------------------


def _names(spark, sf_dir):
    """File names of every form met: plain, without user, three parts, trailing ``__``, no match."""
    key = F.col("c_custkey")
    segment = F.col("c_mktsegment")
    name = F.concat(key.cast("string"), F.lit("__routes__"), segment)
    name = (
        F.when(key % 5 == 1, F.concat(key.cast("string"), F.lit("__"), segment))
        .when(key % 5 == 2, F.concat(name, F.lit("__B")))
        .when(key % 5 == 3, F.concat(name, F.lit("__")))
        .when(key % 5 == 4, F.lit("notes"))
        .otherwise(name)
    )
    return table(spark, sf_dir, "customer").select("c_custkey", F.concat(name, F.lit(".csv")).alias("file_name"))


def filename_fields(spark, sf_dir):
    name = F.col("file_name")
    return _names(spark, sf_dir).select(
        "c_custkey",
        text.trip_id(name).alias("id_rota"),
        text.trip_user(name).alias("nome_usuario"),
        text.trip_user_or_name(name).alias("nome_ou_rota"),
    )


def sanitize_name(spark, sf_dir):
    raw = F.concat(F.col("p_name"), F.lit(".("), F.col("p_brand"), F.lit(")"))
    return table(spark, sf_dir, "part").select("p_partkey", text.sanitize(raw).alias("nome"))


def string_slices(spark, sf_dir):
    name = F.col("c_name")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.right(name, F.lit(2)).alias("last_two"),
        F.left(name, F.length(name) - 3).alias("without_last_three"),
        F.trim(F.concat(F.lit("  "), name, F.lit(" "))).alias("trimmed"),
        F.endswith(name, F.lit("7")).alias("ends_with"),
        F.replace(name, F.lit("Customer#"), F.lit("")).alias("replaced"),
        F.split_part(name, F.lit("#"), F.lit(2)).alias("second_part"),
        F.concat_ws("#", name, "c_mktsegment").alias("joined"),
    )


def assign_label(spark, sf_dir):
    return table(spark, sf_dir, "events").select("event_id", text.assign_label(F.col("event_id")).alias("nome_usuario"))


# --- several tables -------------------------------------------------------------------------------


def union_all(spark, sf_dir):
    """Two tables with different columns under one another; missing columns become null."""
    a = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"), "c_mktsegment")
    b = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"), "s_acctbal")
    return a.unionByName(b, allowMissingColumns=True)


def zip_join(spark, sf_dir):
    """n-th supplier in name order with the n-th customer name in reverse order."""
    users = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    files = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    return ordering.zip_rows(users, files, ["s_name", "s_suppkey"], [F.desc("c_name"), F.desc("c_custkey")])


def _longest(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate").isNotNull())
    best = ranking.top_per_group(
        orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority"),
        ["o_custkey"],
        [F.desc("o_totalprice"), F.asc("o_orderkey")],
    )
    return ranking.top_k(best, [F.desc("o_totalprice"), F.asc("o_orderkey")], 5)


def top1_per_group(spark, sf_dir):
    """Longest trip (largest order) per driver (customer), then the five longest."""
    return _longest(spark, sf_dir)


def top1_join_dim(spark, sf_dir):
    # Five rows at most on the ranked side.
    customers = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment")
    return customers.join(F.broadcast(_longest(spark, sf_dir)), "o_custkey")


def semi_join(spark, sf_dir):
    """All detail rows of the five longest trips."""
    ids = _longest(spark, sf_dir).select(F.col("o_orderkey").alias("l_orderkey"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    return ranking.in_list(lines, ids, "l_orderkey")


def top_n_order(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    order = [F.asc("o_custkey"), F.asc("o_orderdate"), F.desc("o_totalprice"), F.asc("o_orderkey")]
    return ranking.top_k(orders, order, 10)


def dedupe_subset(spark, sf_dir):
    """The first order of each customer and priority; the other columns come from that row."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_totalprice")
    return ranking.drop_repeats(orders, ["o_custkey", "o_orderpriority"], [F.asc("o_orderkey")])


QUERIES = {
    "silver_points": silver_points,
    "dropna_any": dropna_any,
    "fill_defaults": fill_defaults,
    "mask_filter": mask_filter,
    "null_string_cast": null_string_cast,
    "impute_mean": impute_mean,
    "column_means": column_means,
    "filename_fields": filename_fields,
    "sanitize_name": sanitize_name,
    "string_slices": string_slices,
    "assign_label": assign_label,
    "union_all": union_all,
    "zip_join": zip_join,
    "top1_per_group": top1_per_group,
    "top1_join_dim": top1_join_dim,
    "semi_join": semi_join,
    "top_n_order": top_n_order,
    "dedupe_subset": dedupe_subset,
}

_LONGEST = """longest AS (
    SELECT best.* FROM (
        SELECT max({'o_totalprice': o_totalprice, 'o_orderkey': -o_orderkey, 'o_custkey': o_custkey,
                    'o_orderpriority': o_orderpriority}) AS best
        FROM orders WHERE o_orderdate IS NOT NULL GROUP BY o_custkey) AS per_customer
    ORDER BY best DESC LIMIT 5)"""

ORACLES = {
    "silver_points": f"""WITH {_ARRIVED}
        SELECT CAST(user_id AS VARCHAR) AS id_rota, concat('', upper(event_type)) AS nome_usuario, event_id AS seq,
               value AS latitude, CAST(1.5 AS DOUBLE) AS longitude, value AS elevacao, CAST(ts AS DATE) AS data,
               {sql_hms('ts')} AS hora
        FROM arrived WHERE user_id % 10 <> 0""",
    "dropna_any": f"WITH {_ARRIVED} SELECT event_id, value, ts FROM arrived WHERE value IS NOT NULL AND ts IS NOT NULL",
    "fill_defaults": f"""WITH {_ARRIVED}
        SELECT event_id, coalesce(CAST(CAST(ts AS DATE) AS VARCHAR), '1900-01-01') AS data,
               coalesce({sql_hms('ts')}, '00:00:00') AS hora FROM arrived""",
    "mask_filter": f"""WITH {_ARRIVED} SELECT event_id, user_id, event_type, value, ts FROM arrived
        WHERE ts IS NOT NULL AND value IS NOT NULL AND event_type = 'click' AND user_id = 8""",
    "null_string_cast": f"WITH {_ARRIVED} SELECT event_id, value, CAST(ts AS DATE) AS data FROM arrived",
    "impute_mean": f"""WITH {_ARRIVED}, means AS (
            SELECT event_type, {sql_mean('value')} AS m FROM arrived GROUP BY event_type)
        SELECT event_id, event_type, {sql_round('coalesce(value, m)')} AS value
        FROM arrived JOIN means USING (event_type)""",
    "column_means": f"""WITH {_ARRIVED}
        SELECT {sql_round(sql_mean('value'))} AS mean_value, {sql_round(sql_mean('user_id'))} AS mean_user_id
        FROM arrived""",
    "filename_fields": """SELECT c_custkey,
               CASE WHEN c_custkey % 5 <> 4 THEN CAST(c_custkey AS VARCHAR) END AS id_rota,
               CASE c_custkey % 5 WHEN 0 THEN c_mktsegment WHEN 2 THEN c_mktsegment || 'B'
                                  WHEN 3 THEN c_mktsegment END AS nome_usuario,
               CASE c_custkey % 5 WHEN 0 THEN 'routes' WHEN 1 THEN c_mktsegment WHEN 2 THEN c_mktsegment
                                  WHEN 3 THEN c_mktsegment END AS nome_ou_rota
        FROM customer""",
    "sanitize_name": r"""SELECT p_partkey,
               regexp_replace(p_name || '.(' || p_brand || ')', '\s|\.|\(|\)', '_', 'g') AS nome FROM part""",
    "string_slices": """SELECT c_custkey, right(c_name, 2) AS last_two,
               left(c_name, length(c_name) - 3) AS without_last_three, c_name AS trimmed,
               ends_with(c_name, '7') AS ends_with, replace(c_name, 'Customer#', '') AS replaced,
               split_part(c_name, '#', 2) AS second_part, concat_ws('#', c_name, c_mktsegment) AS joined
        FROM customer""",
    "assign_label": f"SELECT event_id, {sql_label('event_id')} AS nome_usuario FROM events",
    "union_all": """SELECT c_custkey AS key, c_name AS name, c_mktsegment, CAST(NULL AS DOUBLE) AS s_acctbal FROM customer
        UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier""",
    "zip_join": """SELECT position, s_suppkey, s_name, c_custkey, c_name
        FROM (SELECT *, row_number() OVER (ORDER BY s_name, s_suppkey) AS position FROM supplier) AS a
        JOIN (SELECT *, row_number() OVER (ORDER BY c_name DESC, c_custkey DESC) AS position FROM customer) AS b
        USING (position)""",
    "top1_per_group": f"WITH {_LONGEST} SELECT * REPLACE (-o_orderkey AS o_orderkey) FROM longest",
    "top1_join_dim": f"""WITH {_LONGEST} SELECT l.* REPLACE (-o_orderkey AS o_orderkey), c_name, c_mktsegment
        FROM longest AS l JOIN customer ON c_custkey = o_custkey""",
    "semi_join": f"""WITH {_LONGEST} SELECT l_orderkey, l_linenumber, l_partkey, l_quantity
        FROM lineitem WHERE l_orderkey IN (SELECT -o_orderkey FROM longest)""",
    "dedupe_subset": """SELECT min(o_orderkey) AS o_orderkey, o_custkey, o_orderpriority,
               arg_min(o_totalprice, o_orderkey) AS o_totalprice FROM orders GROUP BY o_custkey, o_orderpriority""",
    "top_n_order": """SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice FROM orders
        ORDER BY o_custkey, o_orderdate, o_totalprice DESC, o_orderkey LIMIT 10""",
}
