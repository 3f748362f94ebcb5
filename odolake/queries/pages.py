"""Stored web pages and stored JSON responses."""

from __future__ import annotations

from pyspark.sql import functions as F

from odolake.functions import markup, responses as fields
from odolake.queries.standins import sql_round, table
from odolake.sources import pages as html
from odolake.sources import responses as stored

_PREFIX = "https://www.example.org"


def html_links(spark, sf_dir):
    """Every list entry with a link; an entry counts as pending when its link starts with a capital."""
    pages = table(spark, sf_dir, "pages").select("page_id", "html")
    pending = F.col("fragment").rlike('href="/[A-Z]')
    return html.link_rows(pages, ["page_id"], _PREFIX, tag="li", pending=pending)


def html_pending(spark, sf_dir):
    """Trace-list rows: entries become table rows, and those whose link starts with a capital get the pending mark."""
    rows = F.regexp_replace("html", r"<(/?)li(?=[\s>])", "<$1tr")
    marked = F.regexp_replace(rows, r'(<tr(?:\s[^>]*)?>)(<a href="/[A-Z])', "$1<span class='small text-danger'>pending</span>$2")
    pages = table(spark, sf_dir, "pages").select("page_id", marked.alias("html"))
    return html.link_rows(pages, ["page_id"], _PREFIX)


def html_title(spark, sf_dir):
    page = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id", markup.title(page).alias("title"), markup.attribute(page, "html", "lang").alias("lang")
    )


def html_optional_field(spark, sf_dir):
    """Headline, optional sixth menu entry, optional campaign source, notice box, price-like text."""
    page = F.col("html")
    cents = F.nullif(F.regexp_extract("url", r"utm_source=(\w+)", 1), F.lit(""))
    return table(spark, sf_dir, "pages").select(
        "page_id",
        markup.nth_element_text(page, "h1", 1, "").alias("headline"),
        markup.nth_element_text(page, "li", 6, "").alias("sixth_entry"),
        markup.element_text_by_class(page, "div", "ad").alias("notice"),
        markup.element_text_by_class(page, "div", "missing", "none").alias("missing"),
        markup.price_text(F.lit("R$"), F.col("page_id").cast("string"), cents).alias("price"),
    )


def html_field_by_state(spark, sf_dir):
    page = F.col("html")
    pending = markup.attribute(page, "html", "lang") == "en"
    return table(spark, sf_dir, "pages").select(
        "page_id", html.field_by_state(page, pending, tag="li", pending_row=2, done_row=4).alias("field")
    )


# --- JSON -----------------------------------------------------------------------------------------


def _routes(spark, sf_dir):
    """Road responses of orders: every 7th is an error text, every 5th has no duration."""
    key = F.col("o_orderkey")
    duration = F.when(key % 5 != 0, (key % 9000).cast("double"))
    summary = F.struct(F.col("o_totalprice").alias("distance"), duration.alias("duration"))
    body = F.to_json(F.struct(F.array(F.struct(summary.alias("summary"))).alias("routes")))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(key % 21 == 0, 429).otherwise(200).alias("status"),
        F.when(key % 7 == 0, F.lit('{"error": {"code": 2010}}')).otherwise(body).alias("body"),
    )


def route_response_km(spark, sf_dir):
    found = stored.with_route(stored.route_distances(stored.accepted(_routes(spark, sf_dir))))
    return found.select("o_orderkey", "distancia_real_km_api", "duracao_s")


def response_rejects(spark, sf_dir):
    """Refused requests and accepted ones without a route."""
    routes = _routes(spark, sf_dir)
    refused = stored.refused(routes).select("o_orderkey", "status", F.lit("status").alias("reason"))
    empty = stored.route_rejects(stored.route_distances(stored.accepted(routes)))
    return refused.unionByName(empty.select("o_orderkey", "status", F.lit("no route").alias("reason")))


def json_array_rows(spark, sf_dir):
    """Vehicle rows out of one stored JSON array per distinct (make, model)."""
    part = table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("marca"), F.col("p_name").alias("modelo"), "p_size", "p_retailprice"
    )
    keys = part.select("marca", "modelo").distinct()
    facts = part.groupBy("marca", "modelo").agg(F.min("p_size").alias("lo"), F.max("p_retailprice").alias("hi"))

    def vehicle(fuel: str, city, highway):
        return F.struct(
            F.lower("marca").alias("make"),
            F.col("modelo").alias("model"),
            F.lit(fuel).alias("fuel_type"),
            city.alias("city_mpg"),
            highway.alias("highway_mpg"),
        )

    body = F.to_json(
        F.array(
            vehicle("gas", F.col("lo").cast("double"), F.col("hi")),
            vehicle("diesel", F.col("lo") + F.lit(1.0), F.col("hi") + F.lit(1.0)),
        )
    )
    responses = facts.select("marca", "modelo", F.lit(200).alias("status"), body.alias("body"))
    rows = stored.vehicle_rows(keys, responses, ["marca", "modelo"])
    return rows.select("marca", "modelo", "make", "model", "fuel_type", "city_mpg", "highway_mpg")


def address_fallback(spark, sf_dir):
    """City by county, city, suburb; empty values are skipped like missing ones."""
    key = F.col("c_custkey")
    entry = lambda name, value: F.struct(F.lit(name).alias("key"), value.alias("value"))
    address = F.map_from_entries(
        F.array_compact(
            F.array(
                F.when(key % 3 == 0, entry("county", F.when(key % 2 == 0, F.lit("")).otherwise(F.col("c_name")))),
                F.when(key % 4 != 0, entry("city", F.col("c_mktsegment"))),
                F.when(key % 5 == 0, entry("suburb", F.lit("centre"))),
                entry("ISO3166-2-lvl4", F.concat(F.lit("BR-N"), F.col("c_nationkey"))),
                entry("country_code", F.lower("c_mktsegment")),
            )
        )
    )
    body = F.from_json(F.to_json(address), fields.ADDRESS_SCHEMA)
    state = fields.address_state(F.col("address"))
    return table(spark, sf_dir, "customer").select("c_custkey", body.alias("address")).select(
        "c_custkey",
        fields.address_city(F.col("address")).alias("cidade"),
        state.alias("estado"),
        F.split_part(state, F.lit("-"), F.lit(2)).alias("uf"),
        fields.address_country(F.col("address")).alias("pais"),
    )


def _features(spark, sf_dir):
    """One feature response per conversation turn: named, unnamed and untagged features."""
    role = F.col("role")
    tags = lambda *pairs: F.create_map(*[F.lit(p) if isinstance(p, str) else p for p in pairs])
    named = F.struct(tags("name", F.concat(role, F.lit(" "), (F.col("conv_id") % 20).cast("string"))).alias("tags"))
    unnamed = F.struct(tags("highway", "path").alias("tags"))
    bare = F.struct(F.lit(None).cast("map<string,string>").alias("tags"))
    body = F.to_json(F.struct(F.array(named, unnamed, bare, named).alias("elements")))
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", body.alias("body"))


def names_all(spark, sf_dir):
    return stored.feature_names(_features(spark, sf_dir), ["conv_id", "turn"])


def names_first_seen(spark, sf_dir):
    return stored.first_seen_names(names_all(spark, sf_dir), ["conv_id", "turn", "pos"])


QUERIES = {
    "html_links": html_links,
    "html_pending": html_pending,
    "html_title": html_title,
    "html_optional_field": html_optional_field,
    "html_field_by_state": html_field_by_state,
    "route_response_km": route_response_km,
    "response_rejects": response_rejects,
    "json_array_rows": json_array_rows,
    "address_fallback": address_fallback,
    "names_all": names_all,
    "names_first_seen": names_first_seen,
}

_LI = "regexp_extract_all(html, '(?s)<li(?:\\s[^>]*)?>(.*?)</li>', 1)"


def _PLAIN(fragment: str) -> str:
    """Text of an element: without tags, with its entities decoded (the ampersand last)."""
    text = f"regexp_replace({fragment}, '<[^>]*>', '', 'g')"
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&amp;", "&")):
        text = f"replace({text}, '{entity}', '{sign}')"
    return f"trim({text}, ' ')"


_NAMES = """names AS (
    SELECT conv_id, turn, pos, CASE WHEN pos = 1 THEN 'Unnamed' ELSE role || ' ' || CAST(conv_id % 20 AS VARCHAR) END AS name
    FROM conversations, (VALUES (0), (1), (3)) AS p(pos))"""

ORACLES = {
    "html_links": f"""WITH f AS (
            SELECT page_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS fragment
            FROM (SELECT page_id, {_LI} AS l FROM pages) AS p),
        h AS (SELECT *, regexp_extract(fragment, '<a\\s[^>]*?href="([^"]*)"', 1) AS href FROM f)
        SELECT page_id, CAST(pos AS INTEGER) AS pos, '{_PREFIX}' || href AS url,
               regexp_matches(fragment, 'href="/[A-Z]') AS pending
        FROM h WHERE href <> ''""",
    "html_pending": f"""SELECT page_id, CAST(generate_subscripts(l, 1) - 1 AS INTEGER) AS pos,
               '{_PREFIX}' || unnest(regexp_extract_all(html, '<li(?:\\s[^>]*)?><a href="([^"]*)"', 1)) AS url,
               unnest(list_transform(l, lambda x: regexp_matches(x, 'href="/[A-Z]'))) AS pending
        FROM (SELECT page_id, html, {_LI} AS l FROM pages) AS p""",
    "html_title": """SELECT page_id, nullif(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), '') AS title,
               nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang FROM pages""",
    "html_optional_field": f"""SELECT page_id,
               coalesce({_PLAIN("regexp_extract_all(html, '(?s)<h1>(.*?)</h1>', 1)[1]")}, '') AS headline,
               coalesce({_PLAIN(f'{_LI}[6]')}, '') AS sixth_entry,
               {_PLAIN("regexp_extract(html, '(?s)<div class=" + '"ad"' + ">(.*?)</div>', 1)")} AS notice,
               'none' AS missing,
               'R$ ' || CAST(page_id AS VARCHAR) || ',' ||
                   coalesce(nullif(regexp_extract(url, 'utm_source=(\\w+)', 1), ''), '00') AS price
        FROM pages""",
    "html_field_by_state": f"""SELECT page_id,
               {_PLAIN(f"{_LI}[CASE WHEN regexp_matches(html, '<html lang=" + '"en"' + "') THEN 2 ELSE 4 END]")} AS field
        FROM pages""",
    "route_response_km": """SELECT o_orderkey, o_totalprice / 1e3 AS distancia_real_km_api,
               CASE WHEN o_orderkey % 5 <> 0 THEN CAST(o_orderkey % 9000 AS DOUBLE) END AS duracao_s
        FROM orders WHERE o_orderkey % 7 <> 0""",
    "response_rejects": """SELECT o_orderkey, CASE WHEN o_orderkey % 21 = 0 THEN 429 ELSE 200 END AS status,
               CASE WHEN o_orderkey % 21 = 0 THEN 'status' ELSE 'no route' END AS reason
        FROM orders WHERE o_orderkey % 7 = 0""",
    "json_array_rows": """WITH v AS (
            SELECT p_brand AS marca, p_name AS modelo, min(p_size) AS lo, max(p_retailprice) AS hi
            FROM part GROUP BY p_brand, p_name)
        SELECT marca, modelo, lower(marca) AS make, modelo AS model, f AS fuel_type, lo + n AS city_mpg,
               hi + n AS highway_mpg
        FROM v, (VALUES ('gas', CAST(0 AS DOUBLE)), ('diesel', CAST(1 AS DOUBLE))) AS t(f, n)""",
    "address_fallback": """SELECT c_custkey,
               CASE WHEN c_custkey % 3 = 0 AND c_custkey % 2 <> 0 THEN c_name
                    WHEN c_custkey % 4 <> 0 THEN c_mktsegment WHEN c_custkey % 5 = 0 THEN 'centre' END AS cidade,
               'BR-N' || CAST(c_nationkey AS VARCHAR) AS estado, 'N' || CAST(c_nationkey AS VARCHAR) AS uf,
               c_mktsegment AS pais
        FROM customer""",
    "names_all": f"WITH {_NAMES} SELECT * FROM names",
    "names_first_seen": f"""WITH {_NAMES} SELECT name, conv_id, turn, pos
        FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY conv_id, turn, pos) AS n FROM names) AS r
        WHERE n = 1""",
}
