import datetime
import math
import random

import pytest
from pyspark.sql import functions as F

from odolake.functions import clock, distance, markup, numbers, responses, text


def values(spark, rows, schema, *cols):
    return [tuple(r) for r in spark.createDataFrame(rows, schema).select(*cols).collect()]


def test_file_name_fields(spark):
    names = [
        ("4711__morning_loop_2_3-final__OPEL_CORSA_F__.csv",),
        ("4712__Harbour_Road.csv",),
        ("1__routes__A__B.csv",),
        ("notes.csv",),
    ]
    n = F.col("n")
    found = values(spark, names, "n string", text.trip_id(n), text.trip_user(n), text.trip_user_or_name(n))
    assert found == [
        ("4711", "OPEL_CORSA_F", "OPEL_CORSA_F"),
        ("4712", None, "Harbour_Road"),
        ("1", "AB", "A"),
        (None, None, None),
    ]


def test_sanitize(spark):
    assert values(spark, [("a b.(c)",)], "n string", text.sanitize(F.col("n"))) == [("a_b__c_",)]


def test_labels_are_stable_and_complete(spark):
    labels = spark.range(0, 390).select(text.assign_label(F.col("id")).alias("l")).distinct().count()
    assert labels == len(text.VEHICLE_LABELS) == 39


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo"])
def test_point_times(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [("not a date",), ("2024-03-29 10:00:05.250000+00:00",), ("2024-03-29T23:59:59Z",), (None,)]
        ts = clock.parse_point_time(F.col("t"))
        found = values(spark, rows, "t string", clock.date_part(ts), clock.time_text(ts))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    day = datetime.date(2024, 3, 29)
    assert found == [(None, None), (day, "10:00:05"), (day, "23:59:59"), (None, None)]


def test_durations(spark):
    rows = [
        ("2024-01-01", "2024-01-01", "09:00:00", "10:00:05"),
        ("2024-01-01", "2024-01-01", "10:00:05", "09:00:00"),
        ("2024-01-01", "2024-01-02", "23:00:00", "01:00:00"),
        ("2024-01-01", "2024-01-01", "10:00:00", "10:00:00"),
        ("2024-01-02", "2024-01-01", "10:00:00", "11:00:00"),
    ]
    d1, d2 = F.to_date("d1"), F.to_date("d2")
    t1, t2 = F.col("t1"), F.col("t2")
    found = values(
        spark,
        rows,
        "d1 string, d2 string, t1 string, t2 string",
        clock.clock_abs_seconds(t1, t2),
        clock.clock_nonzero_seconds(t1, t2),
        clock.view_seconds(d1, d2, t1, t2),
        clock.elapsed_seconds(clock.combine(d1, t1), clock.combine(d2, t2)),
    )
    assert found == [
        (3605, 3605, 3605, 3605),
        (3605, 3605, 3605, -3605),
        (79200, 79200, 79200, 7200),
        (0, None, None, 0),
        (3600, 3600, None, -82800),
    ]


def test_duration_text(spark):
    rows = [(7646.5,), (0.0,), (90061.0,)]
    assert values(spark, rows, "s double", clock.duration_text(F.col("s"))) == [("02:07:26",), ("00:00:00",), ("25:01:01",)]


def test_nan_text_is_null(spark):
    rows = [("nan", "nan"), ("1.5", "2024-01-01"), (None, "x")]
    found = values(
        spark,
        rows,
        "v string, d string",
        numbers.null_if_nan_text(F.col("v"), "double"),
        numbers.null_if_nan_text(F.col("d"), "date"),
    )
    assert found == [(None, None), (1.5, datetime.date(2024, 1, 1)), (None, None)]


def test_unit_conversion(spark):
    [(km_l,)] = values(spark, [(25.0,)], "m double", numbers.half_up(numbers.mpg_to_km_per_litre(F.col("m"))))
    assert km_l == 10.628593


def test_distances(spark):
    cols = [F.col(c) for c in ("a", "b", "c", "d")]
    [(e, m, k, h)] = values(
        spark,
        [(0.0, 0.0, 3.0, 4.0)],
        "a double, b double, c double, d double",
        distance.euclidean(*cols),
        distance.manhattan(*cols),
        distance.minkowski(*cols, p=3),
        distance.haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(180.0)),
    )
    assert (e, m) == (5000.0, 7000.0)
    assert k == pytest.approx(4497.941445, abs=1e-6)
    assert h == pytest.approx(20015.086796, abs=1e-5)


def test_route_response(spark):
    bodies = [
        ('{"routes":[{"summary":{"distance":119915.4,"duration":7646.5},"way_points":[0,9]}]}',),
        ('{"error":{"code":2010}}',),
        ('{"routes":[{"summary":{"distance":500.0}}]}',),
        ('{"routes":[]}',),
        ("no json",),
    ]
    found = values(spark, bodies, "b string", responses.route_km(F.col("b")), responses.route_seconds(F.col("b")))
    assert found[0] == pytest.approx((119.9154, 7646.5))
    assert found[1:] == [(None, None), (0.5, None), (None, None), (None, None)]


def test_address(spark):
    rows = [
        ({"county": "", "city": "X", "ISO3166-2-lvl4": "US-OR", "country_code": "us"},),
        ({"suburb": "S"},),
        ({},),
    ]
    a = F.col("a")
    found = values(
        spark,
        rows,
        "a map<string,string>",
        responses.address_city(a),
        responses.address_state(a),
        responses.address_country(a),
    )
    assert found == [("X", "US-OR", "US"), ("S", None, None), (None, None, None)]


def test_page_fields(spark):
    html = (
        '<html lang="pt"><title>T\nx</title><table><tr class="a"><td>1</td></tr><tr><td> <b>two</b> </td></tr></table>'
        '<div class="sum">s</div>'
    )
    h = F.col("h")
    [found] = values(
        spark,
        [(html,)],
        "h string",
        markup.title(h),
        markup.attribute(h, "html", "lang"),
        markup.nth_element_text(h, "tr", 2),
        markup.nth_element_text(h, "tr", 3),
        markup.nth_element_text(h, "tr", 3, "-"),
        markup.element_text_by_class(h, "div", "sum"),
        markup.element_text_by_class(h, "div", "none"),
        markup.price_text(F.lit("R$"), F.lit("10"), F.lit(None).cast("string")),
    )
    assert found == ("T\nx", "pt", "two", None, "-", "s", "", "R$ 10,00")


def test_rounding_keeps_numbers_beyond_the_range(spark):
    rows = [(1e13,), (1.2345675,), (-9e20,), (None,)]
    assert values(spark, rows, "x double", numbers.half_up(F.col("x"))) == [(1e13,), (1.234568,), (-9e20,), (None,)]


def test_class_words_quotes_and_entities(spark):
    html = [("<span class='small text-danger'>a&nbsp;&amp;&lt;b</span>",), ('<span class="text-dangerous">x</span>',)]
    h = F.col("h")
    found = values(spark, html, "h string", markup.has_class(h, "span", "text-danger"), markup.inner_text(h))
    assert found == [(True, "a &<b"), (False, "x")]


def exact(spark, values, parts=3):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
    return df.agg(numbers.exact_mean(F.col("v")).alias("m"), numbers.exact_sum(F.col("v")).alias("s")).first()


def test_exact_mean_keeps_small_and_large_values(spark):
    assert exact(spark, [4e-7, 4e-7]).m == 4e-7
    assert exact(spark, [2e12, 2e12, 2e12]).m == 2e12
    assert exact(spark, [1e20, 1.0, -1e20]).s == 1.0
    assert exact(spark, [None, 3.0]).m == 3.0 and exact(spark, [None]).m is None
    assert exact(spark, [float("inf"), 1.0]).m == float("inf") and math.isnan(exact(spark, [float("nan"), 1.0]).m)
    with pytest.raises(Exception, match="cannot be summed exactly"):
        exact(spark, [1e30])


def test_exact_mean_has_the_same_bits_for_any_partitioning(spark):
    rng = random.Random(3)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randint(-12, 15) for _ in range(3000)]
    found = {exact(spark, rng.sample(values, len(values)), parts) for parts in (1, 2, 7)}
    assert len(found) == 1
    assert found.pop().s == pytest.approx(math.fsum(values), rel=1e-15)


def test_numeric_references(spark):
    rows = [("<b>caf&#233; &#xE9;&#x20AC; &#128512;</b> &amp;#233; &#0; &#55296; &#9999999; &#x;",), (None,), ("plain",)]
    found = values(spark, rows, "t string", markup.inner_text(F.col("t")))
    assert found == [("café é€ 😀 &#233; &#0; &#55296; &#9999999; &#x;",), (None,), ("plain",)]
