"""Scaling, clustering, regression and group statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from odolake.functions.numbers import half_up
from odolake.operators import clustering, models, summary
from odolake.plans import costs
from odolake.queries import standins
from odolake.queries.standins import COSTS, rounded, sql_mean, sql_round, table
from odolake.session import checkpoint


def standardize(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", F.col("o_custkey").cast("double").alias("o_custkey"))
    scaled = models.standardize(orders, ["o_totalprice", "o_custkey"])
    return rounded(scaled, ["o_totalprice_std", "o_custkey_std"]).drop("o_totalprice", "o_custkey")


TRIP_FEATURES = ["dist_km", "media_consumo_km_l"]
COST_FEATURES = ["dist_km", "tipo_combustivel", "custo_trajeto"]


def _cluster_input(spark, sf_dir):
    return checkpoint(costs.cluster_input(standins.trip_cost(spark, sf_dir)))


def kmeans_fit(spark, sf_dir):
    """K-means on distance and economy of all gasoline trips, best cluster marked."""
    trips = _cluster_input(spark, sf_dir)
    found = clustering.fit_kmeans(trips, TRIP_FEATURES).transform(trips)
    ranked = models.rank_clusters(found, "cluster", "media_consumo_km_l")
    return rounded(ranked, ["media_consumo_km_l", "custo_trajeto"])


def kmeans_fit_cost(spark, sf_dir):
    """The other feature set: distance, fuel code and cost; trips without a cost are skipped."""
    trips = _cluster_input(spark, sf_dir)
    found = clustering.fit_kmeans(trips, COST_FEATURES, seed=1).transform(trips)
    return rounded(found, ["media_consumo_km_l", "custo_trajeto"])


def kmeans_certificate(spark, sf_dir):
    """What makes both fits right: every trip is in its nearest cluster, and every centroid is its trips' mean."""
    trips = _cluster_input(spark, sf_dir)
    fits = [clustering.fit_kmeans(trips, TRIP_FEATURES), clustering.fit_kmeans(trips, COST_FEATURES, seed=1)]
    first, second = [fit.certificate(trips).withColumn("fit", F.lit(i)) for i, fit in enumerate(fits)]
    return first.union(second)


def one_hot(spark, sf_dir):
    return models.one_hot(table(spark, sf_dir, "part").select("p_partkey", "p_type"), "p_type")


def one_hot_rows(spark, sf_dir):
    """The same encoding as rows, for any number of categories: here one per brand."""
    return models.one_hot_rows(table(spark, sf_dir, "part"), ["p_partkey"], "p_brand")


def holdout_split(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    train = models.holdout(F.col("l_orderkey"), F.col("l_linenumber"))
    return lines.groupBy("l_returnflag", train.alias("is_train")).agg(
        F.count(F.lit(1)).alias("n"), F.min("l_orderkey").alias("first_key"), F.max("l_orderkey").alias("last_key")
    )


def _lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_returnflag",
        "l_quantity",
        (F.col("l_extendedprice") / F.lit(1000.0)).alias("price"),
        models.holdout(F.col("l_orderkey"), F.col("l_linenumber")).alias("is_train"),
    )


def linreg_simple(spark, sf_dir):
    return rounded(models.simple_regression(_lines(spark, sf_dir), "price", "l_quantity"), ["slope", "intercept"])


def _litre_model(spark, sf_dir):
    """Litres per trip from distance and vehicle, on the training rows."""
    trips = standins.trip_cost(spark, sf_dir).select("id_unico", "data_rota", "nome_usuario", "dist_km", "litros")
    user = F.split_part("id_unico", F.lit("__"), F.lit(1)).cast("bigint")
    day = F.date_diff("data_rota", F.lit("2024-01-01").cast("date"))
    train = trips.where(models.holdout(user, day))
    return models.factor_regression(train, "litros", "dist_km", "nome_usuario")


def linreg_onehot(spark, sf_dir):
    return rounded(_litre_model(spark, sf_dir), ["coefficient", "coefficient_abs"], 4)


def coef_rank(spark, sf_dir):
    ranked = models.rank_coefficients(_litre_model(spark, sf_dir), digits=4)
    return ranked.select("variable", "coefficient_text")


def mae_mse(spark, sf_dir):
    """Errors on the held-out rows of a model fitted on the others."""
    lines = _lines(spark, sf_dir)
    fitted = models.factor_regression(lines.where("is_train"), "price", "l_quantity", "l_returnflag")
    test = models.factor_predictions(lines.where("NOT is_train"), fitted, "l_quantity", "l_returnflag")
    return rounded(models.regression_errors(test, "price", "predicted"), ["mae", "mse"])


def group_describe(spark, sf_dir):
    found = summary.group_describe(
        table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice"), "l_returnflag", "l_extendedprice"
    )
    return rounded(found, ["mean", "std", "p25", "p50", "p75"], 4)


CENTROIDS = [[50000.0], [200000.0], [400000.0]]


def _order_clusters(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    return models.assign_cluster(orders, ["o_totalprice"], CENTROIDS)


def cluster_mean(spark, sf_dir):
    return rounded(summary.group_mean(_order_clusters(spark, sf_dir), "cluster", "o_totalprice"), ["mean_value"], 4)


def above_group_mean(spark, sf_dir):
    return summary.above_group_mean(_order_clusters(spark, sf_dir), "cluster", "o_totalprice")


QUERIES = {
    "standardize": standardize,
    "kmeans_fit": kmeans_fit,
    "kmeans_fit_cost": kmeans_fit_cost,
    "kmeans_certificate": kmeans_certificate,
    "one_hot": one_hot,
    "one_hot_rows": one_hot_rows,
    "holdout_split": holdout_split,
    "linreg_simple": linreg_simple,
    "linreg_onehot": linreg_onehot,
    "coef_rank": coef_rank,
    "mae_mse": mae_mse,
    "group_describe": group_describe,
    "cluster_mean": cluster_mean,
    "above_group_mean": above_group_mean,
}

_TRIPS = f"""{COSTS}, grouped AS (
    SELECT DISTINCT nome_usuario, 1 AS tipo_combustivel, dist_km, media_consumo_km_l, custo_trajeto
    FROM costs WHERE tipo_combustivel = 'gas')"""


def sql_kmeans(source: str, features: list[str], k: int = 3, seed: int = 0, name: str = "km") -> str:
    """CTEs of the whole fit: grid, seeds, Lloyd's steps; ``{name}`` adds ``cluster``, ``{name}_fitted`` has the centroids."""
    n, dims = name, range(len(features))
    g, x = [f"g{i}" for i in dims], [f"x{i}" for i in dims]
    gs, xs = ", ".join(g), ", ".join(x)
    known = " AND ".join(f"{f} IS NOT NULL" for f in features)
    stats = ", ".join(f"avg({f}) AS m{i}, stddev_pop({f}) AS s{i}" for i, f in enumerate(features))
    grid = ", ".join(
        f"CAST(floor(({f} - m{i}) / CASE WHEN s{i} = 0 THEN 1e0 ELSE s{i} END * 1e6 + 0.5e0) AS BIGINT) AS g{i}"
        for i, f in enumerate(features)
    )

    def gap(a: str, b: str, other: list[str] = g) -> str:
        steps = [f"CAST({a}.{p} - {b}.{q} AS DOUBLE)" for p, q in zip(g, other)]
        return " + ".join(f"{d} * {d}" for d in steps)

    def drawn(step: int) -> str:
        return f"md5(concat_ws(':', {seed}, {step}, {gs}))"

    parts = [
        f"{n}_stats AS (SELECT {stats} FROM {source} WHERE {known})",
        f"{n}_grid AS (SELECT {source}.*, {grid} FROM {source}, {n}_stats WHERE {known})",
        f"{n}_points AS MATERIALIZED (SELECT {gs}, count(*) AS n FROM {n}_grid GROUP BY ALL)",
        f"{n}_kept0 AS MATERIALIZED (SELECT {gs} FROM {n}_points ORDER BY {drawn(0)} LIMIT 1)",
    ]
    for step in range(1, clustering.ROUNDS + 1):
        own = ", ".join(f"p.{c}" for c in g)
        parts += [
            f"{n}_cost{step} AS MATERIALIZED (SELECT {own}, p.n, min({gap('p', 'c')}) AS d FROM {n}_points p, {n}_kept{step - 1} c"
            f" GROUP BY ALL)",
            f"{n}_kept{step} AS MATERIALIZED (SELECT {gs} FROM {n}_kept{step - 1} UNION SELECT {gs} FROM {n}_cost{step} WHERE"
            f" ('0x' || substr({drawn(step)}, 1, 8))::BIGINT / 4294967296e0"
            f" * (SELECT CAST(sum(CAST(d AS HUGEINT) * n) AS DOUBLE) FROM {n}_cost{step})"
            f" < {clustering.OVERSAMPLING * k}e0 * n * d)",
        ]
    last = f"{n}_kept{clustering.ROUNDS}"
    parts += [
        f"{n}_spots AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY {gs}) AS no FROM {last})",
        f"{n}_near AS (SELECT p.n, min({{'d': {gap('p', 'c')}, 'no': c.no}}).no AS no FROM {n}_points p, {n}_spots c"
        f" GROUP BY {', '.join(f'p.{c}' for c in g)}, p.n)",
        f"{n}_heavy AS MATERIALIZED (SELECT s.*, coalesce(w, 0) AS w FROM {n}_spots s"
        f" LEFT JOIN (SELECT no, sum(n) AS w FROM {n}_near GROUP BY no) USING (no))",
        f"{n}_pick1 AS MATERIALIZED (SELECT *, 1 AS turn FROM {n}_heavy ORDER BY w DESC, no LIMIT 1)",
    ]
    for turn in range(2, k + 1):
        parts.append(
            f"{n}_pick{turn} AS MATERIALIZED (SELECT * FROM {n}_pick{turn - 1} UNION ALL (SELECT h.*, {turn} FROM {n}_heavy h,"
            f" {n}_pick{turn - 1} c GROUP BY {', '.join(f'h.{c}' for c in g)}, h.no, h.w HAVING min({gap('h', 'c')}) > 0 ORDER BY h.w * min({gap('h', 'c')}) DESC, h.no LIMIT 1))"
        )
    found = ", ".join(f"'{c}': l.{c}" for c in ["c", *x, "i"])
    means = ", ".join(f"CAST(sum(n * {p}) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS y{i}" for i, p in enumerate(g))
    ys = ", ".join(f"y{i}" for i in dims)
    changed = " OR ".join(f"y{i} <> near.x{i}" for i in dims)
    own = ", ".join(f"p.{c}" for c in g)
    parts += [
        f"""{n}_lloyd(i, c, {xs}, moved) AS (
            SELECT 0, turn, {', '.join(f'CAST({c} AS DOUBLE)' for c in g)}, true FROM {n}_pick{k}
            UNION ALL
            SELECT near.i + 1, near.c, {ys}, bool_or({changed}) OVER ()
            FROM (SELECT any_value(best) AS near, {means} FROM (
                SELECT {own}, p.n, min({{'d': {gap('p', 'l', x)}, {found}}}) AS best FROM {n}_points p, {n}_lloyd l WHERE l.moved
                GROUP BY {own}, p.n) AS nearest GROUP BY best.c) AS stepped)""",
        f"{n}_fitted AS MATERIALIZED (SELECT row_number() OVER (ORDER BY {xs}) - 1 AS cluster, {xs}, moved FROM {n}_lloyd"
        f" WHERE i = (SELECT max(i) FROM {n}_lloyd))",
        f"{n}_labels AS (SELECT {own}, min({{'d': {gap('p', 'f', x)}, 'cluster': f.cluster}}).cluster AS cluster"
        f" FROM {n}_points p, {n}_fitted f GROUP BY {own})",
        f"{n} AS (SELECT * EXCLUDE ({gs}), CAST(cluster AS INTEGER) AS cluster FROM {n}_grid JOIN {n}_labels USING ({gs}))",
    ]
    return ",\n".join(parts)


def _sql_certificate(name: str, fit: int, dims: int) -> str:
    xs = [f"x{i}" for i in range(dims)]
    off = lambda f: " + ".join(f"(g{i} - {f}.x{i}) * (g{i} - {f}.x{i})" for i in range(dims))
    means = " AND ".join(f"CAST(sum(g{i}) AS DOUBLE) / CAST(count(*) AS DOUBLE) = any_value(own.x{i})" for i in range(dims))
    least = f"(SELECT min({off('o')}) FROM {name}_fitted o)"
    return f"""SELECT CAST(own.cluster AS INTEGER) AS cluster, count(*) AS n_rows,
               CAST(sum(CASE WHEN {off('own')} <= least THEN 1 ELSE 0 END) AS BIGINT) AS n_nearest, {means} AS is_mean,
               NOT any_value(own.moved) AS converged, {fit} AS fit
        FROM (SELECT *, {least} AS least FROM {name}_grid JOIN {name}_labels USING ({', '.join(x.replace('x', 'g') for x in xs)})) AS r
        JOIN {name}_fitted own ON own.cluster = r.cluster GROUP BY own.cluster"""


_FIT = sql_kmeans("grouped", TRIP_FEATURES)
_FIT_COST = sql_kmeans("grouped", COST_FEATURES, seed=1, name="kc")
_SHOWN = f"""nome_usuario, tipo_combustivel, dist_km, {sql_round('media_consumo_km_l')} AS media_consumo_km_l,
               {sql_round('custo_trajeto')} AS custo_trajeto, cluster"""

_TRAIN = "(l_orderkey * 7919 + l_linenumber) % 10 < 7"


def _factor_fit(rows: str, y: str, x: str, factor: str) -> str:
    return f"""cells AS (
        SELECT {factor} AS f, count(*) AS n, avg({x}) AS mx, avg({y}) AS my, covar_pop({x}, {y}) AS cxy,
               var_pop({x}) AS vx
        FROM {rows} GROUP BY {factor}),
    slope AS (SELECT sum(cxy * n) / sum(vx * n) AS b FROM cells),
    levels AS (SELECT f, my - b * mx AS a FROM cells, slope),
    coefs AS (
        SELECT '{x}' AS variable, b AS coefficient FROM slope
        UNION ALL SELECT '(intercept)', arg_min(a, f) FROM levels
        UNION ALL SELECT '{factor}_' || f, a - (SELECT arg_min(a, f) FROM levels) FROM levels
        WHERE f <> (SELECT min(f) FROM levels))"""


_LITRES = f"""{COSTS}, train AS (
    SELECT * FROM costs
    WHERE (CAST(split_part(id_unico, '__', 1) AS BIGINT) * 7919 + (data_rota - DATE '2024-01-01')) % 10 < 7),
{_factor_fit('train', 'litros', 'dist_km', 'nome_usuario')}"""

_CLUSTERS = """clusters AS (
    SELECT o_orderkey, o_totalprice, CASE WHEN a <= b AND a <= c THEN 0 WHEN b <= c THEN 1 ELSE 2 END AS cluster
    FROM (SELECT o_orderkey, o_totalprice, abs(o_totalprice - 5e4) AS a, abs(o_totalprice - 2e5) AS b,
                 abs(o_totalprice - 4e5) AS c FROM orders) AS o)"""

ORACLES = {
    "standardize": f"""WITH s AS (
            SELECT avg(o_totalprice) AS m1, stddev_pop(o_totalprice) AS s1, avg(o_custkey) AS m2,
                   stddev_pop(o_custkey) AS s2 FROM orders)
        SELECT o_orderkey, {sql_round('(o_totalprice - m1) / s1')} AS o_totalprice_std,
               {sql_round('(o_custkey - m2) / s2')} AS o_custkey_std FROM orders, s""",
    "kmeans_fit": f"""WITH RECURSIVE {_TRIPS}, {_FIT}
        SELECT {_SHOWN}, cluster = (SELECT cluster FROM km GROUP BY cluster ORDER BY avg(media_consumo_km_l) DESC, cluster LIMIT 1)
                   AS is_best FROM km""",
    "kmeans_fit_cost": f"WITH RECURSIVE {_TRIPS}, {_FIT_COST} SELECT {_SHOWN} FROM kc",
    "kmeans_certificate": f"""WITH RECURSIVE {_TRIPS}, {_FIT}, {_FIT_COST}
        {_sql_certificate('km', 0, 2)} UNION ALL {_sql_certificate('kc', 1, 3)}""",
    "one_hot": """SELECT p_partkey, CAST(p_type = 'LARGE' AS INTEGER) AS "p_type_LARGE",
               CAST(p_type = 'MEDIUM' AS INTEGER) AS "p_type_MEDIUM", CAST(p_type = 'PROMO' AS INTEGER) AS "p_type_PROMO",
               CAST(p_type = 'SMALL' AS INTEGER) AS "p_type_SMALL",
               CAST(p_type = 'STANDARD' AS INTEGER) AS "p_type_STANDARD" FROM part""",
    "one_hot_rows": """SELECT p_partkey, p_brand AS category, 1 AS value FROM part
        WHERE p_brand <> (SELECT min(p_brand) FROM part)""",
    "holdout_split": f"""SELECT l_returnflag, {_TRAIN} AS is_train, count(*) AS n, min(l_orderkey) AS first_key,
               max(l_orderkey) AS last_key FROM lineitem GROUP BY ALL""",
    "linreg_simple": f"""SELECT {sql_round('regr_slope(l_extendedprice / 1e3, l_quantity)')} AS slope,
               {sql_round('regr_intercept(l_extendedprice / 1e3, l_quantity)')} AS intercept FROM lineitem""",
    "linreg_onehot": f"""WITH {_LITRES} SELECT variable, {sql_round('coefficient', 4)} AS coefficient,
               {sql_round('abs(coefficient)', 4)} AS coefficient_abs FROM coefs""",
    "coef_rank": f"""WITH {_LITRES} SELECT variable, printf('%.6f', {sql_round('abs(coefficient)', 4)}) AS coefficient_text
        FROM coefs WHERE variable <> '(intercept)'""",
    "mae_mse": f"""WITH lines AS (
            SELECT l_returnflag, l_quantity, l_extendedprice / 1e3 AS price, {_TRAIN} AS is_train FROM lineitem),
        train AS (SELECT * FROM lines WHERE is_train), {_factor_fit('train', 'price', 'l_quantity', 'l_returnflag')},
        errors AS (SELECT price - (a + b * l_quantity) AS e FROM lines JOIN levels ON f = l_returnflag, slope
                   WHERE NOT is_train)
        SELECT {sql_round('avg(abs(e))')} AS mae, {sql_round('avg(e * e)')} AS mse FROM errors""",
    "group_describe": f"""SELECT l_returnflag, count(l_extendedprice) AS count,
               {sql_round(sql_mean('l_extendedprice'), 4)} AS mean, {sql_round('stddev_samp(l_extendedprice)', 4)} AS std,
               min(l_extendedprice) AS min, max(l_extendedprice) AS max,
               {sql_round('quantile_cont(l_extendedprice, 0.25)', 4)} AS p25,
               {sql_round('quantile_cont(l_extendedprice, 0.5)', 4)} AS p50,
               {sql_round('quantile_cont(l_extendedprice, 0.75)', 4)} AS p75
        FROM lineitem GROUP BY l_returnflag""",
    "cluster_mean": f"""WITH {_CLUSTERS} SELECT cluster, {sql_round(sql_mean('o_totalprice'), 4)} AS mean_value
        FROM clusters GROUP BY cluster""",
    "above_group_mean": f"""WITH {_CLUSTERS}, m AS (
            SELECT cluster, {sql_mean('o_totalprice')} AS mean_value FROM clusters GROUP BY cluster)
        SELECT clusters.* FROM clusters JOIN m USING (cluster) WHERE o_totalprice > mean_value""",
}
