import datetime

from pyspark.sql import functions as F

from odolake.plans import costs, fuel

ECONOMY = "make string, model string, fuel_type string, city_km_l double, highway_km_l double"
PRICES = "estado string, produto string, preco_medio_revenda double"
VIEW = (
    "id_unico string, nome_usuario string, data_inicio_rota date, hora_inicio_rota string, hora_fim_rota string, "
    "dist_euclidiana double"
)
RJ = "RIO DE JANEIRO"
DAY = datetime.date(2024, 1, 1)


def test_average_of_averages(spark):
    rows = [("m", "x a", "gas", 9.0, 11.0)] * 3 + [("m", "x b", "gas", 20.0, 20.0)]
    [row] = fuel.mean_economy(spark.createDataFrame(rows, ECONOMY)).collect()
    assert (row.modelo, row.media_consumo_km_l) == ("x", 15.0)


def test_equal_model_means_count_once(spark):
    rows = [("m", "x a", "gas", 10.0, 10.0), ("m", "x b", "gas", 10.0, 10.0), ("m", "x c", "gas", 40.0, 40.0)]
    [row] = fuel.mean_economy(spark.createDataFrame(rows, ECONOMY)).collect()
    assert row.media_consumo_km_l == 25.0


def prices(spark):
    rows = [
        (RJ, "GASOLINA COMUM", 5.0),
        (RJ, "GASOLINA ADITIVADA", 7.0),
        (RJ, "ETANOL HIDRATADO", 4.0),
        ("BAHIA", "GASOLINA COMUM", 99.0),
    ]
    return spark.createDataFrame(rows, PRICES)


def test_price_names(spark):
    found = {r.produto: r.preco_medio_revenda for r in fuel.mean_prices(prices(spark), RJ).collect()}
    assert found == {"gas": 6.0, "ETANOL": 4.0}
    assert fuel.mean_price_like(prices(spark), "%GAS%", RJ).collect()[0].media == 6.0


def test_cost(spark):
    view = spark.createDataFrame(
        [
            ("1__A_B", "A_B", DAY, "10:00:00", "11:00:00", 100.0),
            ("1__A_B", "A_B", DAY, "10:00:00", "11:00:00", 100.0),
            ("2__A_D", "A_D", DAY, "10:00:00", "11:00:00", 100.0),
            ("3__Q_Q", "Q_Q", DAY, "10:00:00", "11:00:00", 100.0),
            ("4__A_B", "A_B", None, "10:00:00", "11:00:00", 100.0),
        ],
        VIEW,
    )
    economy = spark.createDataFrame([("a", "b x", "gas", 10.0, 10.0), ("a", "d", "diesel", 20.0, 20.0)], ECONOMY)
    found = costs.trip_cost(view, fuel.mean_economy(economy), fuel.mean_prices(prices(spark), RJ))
    rows = {r.id_unico: (r.litros, r.preco_medio_revenda, r.custo_trajeto) for r in found.collect()}
    assert rows == {"1__A_B": (10.0, 6.0, 60.0), "2__A_D": (5.0, None, None)}
    assert found.count() == 2


CLUSTERED = "nome_usuario string, dist_km double, media_consumo_km_l double, run_id string"


def test_latest_run_or_all_runs(spark):
    rows = [("a", 10.0, 5.0, "1"), ("a", 10.0, 5.0, "2")]
    df = spark.createDataFrame(rows, CLUSTERED)
    price = spark.createDataFrame([(2.0,)], "media double")
    [every] = costs.vehicle_totals(df, price).collect()
    [latest] = costs.vehicle_totals(df, price, all_runs=False, run="run_id").collect()
    assert (every.dist_km, every.custo_viagem) == (20.0, 8.0)
    assert (latest.dist_km, latest.custo_viagem) == (10.0, 4.0)


def test_swap_pairs_lists_of_unequal_length(spark):
    schema = "nome_usuario string, media_consumo_km_l double, dist_km double, custo_viagem double"
    worst = spark.createDataFrame([(f"w{i}", 5.0 + i, 100.0, 50.0) for i in range(5)], schema)
    best = spark.createDataFrame([(f"b{i}", 30.0 - i, 10.0, 5.0) for i in range(3)], schema)
    price = spark.createDataFrame([(6.0,)], "media double")
    rows = costs.swap_simulation(worst, best, price).orderBy("rank").collect()
    assert [r.nome_usuario_original for r in rows] == ["w0", "w1", "w2", "w3", "w4"]
    assert [r.nome_usuario_simulado for r in rows] == ["b0", "b1", "b2", None, None]
    assert rows[0].custo_viagem_simulado == 20.0 and rows[3].custo_viagem_simulado is None


def test_trip_view_types_the_text(spark):
    road = spark.createDataFrame(
        [("1__A", "A", "nan", "2024-01-02", "10:00:00", "11:00:00", "nan"), ("2__A", "A", "2024-01-01", "2024-01-01", "nan", "11:00:00", "1.5")],
        "id_unico string, nome_usuario string, data_inicio_rota string, data_fim_rota string, inicio_rota string, "
        "fim_rota string, distancia_real_km_api string",
    )
    metric = spark.createDataFrame(
        [("1", "A", 1.0, 2.0, 3.0), ("2", "A", 1.0, 2.0, 3.0), ("9", "A", 1.0, 2.0, 3.0)],
        "id_rota string, nome_usuario string, dist_euclidiana double, dist_manhattan double, dist_minkowski double",
    )
    rows = {r.id_unico: r for r in costs.trip_view(road, metric).collect()}
    assert set(rows) == {"1__A", "2__A"}
    assert rows["1__A"].data_inicio_rota is None and rows["1__A"].distancia_real_km_api is None
    assert rows["2__A"].hora_inicio_rota is None and rows["2__A"].duracao_viagem is None


def test_cluster_input_is_distinct(spark):
    df = spark.createDataFrame(
        [("a", "gas", 1.0, 2.0, 3.0)] * 2 + [("a", "diesel", 1.0, 2.0, 3.0)],
        "nome_usuario string, tipo_combustivel string, dist_km double, media_consumo_km_l double, custo_trajeto double",
    )
    assert costs.cluster_input(df).count() == 1
    assert costs.cluster_input(df).select(F.max("tipo_combustivel")).collect()[0][0] == 1
