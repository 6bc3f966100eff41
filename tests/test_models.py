"""Calendars, percentiles, ranks, forecasts and similarity on literal rows and brute force."""

import random
from datetime import date
from decimal import Decimal

import numpy as np
import pytest
from helpers import rows
from pyspark.sql import functions as F

from tillstar.operators import calendar, eda, forecast, metrics, ranking, similarity, star
from tillstar.operators.quantiles import exact_percentiles


def test_gap_days_are_zero_rows_and_count_in_the_mean(spark):
    sales = spark.createDataFrame(
        [(date(2024, 1, 1), Decimal("10")), (date(2024, 1, 8), Decimal("30")), (date(2024, 1, 8), Decimal("5")),
         (date(2024, 1, 16), Decimal("7"))], "d date, v decimal(18,2)")
    dense = calendar.dense_daily(sales, "d", "v")
    assert dense.count() == 16
    assert dense.filter("dia_sem_venda").count() == 13
    monday = [r for r in calendar.weekday_comparison(dense).collect() if r["n"] == 1][0]
    assert (monday["dias_calendario"], monday["dias_com_venda"]) == (3, 2)
    assert (monday["media_com_calendario"], monday["media_sem_calendario"]) == (Decimal("15.00"), Decimal("22.50"))
    driven = calendar.fill_calendar(
        calendar.date_series(calendar.date_bounds((sales, "d"))), calendar.daily_sales(sales, "d", "v"))
    assert rows(driven) == rows(dense)


def test_no_sales_give_no_days(spark):
    empty = spark.createDataFrame([], "d date, v decimal(18,2)")
    assert calendar.dense_daily(empty, "d", "v").count() == 0


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [5.0] * 100 + [9.0], [float(x) for x in range(1000)],
    [random.Random(7).gauss(0, 100) for _ in range(3001)], [1e12, -1e12, 0.0, 0.0, 3.5],
    [1.7e308, -1.7e308, 1.0, 1.0 + 2**-52, 1.0 + 2**-51, 5e-324, 0.0], [0.1] * 500 + [10.0**k for k in range(-300, 300, 3)],
])
def test_percentiles_are_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    got = exact_percentiles(df, "v", {"a": 0.25, "b": 0.5, "c": 0.75, "d": 0.0, "e": 1.0, "f": 0.987}).first()
    want = np.percentile(values, [25, 50, 75, 0, 100, 98.7])
    assert np.allclose(list(got), want, rtol=1e-12)


def test_percentiles_count_no_missing_values(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (4.0,), (8.0,)], "v double")
    assert exact_percentiles(df, "v", {"m": 0.5}).first()["m"] == 6.0
    assert exact_percentiles(df.filter("v is null"), "v", {"m": 0.5}).first()["m"] is None


def test_tukey_of_an_empty_table_is_null(spark):
    row = eda.tukey(spark.createDataFrame([], "v decimal(18,2)"), "v").first()
    assert row["q1"] is None and row["acima_da_cerca"] == 0


def test_ties_share_a_rank_and_all_stay(spark):
    df = spark.createDataFrame([("a", 9), ("b", 7), ("c", 7), ("d", 7), ("e", 1), ("f", None)], "k string, v int")
    got = rows(ranking.competition_rank(df, "v", 2), "k", "position")
    assert got == [("a", 1), ("b", 2), ("c", 2), ("d", 2)]


def test_global_positions_match_a_sort(spark):
    values = [random.Random(3).randrange(50) for _ in range(500)]
    df = spark.createDataFrame(list(enumerate(values)), "id int, v int").repartition(7)
    got = {r["id"]: r["position"] for r in ranking.number_all_rows(df, [F.desc("v"), F.asc("id")]).collect()}
    order = sorted(range(500), key=lambda i: (-values[i], i))
    assert [got[i] for i in order] == list(range(1, 501))


SERIES = {(2023, m): 10 * m for m in range(1, 13)} | {(2024, m): 10.0 + m for m in range(1, 10)} | {
    (2024, 11): 60.0, (2025, 1): 80.0, (2025, 2): 40.0, (2025, 3): 87.0}  # no sale in October and December 2024


def _dense(spark):
    items = spark.createDataFrame([(1, date(y, m, 1), int(u)) for (y, m), u in SERIES.items()],
                                  "product_id int, mes date, quantidade int")
    ids = spark.createDataFrame([(1,)], "product_id int")
    first = items.agg(F.min("mes").alias("first_month"))
    return items, ids, first, forecast.dense_months(forecast.monthly_units(items, ids), first, date(2025, 3, 1))


def test_forecasts_use_dense_training_months_only(spark):
    _, _, _, dense = _dense(spark)
    out = forecast.with_forecasts(dense, date(2024, 12, 1))
    test = rows(out.filter("not eh_treino"), "mes", "unidades", "moving_average", "seasonal_naive", "naive")
    assert [t[2:] for t in test] == [(20.0, 11.0, 0.0), (20.0, 12.0, 0.0), (20.0, 13.0, 0.0)]
    assert out.filter("eh_treino").count() == 24
    assert out.filter("eh_treino and moving_average is not null").count() == 0
    best = {r["modelo"]: r["melhor"] for r in forecast.model_errors(out).collect()}
    assert best == {"moving_average": True, "seasonal_naive": False, "naive": False}
    totals = forecast.error_totals(out).first()
    assert (totals["soma_prevista"], totals["soma_real"]) == (60.0, 207.0)


def test_sum_is_rounded_once_half_to_even(spark):
    rows_ = [(date(2025, m, 1), 0.0, False, v) for m, v in ((1, 38.5), (2, 38.5), (3, 39.5))]
    out = spark.createDataFrame(rows_, "mes date, unidades double, eh_treino boolean, moving_average double")
    row = forecast.error_totals(out).first()
    assert (row["soma_arredondada"], row["soma_dos_arredondados"]) == (116, 116)


def test_scenarios_cover_each_id_and_all(spark):
    items = spark.createDataFrame(
        [(1, date(2024, 1, 1), 3), (2, date(2024, 2, 1), 5), (1, date(2024, 3, 1), 4), (3, date(2024, 1, 1), 100)],
        "product_id int, mes date, quantidade int")
    ids = spark.createDataFrame([(1,), (2,), (9,)], "product_id int")
    out = forecast.by_scenario(items, ids, items.agg(F.min("mes").alias("m")), date(2024, 2, 1), date(2024, 3, 1), window=2)
    assert rows(out) == [("1", 1.5, 2, 4.0, 2.5), ("2", 2.5, 2, 0.0, 2.5), ("9", 0.0, 0, 0.0, 0.0), ("all", 4.0, 4, 4.0, 0.0)]


def _purchases(spark, seed=5, customers=60, items=30, n=500):
    r = random.Random(seed)
    data = {(r.randrange(customers), min(r.randrange(items), r.randrange(items))) for _ in range(n)}
    data |= {(0, i) for i in range(items)}  # one customer bought everything
    return sorted(data), spark.createDataFrame(sorted(data), "customer_id long, item long")


def _brute(data):
    c, i = max(x for x, _ in data) + 1, max(y for _, y in data) + 1
    m = np.zeros((c, i))
    for x, y in data:
        m[x, y] = 1
    norms = np.linalg.norm(m, axis=0)
    norms[norms == 0] = 1
    return (m / norms).T @ (m / norms)


def test_similarity_to_one_item_is_the_matrix_row(spark):
    data, pairs = _purchases(spark)
    want = _brute(data)
    for r in similarity.similar_to(pairs, 3).collect():
        assert abs(r["similaridade"] - want[3, r["item"]]) < 1e-12
    assert similarity.similar_to(pairs, 3).count() == len({i for _, i in data}) - 1


def test_cosine_rows_are_rows_of_the_matrix(spark):
    data, pairs = _purchases(spark)
    want = _brute(data)
    references = spark.createDataFrame([(3,), (7,), (3,), (999,)], "item long")
    got = similarity.cosine_rows(pairs, references)
    cells = {(r["reference"], r["item"]): r["similaridade"] for r in got.collect()}
    assert set(cells) == {(i, j) for i in (3, 7) for j in range(want.shape[1]) if want[i, j]}
    assert all(abs(v - want[i, j]) < 1e-12 for (i, j), v in cells.items())
    assert tuple(similarity.cosine_checks(got, references, pairs).first()) == (len(cells), 0, 0, 0, 0)
    wrong = got.withColumn("similaridade", F.when(F.col("reference") == 3, F.col("similaridade") + 0.5).otherwise(F.col("similaridade")))
    bad = similarity.cosine_checks(wrong.filter("not (reference = 7 and item = 7)"), references, pairs).first()
    assert bad["diagonal_diferente_de_1"] == 1 and bad["referencias_sem_diagonal"] == 1 and bad["assimetricas"] == 2 and bad["fora_do_intervalo"] > 0


def test_equal_similarity_goes_to_the_smaller_id_and_absent_reference_gives_no_row(spark):
    bought = spark.createDataFrame(
        [(1, 10, "paid"), (1, 20, "paid"), (1, 30, "paid"), (2, 20, "draft"), (2, 30, "draft")],
        "customer_id long, product_id long, status string")
    out = similarity.top_by_subset(bought, 10, {"all": F.lit(True), "drafts": F.col("status") == "draft"})
    assert rows(out, "recorte", "product_id") == [("all", 20)]


def test_unrelated_dimensions_are_refused(spark):
    facts = {
        "fct_devolucao": spark.createDataFrame([(1, 1)], "product_id int, quantidade int"),
        "fct_pagamento": spark.createDataFrame([(1,)], "order_id int"),
        "dim_cliente": spark.createDataFrame([(1, "x")], "customer_id int, cliente string"),
        "dim_produto": spark.createDataFrame([(1, "p")], "product_id int, produto string"),
    }
    assert rows(metrics.metric(facts, "returned_items", ["dim_produto.produto"])) == [("p", 1)]
    with pytest.raises(star.UnrelatedError):
        metrics.metric(facts, "returned_items", filters={"dim_cliente.cliente": ["x"]})
    with pytest.raises(star.UnrelatedError):
        star.join_dims(facts, "fct_pagamento", ["dim_produto"])


def test_cancellation_rate_ignores_status_filters_and_refuses_status_groups(spark):
    facts = {
        "fct_pedido": spark.createDataFrame([(1, "paid"), (2, "cancelled"), (3, "paid"), (4, "draft")], "order_id int, status string"),
        "dim_status_pedido": star.dim_status(spark),
    }
    rate = metrics.metric(facts, ["cancellation_rate", "orders"], filters={"dim_status_pedido.status": ["paid"]})
    assert rows(rate) == [(0.25, 2)]
    with pytest.raises(star.UnrelatedError):
        metrics.metric(facts, "cancellation_rate", ["dim_status_pedido.status"])
