"""Demand forecasts and item similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstar.functions.text import SUSPICIOUS_NAMES
from tillstar.operators import forecast, ranking, similarity
from tillstar.plans.oracle_base import over_ctes, texts
from tillstar.plans.registry import REFERENCE_NAME, TARGET_NAME, TEST_END, TRAIN_END, Context, query

# The two model facts in SQL: a dense monthly series with three forecasts, and similarities.
MODEL_CTES = f"""
m_items AS (
  SELECT i.order_id, i.product_variant_id, v.product_id, p.name AS produto, p.brand_id, p.category_id,
         o.customer_id, o.status, o.channel, i.quantity AS quantidade, i.unit_price, i.line_total,
         o.created_at AS data_pedido, CAST(date_trunc('month', o.created_at) AS DATE) AS mes
  FROM r_items i JOIN r_variants v ON v.id = i.product_variant_id JOIN r_products p ON p.id = v.product_id
  JOIN r_orders o ON o.id = i.order_id),
m_meses AS (
  SELECT CAST(unnest(generate_series((SELECT CAST(date_trunc('month', min(created_at)) AS DATE) FROM r_orders),
         DATE '{TEST_END}', INTERVAL 1 MONTH)) AS DATE) AS mes),
m_serie AS (
  SELECT m.mes, coalesce(CAST(u AS DOUBLE), 0) AS unidades, m.mes <= DATE '{TRAIN_END}' AS eh_treino
  FROM m_meses m LEFT JOIN (SELECT mes, sum(quantidade) AS u FROM m_items WHERE product_id IN
    (SELECT id FROM r_products WHERE name = '{TARGET_NAME}') GROUP BY 1) s ON s.mes = m.mes),
m_modelos AS (
  SELECT *, CASE WHEN NOT eh_treino THEN (SELECT avg(unidades) FROM (SELECT unidades FROM m_serie WHERE eh_treino
                 ORDER BY mes DESC LIMIT 3)) END AS moving_average,
         CASE WHEN NOT eh_treino THEN (SELECT unidades FROM m_serie y WHERE y.mes = m.mes - INTERVAL 1 YEAR) END AS seasonal_naive,
         CASE WHEN NOT eh_treino THEN (SELECT unidades FROM m_serie WHERE mes = DATE '{TRAIN_END}') END AS naive
  FROM m_serie m),
m_previsao AS (
  SELECT strftime(mes, '%Y-%m') AS ano_mes, mes AS data, unidades AS realizado, moving_average AS prev_mm3,
         seasonal_naive AS prev_sazonal, naive AS prev_naive, eh_treino FROM m_modelos),
m_ref AS (SELECT min(id) AS id FROM r_products WHERE name = '{REFERENCE_NAME}'),
m_pares AS (SELECT DISTINCT customer_id, product_id FROM m_items),
m_pop AS (SELECT product_id, count(*) AS n FROM m_pares GROUP BY 1),
m_comuns AS (
  SELECT product_id, count(*) AS comuns FROM m_pares WHERE customer_id IN
    (SELECT customer_id FROM m_pares WHERE product_id = (SELECT id FROM m_ref)) GROUP BY 1),
m_cos AS (
  SELECT p.product_id, coalesce(c.comuns, 0) AS comuns, p.n,
         coalesce(c.comuns, 0) / sqrt(CAST(p.n AS DOUBLE) * (SELECT n FROM m_pop WHERE product_id = (SELECT id FROM m_ref))) AS similaridade
  FROM m_pop p LEFT JOIN m_comuns c ON c.product_id = p.product_id WHERE p.product_id <> (SELECT id FROM m_ref)),
m_rotulos AS (
  SELECT id AS product_id, CASE WHEN count(*) OVER (PARTITION BY name) > 1 THEN name || ' (id=' || id || ')' ELSE name END AS produto
  FROM r_products),
m_cesta AS (
  SELECT product_id, count(DISTINCT order_id) AS pedidos_em_comum FROM m_items WHERE order_id IN
    (SELECT order_id FROM m_items WHERE product_id = (SELECT id FROM m_ref)) AND product_id <> (SELECT id FROM m_ref) GROUP BY 1),
m_similaridade AS (
  SELECT c.product_id, r.produto, c.similaridade,
         (c.similaridade - avg(c.similaridade) OVER ()) / stddev_samp(c.similaridade) OVER () AS desvios_da_media,
         row_number() OVER (ORDER BY c.similaridade DESC, c.product_id) AS posicao,
         coalesce(b.pedidos_em_comum, 0) AS pedidos_em_comum, '{REFERENCE_NAME}' AS produto_referencia
  FROM m_cos c JOIN m_rotulos r ON r.product_id = c.product_id LEFT JOIN m_cesta b ON b.product_id = c.product_id)""".strip()

_SUSPICIOUS = f"({texts(SUSPICIOUS_NAMES)})"


def _sql(select: str, extra: str = "") -> str:
    return over_ctes(select, MODEL_CTES + (",\n" + extra if extra else ""))


def _round_deviations(df):
    """Nine decimals, where the last bits depend on the order of summation."""
    return df.withColumn("desvios_da_media", F.round("desvios_da_media", 9))


@query("unified_items", _sql(
    "SELECT * REPLACE (CAST(unit_price AS DOUBLE) AS unit_price, CAST(line_total AS DOUBLE) AS line_total, "
    "CAST(mes AS TIMESTAMP) AS mes) FROM m_items"))
def unified_items(c: Context):
    return c.unified


@query("ids_of_name", _sql(f"SELECT id AS product_id FROM r_products WHERE name = '{TARGET_NAME}'"))
def ids_of_name(c: Context):
    return c.target_ids


@query("units_in_date_range", _sql(
    "SELECT strftime(mes, '%Y-%m') AS ano_mes, CAST(sum(quantidade) AS DOUBLE) AS unidades FROM m_items "
    f"WHERE product_id IN (SELECT id FROM r_products WHERE name = '{TARGET_NAME}') AND data_pedido >= '2000-10-01' "
    "AND data_pedido < '2001-01-01' GROUP BY 1"))
def units_in_date_range(c: Context):
    ranged = c.unified.filter((F.col("data_pedido") >= "2000-10-01") & (F.col("data_pedido") < "2001-01-01"))
    return forecast.monthly_units(ranged, c.target_ids).select(
        F.date_format("mes", "yyyy-MM").alias("ano_mes"), "unidades")


@query("monthly_series_dense", _sql("SELECT CAST(mes AS TIMESTAMP) AS mes, unidades FROM m_serie"))
def monthly_series_dense(c: Context):
    return c.dense


@query("last_training_months", _sql(
    "SELECT CAST(mes AS TIMESTAMP) AS mes, unidades FROM m_serie WHERE eh_treino ORDER BY m_serie.mes DESC LIMIT 3"))
def last_training_months(c: Context):
    return forecast.last_months(c.dense, TRAIN_END, 3)


@query("forecast_fact", _sql("SELECT * REPLACE (CAST(data AS TIMESTAMP) AS data) FROM m_previsao"))
def forecast_fact(c: Context):
    return forecast.forecast_fact(c.forecasts)


@query("forecast_error_rows", _sql(
    "SELECT CAST(mes AS TIMESTAMP) AS mes, moving_average AS previsto, unidades AS realizado, abs(unidades - moving_average) AS erro_abs "
    "FROM m_modelos WHERE NOT eh_treino"))
def forecast_error_rows(c: Context):
    return forecast.error_rows(c.forecasts)


@query("forecast_error_totals", _sql(
    "SELECT sum(moving_average) AS soma_prevista, sum(unidades) AS soma_real, round(avg(abs(unidades - moving_average)), 9) AS mae, "
    "CAST(round_even(sum(moving_average), 0) AS BIGINT) AS soma_arredondada, "
    "CAST(sum(round_even(moving_average, 0)) AS BIGINT) AS soma_dos_arredondados FROM m_modelos WHERE NOT eh_treino"))
def forecast_error_totals(c: Context):
    return forecast.error_totals(c.forecasts).withColumn("mae", F.round("mae", 9))


_LONG = " UNION ALL ".join(
    f"SELECT {i} AS o, '{m}' AS modelo, sum({m}) AS soma, avg(abs(unidades - {m})) AS mae FROM m_modelos WHERE NOT eh_treino"
    for i, m in enumerate(forecast.MODELS))


@query("forecast_model_comparison", _sql(
    f"SELECT modelo, soma, round(mae, 9) AS mae, row_number() OVER (ORDER BY mae, o) = 1 AS melhor FROM ({_LONG})"))
def forecast_model_comparison(c: Context):
    return forecast.model_errors(c.forecasts).withColumn("mae", F.round("mae", 9))


# An id of the list that nobody ever bought still gets its scenario.
_UNSOLD = -1


def _scenario_sql(extra: str = "") -> str:
    return _sql(
        "SELECT cenario, max(media) AS media_movel, CAST(round_even(sum(media), 0) AS BIGINT) AS previsao, sum(unidades) AS \"real\", "
        "round(avg(abs(unidades - media)), 9) AS mae FROM (SELECT *, avg(unidades) FILTER (eh_treino AND mes > DATE '2000-09-01') "
        "OVER (PARTITION BY cenario) AS media FROM c_serie) WHERE NOT eh_treino GROUP BY cenario",
        f"c_ids AS (SELECT id FROM r_products WHERE name = '{TARGET_NAME}'{extra}), "
        "c_vendas AS (SELECT CAST(product_id AS VARCHAR) AS cenario, mes, sum(quantidade) AS u FROM m_items WHERE product_id IN (SELECT id FROM c_ids) GROUP BY 1, 2 "
        "UNION ALL SELECT 'all', mes, sum(quantidade) FROM m_items WHERE product_id IN (SELECT id FROM c_ids) GROUP BY 2), "
        f"c_serie AS (SELECT s.cenario, m.mes, coalesce(CAST(u AS DOUBLE), 0) AS unidades, m.mes <= DATE '{TRAIN_END}' AS eh_treino "
        "FROM (SELECT CAST(id AS VARCHAR) AS cenario FROM c_ids UNION SELECT 'all') s CROSS JOIN m_meses m "
        "LEFT JOIN c_vendas v ON v.cenario = s.cenario AND v.mes = m.mes)")


def _scenarios(c: Context, ids):
    return forecast.by_scenario(c.unified, ids, forecast.first_month(c.raw["orders"]), TRAIN_END, TEST_END).withColumn("mae", F.round("mae", 9))


@query("forecast_by_scenario", _scenario_sql())
def forecast_by_scenario(c: Context):
    return _scenarios(c, c.target_ids)


@query("forecast_by_scenario_unsold", _scenario_sql(f" UNION SELECT {_UNSOLD}"))
def forecast_by_scenario_unsold(c: Context):
    return _scenarios(c, c.target_ids.unionByName(c.spark.range(_UNSOLD, _UNSOLD + 1).select(F.col("id").alias("product_id"))))


@query("training_year_month_pivot", _sql(
    "SELECT year(mes) AS ano, " + ", ".join(
        f"coalesce(sum(unidades) FILTER (month(mes) = {m}), 0) AS m{m:02d}" for m in range(1, 13))
    + " FROM m_serie WHERE eh_treino GROUP BY 1"))
def training_year_month_pivot(c: Context):
    return forecast.year_month_pivot(c.training)


@query("training_month_profile", _sql(
    "SELECT month(mes) AS mes_num, avg(unidades) AS media FROM m_serie WHERE eh_treino GROUP BY 1"))
def training_month_profile(c: Context):
    return forecast.month_profile(c.training)


@query("training_quarter_contrast", _sql(
    "SELECT avg(media) FILTER (m IN (1, 2, 3)) AS media_jan_mar, avg(media) FILTER (m IN (10, 11, 12)) AS media_out_dez, "
    "arg_min(m, media) AS mes_minimo, min(media) AS media_minima FROM (SELECT month(mes) AS m, avg(unidades) AS media FROM m_serie WHERE eh_treino GROUP BY 1)"))
def training_quarter_contrast(c: Context):
    return forecast.quarter_contrast(c.training)


@query("training_yearly_units", _sql(
    "SELECT ano, total, primeiro_trimestre, 100.0 * (total / first_value(total) OVER (ORDER BY ano) - 1) AS crescimento_pct FROM "
    "(SELECT year(mes) AS ano, sum(unidades) AS total, coalesce(sum(unidades) FILTER (month(mes) <= 3), 0) AS primeiro_trimestre "
    "FROM m_serie WHERE eh_treino GROUP BY 1)"))
def training_yearly_units(c: Context):
    return forecast.yearly_units(c.training)


@query("december_effect", _sql(
    "SELECT a AS dezembros_anteriores, u AS ultimo_dezembro, (a - u) / 3 AS impacto_mensal FROM (SELECT avg(unidades) FILTER (year(mes) < 2000) AS a, "
    "max(unidades) FILTER (year(mes) = 2000) AS u FROM m_serie WHERE eh_treino AND month(mes) = 12)"))
def december_effect(c: Context):
    return forecast.december_effect(c.training)


@query("interaction_matrix_summary", _sql(
    "SELECT (SELECT count(DISTINCT customer_id) FROM m_pares) AS clientes, count(*) AS produtos, "
    "100.0 * CAST(sum(n) AS DOUBLE) / ((SELECT count(DISTINCT customer_id) FROM m_pares) * count(*)) AS densidade_pct, "
    "avg(n) AS compradores_por_produto, max(n) FILTER (product_id = (SELECT id FROM m_ref)) AS compradores_da_referencia FROM m_pop"))
def interaction_matrix_summary(c: Context):
    return similarity.matrix_summary(c.pairs, c.reference)


@query("similar_items_top", _sql(
    "SELECT CAST(posicao AS INTEGER) AS posicao, product_id, produto, similaridade, "
    f"split_part(produto, ' (id=', 1) IN {_SUSPICIOUS} AS suspeito FROM m_similaridade WHERE posicao <= 5"))
def similar_items_top(c: Context):
    return similarity.ranking(c.similar, c.labels, 5)


@query("similarity_distinguishability", _sql(
    "SELECT CAST(posicao AS INTEGER) AS posicao, product_id, similaridade, round(desvios_da_media, 9) AS desvios_da_media, "
    "CASE WHEN posicao < 5 THEN similaridade - proxima END AS gap, CASE WHEN posicao < 5 THEN 100.0 * (similaridade - proxima) / similaridade END AS gap_pct "
    "FROM (SELECT *, lead(similaridade) OVER (ORDER BY posicao) AS proxima FROM m_similaridade) WHERE posicao <= 5"))
def similarity_distinguishability(c: Context):
    return _round_deviations(similarity.distinguishability(c.similar, 5))


_SUBSETS = {
    "all": "true", "without_draft": "status <> 'draft'", "without_cancelled": "status <> 'cancelled'",
    "paid_or_confirmed": "status IN ('paid', 'confirmed')", "paid": "status = 'paid'",
}
_SUBSET_SQL = " UNION ALL ".join(
    f"SELECT '{name}' AS recorte, product_id, similaridade FROM (SELECT p.product_id, count(*) FILTER (p.customer_id IN "
    f"(SELECT customer_id FROM m_items WHERE {w} AND product_id = (SELECT id FROM m_ref))) / sqrt(CAST(count(*) AS DOUBLE) * "
    f"(SELECT count(DISTINCT customer_id) FROM m_items WHERE {w} AND product_id = (SELECT id FROM m_ref))) AS similaridade "
    f"FROM (SELECT DISTINCT customer_id, product_id FROM m_items WHERE {w}) p WHERE p.product_id <> (SELECT id FROM m_ref) "
    "GROUP BY 1 ORDER BY similaridade DESC, p.product_id LIMIT 1)"
    for name, w in _SUBSETS.items())


@query("similarity_by_status_subset", _sql(_SUBSET_SQL))
def similarity_by_status_subset(c: Context):
    return similarity.top_by_subset(c.purchases, c.reference, {k: F.expr(v) for k, v in _SUBSETS.items()})


@query("similarity_name_trap", _sql(
    "SELECT CAST(row_number() OVER (ORDER BY s DESC, produto) AS INTEGER) AS posicao, produto, s AS similaridade, "
    f"split_part(produto, ' (id=', 1) IN {_SUSPICIOUS} AS suspeito FROM (SELECT produto, count(*) FILTER (r) / "
    f"sqrt(CAST(count(*) AS DOUBLE) * (SELECT count(*) FROM n_pares WHERE produto = '{REFERENCE_NAME}')) AS s FROM (SELECT *, customer_id IN "
    f"(SELECT customer_id FROM n_pares WHERE produto = '{REFERENCE_NAME}') AS r FROM n_pares) WHERE produto <> '{REFERENCE_NAME}' GROUP BY 1) "
    "ORDER BY s DESC, produto LIMIT 3", "n_pares AS (SELECT DISTINCT customer_id, produto FROM m_items)"))
def similarity_name_trap(c: Context):
    return similarity.name_trap(c.purchases, REFERENCE_NAME)


@query("similarity_fused_products", _sql(
    "SELECT count(DISTINCT product_id) AS por_id, count(DISTINCT produto) AS por_nome, "
    "count(DISTINCT product_id) - count(DISTINCT produto) AS fundidos FROM m_items"))
def similarity_fused_products(c: Context):
    return similarity.fused_products(c.purchases)


@query("basket_items_top", _sql(
    "SELECT CAST(row_number() OVER (ORDER BY pedidos_em_comum DESC, c.product_id) AS INTEGER) AS posicao, c.product_id, produto, pedidos_em_comum "
    "FROM m_cesta c JOIN m_rotulos r ON r.product_id = c.product_id ORDER BY pedidos_em_comum DESC, c.product_id LIMIT 5"))
def basket_items_top(c: Context):
    return similarity.basket_ranking(c.lines, c.reference, c.labels, 5)


@query("similarity_fact", _sql("SELECT * REPLACE (round(desvios_da_media, 9) AS desvios_da_media) FROM m_similaridade"))
def similarity_fact(c: Context):
    return _round_deviations(similarity.similarity_fact(c.similar, c.lines, c.reference, REFERENCE_NAME, c.labels))


_SUPPLIER_PAIRS = "t_pares AS (SELECT DISTINCT o_custkey AS c, l_suppkey AS s FROM lineitem JOIN orders ON o_orderkey = l_orderkey), t_pop AS (SELECT s, count(*) AS n FROM t_pares GROUP BY 1)"
# The reference suppliers, and the parts of the reference products.
_SUPPLIERS = (1, 2, 3)
_REFERENCES = (REFERENCE_NAME, TARGET_NAME)


@query("cosine_matrix_suppliers", (
    f"WITH {_SUPPLIER_PAIRS} SELECT a.s AS reference, b.s AS item, count(*) AS comuns, "
    "count(*) / sqrt(CAST(any_value(x.n) AS DOUBLE) * any_value(y.n)) AS similaridade FROM t_pares a JOIN t_pares b ON a.c = b.c "
    f"JOIN t_pop x ON x.s = a.s JOIN t_pop y ON y.s = b.s WHERE a.s IN {_SUPPLIERS} GROUP BY 1, 2"))
def cosine_matrix_suppliers(c: Context):
    """The rows of the cosine matrix that belong to the reference suppliers."""
    bought = c.driver["lineitem"].join(c.driver["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    references = c.driver["supplier"].select(F.col("s_suppkey").alias("item")).filter(F.col("item").isin(*_SUPPLIERS))
    return similarity.cosine_rows(similarity.interactions(bought, "o_custkey", "l_suppkey"), references)


def _violations(cosines: str, references: str, bought: str) -> str:
    """SQL that counts violations in a relation of (reference, item, similaridade)."""
    return (
        f"SELECT count(*) AS pares, count(*) FILTER (WHERE similaridade < 0 OR similaridade > 1 + 1e-9) AS fora_do_intervalo, "
        "count(*) FILTER (WHERE reference = item AND abs(similaridade - 1) > 1e-9) AS diagonal_diferente_de_1, "
        f"{bought} - count(*) FILTER (WHERE reference = item) AS referencias_sem_diagonal, "
        f"(SELECT count(*) FROM {cosines} a LEFT JOIN {cosines} b ON a.reference = b.item AND a.item = b.reference "
        f"WHERE a.item IN {references} AND (b.similaridade IS NULL OR abs(a.similaridade - b.similaridade) >= 1e-12)) AS assimetricas "
        f"FROM {cosines}")


_NAMED = f"(SELECT id FROM r_products WHERE name IN {_REFERENCES})"


@query("cosine_matrix_checks", _sql(_violations(
    "(SELECT a.product_id AS reference, b.product_id AS item, count(*) / sqrt(CAST(any_value(x.n) AS DOUBLE) * any_value(y.n)) AS similaridade "
    "FROM m_pares a JOIN m_pares b ON a.customer_id = b.customer_id JOIN m_pop x ON x.product_id = a.product_id "
    f"JOIN m_pop y ON y.product_id = b.product_id WHERE a.product_id IN {_NAMED} GROUP BY 1, 2)",
    _NAMED, f"(SELECT count(*) FROM m_pop WHERE product_id IN {_NAMED})")))
def cosine_matrix_checks(c: Context):
    references = c.raw["products"].filter(F.col("name").isin(*_REFERENCES)).select(F.col("id").alias("item"))
    return similarity.cosine_checks(similarity.cosine_rows(c.pairs, references), references, c.pairs)


_PLANTED_COSINES = (
    "planted AS (SELECT reference, item, CASE WHEN item % 7 = 6 THEN similaridade + 1 WHEN item % 7 = 5 THEN -similaridade "
    "WHEN reference = 1 AND item = 1 THEN 0.5 WHEN reference = 1 AND item = 3 THEN similaridade / 2 ELSE similaridade END AS similaridade "
    "FROM cosines WHERE NOT (reference = 2 AND item = 2))")


@query("cosine_checks_planted", (
    f"WITH {_SUPPLIER_PAIRS}, cosines AS (SELECT a.s AS reference, b.s AS item, "
    "count(*) / sqrt(CAST(any_value(x.n) AS DOUBLE) * any_value(y.n)) AS similaridade FROM t_pares a JOIN t_pares b ON a.c = b.c "
    f"JOIN t_pop x ON x.s = a.s JOIN t_pop y ON y.s = b.s WHERE a.s IN {_SUPPLIERS} GROUP BY 1, 2), {_PLANTED_COSINES} "
    + _violations("planted", str(_SUPPLIERS), f"(SELECT count(*) FROM t_pop WHERE s IN {_SUPPLIERS})")))
def cosine_checks_planted(c: Context):
    """The checks of the cosines over rows in which each of them must fail."""
    bought = c.driver["lineitem"].join(c.driver["orders"], F.col("l_orderkey") == F.col("o_orderkey"))
    pairs = similarity.interactions(bought, "o_custkey", "l_suppkey")
    references = c.driver["supplier"].select(F.col("s_suppkey").alias("item")).filter(F.col("item").isin(*_SUPPLIERS))
    at = lambda r, i: (F.col("reference") == r) & (F.col("item") == i)
    value = F.col("similaridade")
    planted = F.when(F.col("item") % 7 == 6, value + 1).when(F.col("item") % 7 == 5, -value) \
        .when(at(1, 1), 0.5).when(at(1, 3), value / 2).otherwise(value)
    rows = similarity.cosine_rows(pairs, references).filter(~at(2, 2)).withColumn("similaridade", planted)
    return similarity.cosine_checks(rows, references, pairs)


@query("similarity_spread", _sql(
    "SELECT count(*) AS itens, round(avg(similaridade), 12) AS media, round(stddev_samp(similaridade), 12) AS desvio, max(similaridade) AS maximo, "
    "(SELECT count(DISTINCT order_id) FROM m_items WHERE product_id = (SELECT id FROM m_ref)) AS pedidos_da_referencia FROM m_cos"))
def similarity_spread(c: Context):
    """Mean, deviation and maximum of the similarities, and the orders that hold the reference item."""
    orders = c.purchases.filter(F.col("product_id") == c.reference).agg(F.count_distinct("order_id")).scalar()
    spread = similarity.spread(c.similar).withColumns({x: F.round(x, 12) for x in ("media", "desvio")})
    return spread.withColumn("pedidos_da_referencia", orders)


@query("ranking_all_positions", (
    "SELECT row_number() OVER (ORDER BY CAST(o_totalprice AS DECIMAL(18,2)) DESC, o_orderkey) AS posicao, o_orderkey AS order_id FROM orders"))
def ranking_all_positions(c: Context):
    return ranking.number_all_rows(
        c.silver["pedidos"].select("order_id", "total"), [F.desc("total"), F.asc("order_id")], "posicao"
    ).select("posicao", "order_id")
