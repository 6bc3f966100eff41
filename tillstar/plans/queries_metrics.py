"""Measures over the star: totals, groups, filters, ranked lists and series."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstar.operators import metrics
from tillstar.plans.oracle_base import over_ctes
from tillstar.plans.queries_models import MODEL_CTES
from tillstar.plans.registry import Context, query


def _d(expression: str) -> str:
    return f"CAST({expression} AS DOUBLE)"


def _ratio(top: str, bottom: str) -> str:
    return f"{_d(top)} / nullif({_d(bottom)}, 0)"


def _rounded(df, *exact: str):
    """Quotients to nine decimals, so that both engines print the same digits."""
    return df.select(*[
        F.round(c, 9).alias(c) if t == "double" and c not in exact else F.col(c) for c, t in df.dtypes
    ])


_ORDER_MEASURES = ["orders", "gross_revenue", "recognised_revenue", "average_ticket", "customers"]
_ORDER_SQL = (
    f"count(*) AS orders, {_d('sum(total)')} AS gross_revenue, "
    f"{_d('sum(total) FILTER (s.eh_receita_efetivada)')} AS recognised_revenue, "
    f"round({_ratio('sum(total)', 'count(*)')}, 9) AS average_ticket, count(DISTINCT f.customer_id) AS customers"
)
_ORDERS_FROM = "FROM g_fct_pedido f JOIN g_dim_status s ON s.status = f.status"


@query("metrics_orders_total", over_ctes(f"SELECT {_ORDER_SQL} {_ORDERS_FROM}"))
def metrics_orders_total(c: Context):
    return _rounded(metrics.metric(c.star, _ORDER_MEASURES))


@query("metrics_orders_by_month", over_ctes(
    f"SELECT d.ano_mes, {_ORDER_SQL} {_ORDERS_FROM} JOIN g_dim_data d ON d.data = f.data GROUP BY 1"))
def metrics_orders_by_month(c: Context):
    return _rounded(metrics.metric(c.star, _ORDER_MEASURES, ["dim_data.ano_mes"]))


@query("metrics_orders_by_channel_filtered", over_ctes(
    f"SELECT k.canal_exibicao, d.ano, {_ORDER_SQL} {_ORDERS_FROM} JOIN g_dim_canal k ON k.canal = f.canal "
    "JOIN g_dim_local l ON l.location_id = f.location_id JOIN g_dim_data d ON d.data = f.data "
    "WHERE l.uf IN ('ASIA', 'EUROPE') AND s.status_exibicao IN ('Pago', 'Rascunho') GROUP BY 1, 2"))
def metrics_orders_by_channel_filtered(c: Context):
    return _rounded(metrics.metric(
        c.star, _ORDER_MEASURES, ["dim_canal.canal_exibicao", "dim_data.ano"],
        {"dim_local.uf": ["ASIA", "EUROPE"], "dim_status_pedido.status_exibicao": ["Pago", "Rascunho"]}))


@query("metrics_cancellation_rate", over_ctes(
    "SELECT canal_exibicao, round(CAST(nullif(count(*) FILTER (status = 'cancelled'), 0) AS DOUBLE) / count(*), 9) AS cancellation_rate "
    "FROM g_fct_pedido f JOIN g_dim_canal k ON k.canal = f.canal GROUP BY 1"))
def metrics_cancellation_rate(c: Context):
    """The status filter below does not reach either side of the rate."""
    return _rounded(metrics.metric(
        c.star, "cancellation_rate", ["dim_canal.canal_exibicao"], {"dim_status_pedido.status_exibicao": ["Pago"]}))


_ITEM_MEASURES = ["item_revenue", "gross_margin", "net_margin", "gross_margin_pct", "net_margin_pct", "items_sold"]
_ITEM_SQL = (
    f"{_d('sum(valor_linha)')} AS item_revenue, {_d('sum(margem_bruta)')} AS gross_margin, {_d('sum(margem_liquida)')} AS net_margin, "
    f"round({_ratio('sum(margem_bruta)', 'sum(valor_linha)')}, 9) AS gross_margin_pct, "
    f"round({_ratio('sum(margem_liquida)', 'sum(valor_linha)')}, 9) AS net_margin_pct, CAST(sum(quantidade) AS BIGINT) AS items_sold"
)


@query("metrics_margin_total", over_ctes(f"SELECT {_ITEM_SQL} FROM g_fct_item"))
def metrics_margin_total(c: Context):
    return _rounded(metrics.metric(c.star, _ITEM_MEASURES))


@query("metrics_margin_by_category", over_ctes(
    f"SELECT categoria, {_ITEM_SQL} FROM g_fct_item i JOIN g_dim_produto p ON p.product_id = i.product_id GROUP BY 1"))
def metrics_margin_by_category(c: Context):
    return _rounded(metrics.metric(c.star, _ITEM_MEASURES, ["dim_produto.categoria"]))


@query("metrics_return_rate_by_category", over_ctes(
    f"SELECT categoria, {_d('r')} AS returned_items, CAST(s AS BIGINT) AS items_sold, round({_ratio('r', 's')}, 9) AS return_rate FROM "
    "(SELECT categoria, sum(quantidade) AS r FROM g_fct_devolucao d JOIN g_dim_produto p ON p.product_id = d.product_id GROUP BY 1) FULL JOIN "
    "(SELECT categoria, sum(quantidade) AS s FROM g_fct_item d JOIN g_dim_produto p ON p.product_id = d.product_id GROUP BY 1) USING (categoria)"))
def metrics_return_rate_by_category(c: Context):
    return _rounded(metrics.metric(c.star, ["returned_items", "items_sold", "return_rate"], ["dim_produto.categoria"]))


@query("metrics_stock_and_diversity_by_brand", over_ctes(
    "SELECT marca, CAST(v AS DOUBLE) AS stock_value, n AS category_diversity FROM "
    "(SELECT marca, sum(valor_em_estoque) AS v FROM g_fct_estoque e JOIN g_dim_produto p ON p.product_id = e.product_id GROUP BY 1) JOIN "
    "(SELECT marca, count(DISTINCT category_id) AS n FROM g_dim_produto GROUP BY 1) USING (marca)"))
def metrics_stock_and_diversity_by_brand(c: Context):
    return metrics.metric(c.star, ["stock_value", "category_diversity"], ["dim_produto.marca"])


_DAY_SQL = (
    f"round({_ratio('sum(valor_venda)', 'count(*)')}, 9) AS mean_per_day, "
    f"round({_ratio('sum(valor_venda)', 'count(*) FILTER (NOT dia_sem_venda)')}, 9) AS mean_per_selling_day, "
    "nullif(count(*) FILTER (dia_sem_venda), 0) AS days_without_sale, "
    "round((CAST(sum(valor_venda) AS DOUBLE) / nullif(count(*) FILTER (NOT dia_sem_venda), 0)) / (CAST(sum(valor_venda) AS DOUBLE) / count(*)) - 1, 9) AS mean_inflation"
)


@query("metrics_strip_seasonality", over_ctes(f"SELECT {_DAY_SQL} FROM g_fct_diaria"))
def metrics_strip_seasonality(c: Context):
    return _rounded(metrics.strip(c.star, "seasonality"))


@query("metrics_strip_overview", over_ctes(
    f"SELECT gross_revenue, recognised_revenue, orders, average_ticket, net_margin_pct FROM (SELECT {_ORDER_SQL} {_ORDERS_FROM}), "
    f"(SELECT {_ITEM_SQL} FROM g_fct_item)"))
def metrics_strip_overview(c: Context):
    return _rounded(metrics.strip(c.star, "overview"))


@query("metrics_strip_margin", over_ctes(
    "SELECT item_revenue, gross_margin, gross_margin_pct, discount, net_margin, net_margin_pct FROM "
    f"(SELECT {_ITEM_SQL}, {_d('sum(desconto_rateado)')} AS discount FROM g_fct_item)"))
def metrics_strip_margin(c: Context):
    return _rounded(metrics.strip(c.star, "margin"))


@query("metrics_strip_customers", over_ctes(
    f"SELECT customers, average_ticket, orders, items_sold, round({_ratio('r', 'items_sold')}, 9) AS return_rate FROM "
    f"(SELECT {_ORDER_SQL} {_ORDERS_FROM}), (SELECT {_ITEM_SQL} FROM g_fct_item), (SELECT sum(quantidade) AS r FROM g_fct_devolucao)"))
def metrics_strip_customers(c: Context):
    return _rounded(metrics.strip(c.star, "customers"))


@query("metrics_strip_forecast", over_ctes(
    "SELECT sum(realizado) FILTER (NOT eh_treino) AS actual_in_test, round(sum(prev_mm3), 9) AS forecast_moving_average, "
    "round(sum(prev_mm3) / nullif(sum(realizado) FILTER (NOT eh_treino), 0) - 1, 9) AS forecast_error FROM m_previsao", MODEL_CTES))
def metrics_strip_forecast(c: Context):
    return _rounded(metrics.strip(c.star, "forecast"))


@query("metrics_forecast_by_month", over_ctes(
    "SELECT ano_mes, realizado AS actual_units, round(prev_mm3, 9) AS forecast_moving_average, prev_sazonal AS forecast_seasonal, "
    "prev_naive AS forecast_naive FROM m_previsao", MODEL_CTES))
def metrics_forecast_by_month(c: Context):
    return _rounded(metrics.metric(
        c.star, ["actual_units", "forecast_moving_average", "forecast_seasonal", "forecast_naive"], ["fct_previsao.ano_mes"]))


def _ranked_sql(values: str, label: str, name: str, n: int, second: str | None = None, extra: str = "") -> str:
    """Competition ranks up to ``n`` over a select of (label, name[, second])."""
    more = f", {second}" if second else ""
    share2 = f", CAST({second} AS DOUBLE) / (SELECT max({second}) FROM v) AS second_share" if second else ""
    return over_ctes(
        f"SELECT CAST(r AS INTEGER) AS position, {label}, {name}{more}, CAST({name} AS DOUBLE) / (SELECT max({name}) FROM v) AS share_of_max{share2} "
        f"FROM (SELECT *, rank() OVER (ORDER BY {name} DESC) AS r FROM v WHERE {name} IS NOT NULL) WHERE r <= {n}",
        (extra + ",\n" if extra else "") + f"v AS ({values})")


_ITEMS_BY = "FROM g_fct_item i JOIN g_dim_produto p ON p.product_id = i.product_id GROUP BY 1"
_ORDERS_BY_CUSTOMER = "FROM g_fct_pedido f JOIN g_dim_cliente k ON k.customer_id = f.customer_id GROUP BY 1"
_RANKED = {
    # name: (measure, by, n, second, sql values)
    "ranked_status_revenue": ("gross_revenue", "dim_status_pedido.status_exibicao", 4, None,
        "SELECT status_exibicao, CAST(sum(total) AS DOUBLE) AS gross_revenue FROM g_fct_pedido f JOIN g_dim_status s ON s.status = f.status GROUP BY 1"),
    "ranked_channel_orders": ("orders", "dim_canal.canal_exibicao", 2, None,
        "SELECT canal_exibicao, count(*) AS orders FROM g_fct_pedido f JOIN g_dim_canal s ON s.canal = f.canal GROUP BY 1"),
    "ranked_category_net_margin": ("net_margin", "dim_produto.categoria", 5, None,
        f"SELECT categoria, CAST(sum(margem_liquida) AS DOUBLE) AS net_margin {_ITEMS_BY}"),
    "ranked_category_revenue_and_margin": ("item_revenue", "dim_produto.categoria", 7, "net_margin",
        f"SELECT categoria, CAST(sum(valor_linha) AS DOUBLE) AS item_revenue, CAST(sum(margem_liquida) AS DOUBLE) AS net_margin {_ITEMS_BY}"),
    "ranked_product_margin_pct": ("net_margin_pct", "dim_produto.produto", 9, None,
        f"SELECT produto, CAST(sum(margem_liquida) AS DOUBLE) / nullif(CAST(sum(valor_linha) AS DOUBLE), 0) AS net_margin_pct {_ITEMS_BY}"),
    "ranked_customer_ticket": ("average_ticket", "dim_cliente.cliente", 8, None,
        f"SELECT cliente, CAST(sum(total) AS DOUBLE) / count(*) AS average_ticket {_ORDERS_BY_CUSTOMER}"),
    "ranked_customer_ticket_and_revenue": ("average_ticket", "dim_cliente.cliente", 4, "gross_revenue",
        f"SELECT cliente, CAST(sum(total) AS DOUBLE) / count(*) AS average_ticket, CAST(sum(total) AS DOUBLE) AS gross_revenue {_ORDERS_BY_CUSTOMER}"),
    "ranked_category_items": ("items_sold", "dim_produto.categoria", 8, None,
        f"SELECT categoria, CAST(sum(quantidade) AS BIGINT) AS items_sold {_ITEMS_BY}"),
    "ranked_similar_items": ("cosine", "fct_similaridade_produto.produto", 7, None,
        "SELECT produto, similaridade AS cosine FROM m_similaridade"),
    "ranked_basket_items": ("orders_in_common", "fct_similaridade_produto.produto", 7, None,
        "SELECT produto, pedidos_em_comum AS orders_in_common FROM m_similaridade"),
}
for _name, (_measure, _by, _n, _second, _values) in _RANKED.items():
    _label = _by.split(".")[1]
    query(_name, _ranked_sql(_values, _label, _measure, _n, _second, MODEL_CTES if "m_" in _values else ""))(
        lambda c, m=_measure, b=_by, n=_n, s=_second: metrics.ranked(c.star, m, b, n, s))


@query("natural_weekday_means", over_ctes(
    "SELECT n AS num_dia_semana, dia_da_semana AS dia_semana, a AS mean_per_day, b AS mean_per_selling_day, "
    "a / max(a) OVER () AS share_of_max, b / max(b) OVER () AS second_share FROM (SELECT n, dia_da_semana, "
    "CAST(sum(valor_venda) AS DOUBLE) / count(*) AS a, CAST(sum(valor_venda) AS DOUBLE) / nullif(count(*) FILTER (NOT dia_sem_venda), 0) AS b "
    "FROM g_semana GROUP BY 1, 2) WHERE a IS NOT NULL"))
def natural_weekday_means(c: Context):
    return metrics.natural_list(
        c.star, ["mean_per_day", "mean_per_selling_day"], "dim_data.dia_semana", "dim_data.num_dia_semana")


@query("natural_weekday_empty_days", over_ctes(
    "SELECT n AS num_dia_semana, dia_da_semana AS dia_semana, e AS days_without_sale, CAST(e AS DOUBLE) / max(e) OVER () AS share_of_max "
    "FROM (SELECT n, dia_da_semana, count(*) FILTER (dia_sem_venda) AS e FROM g_semana GROUP BY 1, 2) WHERE e > 0"))
def natural_weekday_empty_days(c: Context):
    return metrics.natural_list(c.star, ["days_without_sale"], "dim_data.dia_semana", "dim_data.num_dia_semana")


_SERIES = {
    # name: (measures, by, zero_based, sql of (label, i, measures))
    "series_revenue": (["gross_revenue", "recognised_revenue"], "dim_data.ano_mes", True,
        "SELECT ano_mes, year(data) * 12 + month(data) AS i, CAST(sum(total) AS DOUBLE) AS gross_revenue, "
        "CAST(sum(total) FILTER (status IN ('paid', 'confirmed')) AS DOUBLE) AS recognised_revenue FROM "
        "(SELECT *, strftime(data, '%Y-%m') AS ano_mes FROM g_fct_pedido) GROUP BY 1, 2"),
    "series_margin_pct": (["net_margin_pct"], "dim_data.ano_mes", False,
        "SELECT strftime(data, '%Y-%m') AS ano_mes, year(data) * 12 + month(data) AS i, "
        "CAST(sum(margem_liquida) AS DOUBLE) / CAST(sum(valor_linha) AS DOUBLE) AS net_margin_pct FROM g_fct_item GROUP BY 1, 2"),
    "series_empty_days": (["days_without_sale"], "dim_data.ano", True,
        "SELECT ano, ano AS i, nullif(count(*) FILTER (dia_sem_venda), 0) AS days_without_sale FROM g_semana GROUP BY 1, 2"),
    "series_forecast": (["actual_units", "forecast_moving_average"], "fct_previsao.ano_mes", True,
        "SELECT ano_mes, year(data) * 12 + month(data) AS i, realizado AS actual_units, prev_mm3 AS forecast_moving_average FROM m_previsao"),
}


def _series_queries(name: str, names: list[str], by: str, zero_based: bool, sql: str) -> None:
    label = by.split(".")[1]
    extra = (MODEL_CTES + ",\n" if "m_" in sql else "") + f"v AS (SELECT *, i - min(i) OVER () AS idx, max(i) OVER () - min(i) OVER () AS n FROM ({sql}))"
    query(name, over_ctes(f"SELECT {label}, CAST(idx AS INTEGER) AS idx, {', '.join(names)} FROM v", extra))(
        lambda c: metrics.series(c.star, names, by).withColumn("idx", F.col("idx").cast("int")))
    high, low = f"max(greatest({', '.join(names)}))", f"min(least({', '.join(names)}))"
    axis = (f"0.0::DOUBLE AS axis_min, CAST({high} AS DOUBLE) AS axis_max" if zero_based else
            f"{low} - ({high} - {low}) * 0.12 AS axis_min, {high} + ({high} - {low}) * 0.12 AS axis_max")
    last = ", ".join(f"arg_max({m}, idx) FILTER ({m} IS NOT NULL) AS last_{m}" for m in names)
    query(name + "_frame", over_ctes(
        f"SELECT CAST(arg_min({label}, idx) AS VARCHAR) AS first_label, CAST(arg_max({label}, idx) AS VARCHAR) AS last_label, "
        f"(SELECT CAST({label} AS VARCHAR) FROM v ORDER BY abs(idx - n / 2), {label} LIMIT 1) AS middle_label, "
        f"CAST(max(idx) AS INTEGER) AS periods, {axis}, {last} FROM v", extra))(
        lambda c: metrics.series_frame(
            metrics.series(c.star, names, by).withColumn("idx", F.col("idx").cast("int")), label, names, zero_based))


for _name, (_measures, _by, _zero, _sql) in _SERIES.items():
    _series_queries(_name, _measures, _by, _zero, _sql)
