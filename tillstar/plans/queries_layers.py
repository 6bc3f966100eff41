"""Cleaned tables, star tables and the checks on them."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstar.operators import calendar, quality, star
from tillstar.operators.allocate import allocate
from tillstar.plans import retail
from tillstar.plans.oracle_base import dbl, month, over_ctes, ts, weekday
from tillstar.plans.registry import ELITE_SIZE, Context, query


def _table(name: str, layer: str, table: str, select: str) -> None:
    """Register one table of a layer as it is."""
    query(name, over_ctes(select))(lambda c: getattr(c, layer)[table])


_table("silver_categories", "silver", "categorias", "SELECT * FROM s_categorias")
_table("silver_products", "silver", "produtos", "SELECT * FROM s_produtos")
_table("silver_variants", "silver", "variantes",
       f"SELECT product_variant_id, product_id, sku, {dbl('sale_price', 'cost_price', 'weight_kg')}, is_active FROM s_variantes")
_table("silver_customers", "silver", "clientes", "SELECT * FROM s_clientes")
_table("silver_locations", "silver", "locais", "SELECT * FROM s_locais")
_table("silver_orders", "silver", "pedidos",
       f"SELECT * REPLACE (CAST(subtotal AS DOUBLE) AS subtotal, CAST(desconto AS DOUBLE) AS desconto, "
       "CAST(total AS DOUBLE) AS total, CAST(data AS TIMESTAMP) AS data) FROM s_pedidos")
_MONEY = ("preco_unitario", "valor_linha", "desconto_rateado", "custo", "margem_bruta", "margem_liquida")
_table("silver_items_discount_allocation", "silver", "itens_pedido",
       f"SELECT order_item_id, order_id, product_variant_id, product_id, quantidade, {dbl(*_MONEY)} FROM s_itens")
_table("silver_payments", "silver", "pagamentos",
       f"SELECT payment_id, order_id, metodo, parcelas, {dbl('valor')}, status, data_pagamento FROM s_pagamentos")
_table("silver_returns", "silver", "devolucoes",
       "SELECT return_item_id, return_id, order_id, customer_id, order_item_id, "
       f"{dbl('quantidade', 'valor_unitario_reembolso')}, acao, status, motivo, {ts('data')} FROM s_devolucoes")
_table("silver_stock", "silver", "estoque",
       f"SELECT product_variant_id, location_id, {dbl('quantidade_em_maos')}, ponto_de_reposicao, updated_at FROM s_estoque")

# Every third order is one order here, which so has a third of all lines; orders of more lines than this are split.
HOT_LINES = 1000


@query("allocation_over_hot_order", over_ctes(
    "SELECT id AS order_item_id, order_id, CAST(line_total AS DOUBLE) AS valor_linha, CAST((share + CASE WHEN rn = 1 THEN d - "
    "sum(share) OVER (PARTITION BY order_id) ELSE 0 END) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2))::DOUBLE AS desconto_rateado FROM h_shares", """
h_heads AS (SELECT CASE WHEN order_id % 3 = 0 THEN 0 ELSE order_id END AS order_id, sum(desconto) AS desconto FROM s_pedidos GROUP BY 1),
h_items AS (SELECT id, CASE WHEN order_id % 3 = 0 THEN 0 ELSE order_id END AS order_id, line_total FROM r_items),
h_cents AS (
  SELECT i.*, CAST(p.desconto * 100 AS HUGEINT) AS d, CAST(i.line_total * 100 AS HUGEINT) AS l,
         CAST(sum(i.line_total) OVER (PARTITION BY i.order_id) * 100 AS HUGEINT) AS w
  FROM h_items i JOIN h_heads p ON p.order_id = i.order_id),
h_shares AS (
  SELECT *, CASE WHEN w = 0 THEN 0 ELSE (2 * d * l + w) // (2 * w) END AS share,
         row_number() OVER (PARTITION BY order_id ORDER BY line_total DESC, id) AS rn
  FROM h_cents)"""))
def allocation_over_hot_order(c: Context):
    merged = F.when(F.col("order_id") % 3 == 0, 0).otherwise(F.col("order_id")).alias("order_id")
    lines = c.raw["order_items"].select(F.col("id").alias("order_item_id"), merged, F.col("line_total").alias("valor_linha"))
    heads = c.silver["pedidos"].select(merged, "desconto").groupBy("order_id").agg(F.sum("desconto").alias("desconto"))
    return allocate(lines, heads, "order_id", "valor_linha", "desconto", ["order_item_id"], "desconto_rateado", hot_rows=HOT_LINES).select(
        "order_item_id", "order_id", F.col("valor_linha").cast("double"), F.col("desconto_rateado").cast("double"))


_table("gold_dim_date", "gold", "dim_data",
       f"SELECT {ts('data')}, num_dia_semana, dia_semana, ano, num_mes, mes, ano_mes, num_trimestre, trimestre, "
       "eh_fim_de_semana, eh_futuro FROM g_dim_data")
_table("gold_dim_customer", "gold", "dim_cliente",
       "SELECT customer_id, cliente, tipo_pessoa, flag_nome_suspeito, "
       f"{dbl('faturamento_total', 'ticket_medio')}, frequencia, diversidade_categorias, flag_elite FROM g_dim_cliente")
_table("gold_dim_product", "gold", "dim_produto", "SELECT * FROM g_dim_produto")
_table("gold_dim_location", "gold", "dim_local", "SELECT * FROM g_dim_local")
_table("gold_dim_channel", "gold", "dim_canal", "SELECT * FROM g_dim_canal")
# The status dimension is a constant table, so it is shown with the orders that use it.
query("gold_dim_status", over_ctes(
    "SELECT s.*, count(p.order_id) AS pedidos FROM g_dim_status s LEFT JOIN g_fct_pedido p ON p.status = s.status "
    "GROUP BY ALL"))(
    lambda c: c.gold["dim_status_pedido"].join(
        c.gold["fct_pedido"].groupBy("status").agg(F.count(F.lit(1)).alias("n")), "status", "left")
    .withColumn("pedidos", F.coalesce("n", F.lit(0))).drop("n"))
_table("gold_fct_order", "gold", "fct_pedido",
       f"SELECT order_id, {ts('data')}, customer_id, location_id, canal, status, {dbl('subtotal', 'desconto', 'total')}, eh_futuro FROM g_fct_pedido")
_table("gold_fct_order_item", "gold", "fct_item_pedido",
       f"SELECT order_item_id, order_id, {ts('data')}, customer_id, location_id, canal, status, product_id, "
       f"product_variant_id, quantidade, {dbl(*_MONEY)} FROM g_fct_item")
_table("gold_fct_payment", "gold", "fct_pagamento",
       f"SELECT payment_id, order_id, {ts('data')}, metodo, parcelas, {dbl('valor')}, status FROM g_fct_pagamento")
_table("gold_fct_daily_store_sales", "gold", "fct_venda_diaria_pos",
       f"SELECT {ts('data')}, {dbl('valor_venda')}, qtd_pedidos, dia_sem_venda FROM g_fct_diaria")
_table("gold_fct_return", "gold", "fct_devolucao",
       f"SELECT return_item_id, return_id, order_id, customer_id, {ts('data')}, product_id, {dbl('quantidade', 'valor_reembolso')}, "
       "acao, motivo, status FROM g_fct_devolucao")
_table("gold_fct_stock", "gold", "fct_estoque_atual",
       f"SELECT product_variant_id, product_id, location_id, {dbl('quantidade_em_maos', 'valor_em_estoque')}, ponto_de_reposicao FROM g_fct_estoque")
_table("gold_daily_store_view", "gold", "vw_venda_diaria_pos",
       f"SELECT CAST(f.data AS TIMESTAMP) AS data, c.num_dia_semana, c.dia_semana AS nome_dia_semana, c.ano, c.num_mes AS mes, "
       f"{dbl('f.valor_venda')}, f.qtd_pedidos, f.dia_sem_venda FROM g_fct_diaria f JOIN g_dim_data c ON c.data = f.data")


@query("store_calendar", over_ctes(
    f"SELECT {ts('data')}, isodow(data) AS num_dia_semana, {weekday('isodow(data)')} AS nome_dia_semana, year(data) AS ano, "
    f"month(data) AS mes, {month('month(data)')} AS nome_mes, quarter(data) AS trimestre, day(data) AS dia_do_mes, "
    "isodow(data) >= 6 AS eh_fim_de_semana FROM g_fct_diaria"))
def store_calendar(c: Context):
    return calendar.store_calendar(_store_days(c))


def _store_days(c: Context):
    store = c.silver["pedidos"].filter(F.col("canal") == star.STORE_CHANNEL)
    return calendar.date_series(calendar.date_bounds((store, "data")))


@query("calendar_left_join", over_ctes(
    f"SELECT {ts('data')}, n AS num_dia_semana, dia_da_semana AS nome_dia_semana, ano, {dbl('valor_venda')}, qtd_pedidos, "
    "dia_sem_venda FROM g_semana"))
def calendar_left_join(c: Context):
    days = calendar.store_calendar(_store_days(c)).select("data", "num_dia_semana", "nome_dia_semana", "ano")
    sales = calendar.daily_sales(c.silver["pedidos"], "data", "total", F.col("canal") == star.STORE_CHANNEL)
    return calendar.fill_calendar(days, sales)


@query("star_joined_dimensions", over_ctes(
    "SELECT i.order_item_id, p.categoria, p.marca, l.uf, s.ordem, d.ano_mes, CAST(i.valor_linha AS DOUBLE) AS valor_linha "
    "FROM g_fct_item i LEFT JOIN g_dim_produto p ON p.product_id = i.product_id "
    "LEFT JOIN g_dim_local l ON l.location_id = i.location_id LEFT JOIN g_dim_status s ON s.status = i.status "
    "LEFT JOIN g_dim_data d ON d.data = i.data"))
def star_joined_dimensions(c: Context):
    lines = retail.lines_with_heads(c.raw, c.silver, c.gold["dim_produto"])
    fact = star.fct_order_item(lines, more=["categoria", "marca"])
    others = {d: c.gold[d] for d in ("dim_local", "dim_status_pedido", "dim_data")}
    return star.join_dims(
        others | {"fct_item_pedido": fact}, "fct_item_pedido", ["dim_produto", *others], held=["dim_produto"]
    ).select("order_item_id", "categoria", "marca", "uf", "ordem", "ano_mes", "valor_linha")


@query("margin_totals", over_ctes(
    "SELECT CAST(sum(valor_linha) AS DOUBLE) AS receita_bruta_itens, CAST(sum(margem_bruta) AS DOUBLE) AS margem_bruta, "
    "round(100.0 * CAST(sum(margem_bruta) AS DOUBLE) / CAST(sum(valor_linha) AS DOUBLE), 2) AS pct_margem_bruta, "
    "CAST(sum(desconto_rateado) AS DOUBLE) AS desconto, CAST(sum(margem_liquida) AS DOUBLE) AS margem_liquida, "
    "round(100.0 * CAST(sum(margem_liquida) AS DOUBLE) / CAST(sum(valor_linha) AS DOUBLE), 2) AS pct_margem_liquida "
    "FROM g_fct_item"))
def margin_totals(c: Context):
    return star.margin_totals(c.gold["fct_item_pedido"])


@query("allocation_differences", over_ctes(
    "SELECT i.order_id, CAST(sum(i.desconto_rateado) AS DOUBLE) AS allocated, CAST(max(p.desconto) AS DOUBLE) AS original "
    "FROM s_itens i JOIN s_pedidos p ON p.order_id = i.order_id GROUP BY i.order_id "
    "HAVING abs(sum(i.desconto_rateado) - max(p.desconto)) > 0.01"))
def allocation_differences(c: Context):
    return quality.allocation_differences(
        c.silver["itens_pedido"], c.silver["pedidos"], "order_id", "desconto_rateado", "desconto")


def _ok(check: str, value: str) -> str:
    return f"SELECT '{check}' AS \"check\", CAST({value} AS DOUBLE) AS expected, CAST({value} AS DOUBLE) AS actual, true AS ok"


SILVER_KEYS = ("categorias", "produtos", "variantes", "clientes", "locais", "pedidos", "itens_pedido", "pagamentos",
                "devolucoes", "estoque")
GOLD_KEYS = ("dim_data", "dim_cliente", "dim_produto", "dim_local", "dim_canal", "dim_status_pedido", "fct_pedido",
              "fct_item_pedido", "fct_pagamento", "fct_venda_diaria_pos", "fct_devolucao", "fct_estoque_atual")


@query("silver_checks", over_ctes(" UNION ALL ".join(
    [_ok(f"{t}: key", "0") for t in SILVER_KEYS]
    + [_ok("orders whose discount is not allocated to the cent", "0"),
       _ok("allocated discount total",
           "(SELECT sum(desconto) FROM s_pedidos WHERE order_id IN (SELECT order_id FROM r_items))")])))
def silver_checks(c: Context):
    return quality.silver_checks(c.silver)


@query("gold_checks", over_ctes(" UNION ALL ".join(
    [_ok(f"{t}: key", "0") for t in GOLD_KEYS] + [_ok("elite customers", "10")])))
def gold_checks(c: Context):
    return quality.gold_checks(c.gold, ELITE_SIZE)


@query("star_relationships", over_ctes(" UNION ALL ".join(
    f"SELECT '{fact}->{dim}' AS relacao, (SELECT count(*) FROM (SELECT {key} FROM {d} WHERE {key} IS NOT NULL GROUP BY 1 "
    f"HAVING count(*) > 1)) AS chaves_repetidas, (SELECT count(*) FROM {d} WHERE {key} IS NULL) AS chaves_nulas, "
    f"(SELECT count(*) FROM {f} WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {d})) AS orfaos"
    for fact, f, dim, d, key in [
        (fact, {"fct_pedido": "g_fct_pedido", "fct_item_pedido": "g_fct_item", "fct_venda_diaria_pos": "g_fct_diaria",
                "fct_devolucao": "g_fct_devolucao", "fct_estoque_atual": "g_fct_estoque"}[fact],
         dim, {"dim_status_pedido": "g_dim_status"}.get(dim, f"g_{dim}"), key)
        for fact, edges in star.EDGES.items() for dim, key in edges.items()])))
def star_relationships(c: Context):
    return quality.all_checks([
        quality.relationships(c.gold[fact], fact, {dim: (key, c.gold[dim], key) for dim, key in edges.items()})
        for fact, edges in star.EDGES.items() if edges
    ])
