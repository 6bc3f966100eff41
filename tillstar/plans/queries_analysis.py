"""Exploration of orders, customer analyses and the weekday question."""

from __future__ import annotations

from pyspark.sql import functions as F

from tillstar.functions.dates import iso_weekday, weekday_name
from tillstar.operators import calendar, customers, eda
from tillstar.plans.oracle_base import AS_OF, MIN_CATEGORIES, mean, over_ctes, ts
from tillstar.plans.registry import ELITE_SIZE, Context, query

_SUMMARY = (
    "SELECT count(*) AS qtd_total_linhas, min(created_at) AS data_minima, max(created_at) AS data_maxima, "
    "CAST(min(total) AS DOUBLE) AS total_minimo, CAST(max(total) AS DOUBLE) AS total_maximo, "
    f"{mean('sum(total)', 'count(*)')} AS total_medio FROM r_orders"
)


@query("eda_summary", over_ctes(_SUMMARY))
def eda_summary(c: Context):
    return eda.summary(c.raw["orders"], "created_at", "total")


@query("eda_summary_text", over_ctes(
    "SELECT translate(format('{:,}', qtd_total_linhas), ',.', '.,') AS qtd_total_linhas, "
    "strftime(data_minima, '%d/%m/%Y %H:%M:%S') AS data_minima, strftime(data_maxima, '%d/%m/%Y %H:%M:%S') AS data_maxima, "
    + ", ".join(f"'R$ ' || translate(format('{{:,.2f}}', {c}), ',.', '.,') AS {c}"
                for c in ("total_minimo", "total_maximo", "total_medio"))
    + f" FROM ({_SUMMARY})"))
def eda_summary_text(c: Context):
    return eda.summary_text(c.raw["orders"], "created_at", "total")


_ORDER_COLUMNS = (
    "id", "order_number", "channel", "customer_id", "salesperson_id", "location_id", "status", "subtotal",
    "discount_amount", "total", "placed_at", "created_at", "updated_at",
)


@query("eda_null_census", over_ctes(
    "SELECT " + ", ".join(f"count(*) - count({c}) AS nulos_{c}" for c in _ORDER_COLUMNS) + " FROM r_orders"))
def eda_null_census(c: Context):
    return eda.null_census(c.raw["orders"])


@query("eda_null_rate_by_channel", over_ctes(
    "SELECT channel, count(*) AS linhas, count(*) - count(salesperson_id) AS nulos, "
    "round(100.0 * CAST(count(*) - count(salesperson_id) AS DOUBLE) / count(*), 1) AS pct_nulos FROM r_orders GROUP BY channel"))
def eda_null_rate_by_channel(c: Context):
    return eda.null_rate_by(c.raw["orders"], "channel", "salesperson_id")


@query("eda_status_mix", over_ctes(
    "SELECT status, count(*) AS pedidos, round(100.0 * CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE), 2) AS pct_pedidos, "
    "CAST(sum(total) AS DOUBLE) AS soma_total, "
    "round(100.0 * CAST(sum(total) AS DOUBLE) / CAST(sum(sum(total)) OVER () AS DOUBLE), 2) AS pct_valor, "
    f"{mean('sum(total)', 'count(*)')} AS ticket_medio FROM r_orders GROUP BY status"))
def eda_status_mix(c: Context):
    return eda.mix(c.raw["orders"], "status", "total")


def _tukey_sql(table: str, column: str) -> str:
    """Quartiles by interpolation between the two values around (n - 1) * p, and what lies above the fence."""
    at = lambda p: (
        f"(SELECT lo.v + (hi.v - lo.v) * (((n - 1) * {p}) - floor((n - 1) * {p})) FROM t_n, t_v lo, t_v hi "
        f"WHERE lo.k = floor((n - 1) * {p}) AND hi.k = ceil((n - 1) * {p}))")
    cents = lambda x: f"CAST(round(CAST({x} AS DECIMAL(20,6)), 2) AS DOUBLE)"
    return over_ctes(
        f"SELECT {cents('a')} AS q1, {cents('b')} AS mediana, {cents('c')} AS q3, round(m, 2) AS media, round(s, 2) AS desvio_padrao, "
        "round(m / b, 3) AS razao_media_mediana, round(c + 1.5 * (c - a), 2) AS cerca_superior, "
        "(SELECT count(*) FROM t_v WHERE v > c + 1.5 * (c - a)) AS acima_da_cerca, "
        "round(100.0 * ifnull((SELECT sum(v) FROM t_v WHERE v > c + 1.5 * (c - a)), 0) / total, 2) AS pct_receita_acima_da_cerca, "
        "(SELECT count(*) FROM t_v WHERE v <= 0) AS total_zero_ou_negativo FROM t_q, t_n",
        f"t_v AS (SELECT v, row_number() OVER (ORDER BY v) - 1 AS k FROM (SELECT CAST({column} AS DOUBLE) AS v FROM {table}) WHERE v IS NOT NULL), "
        "t_n AS (SELECT count(*) AS n, avg(v) AS m, stddev_samp(v) AS s, sum(v) AS total FROM t_v), "
        f"t_q AS (SELECT {at(0.25)} AS a, {at(0.5)} AS b, {at(0.75)} AS c)")


@query("eda_percentiles_tukey", _tukey_sql("r_orders", "total"))
def eda_percentiles_tukey(c: Context):
    return eda.tukey(c.raw["orders"], "total")


@query("eda_line_value_tukey", _tukey_sql("r_items", "unit_price"))
def eda_line_value_tukey(c: Context):
    return eda.tukey(c.raw["order_items"], "unit_price")


@query("eda_yearly", over_ctes(
    "SELECT year(created_at) AS ano, count(*) AS pedidos, CAST(sum(total) AS DOUBLE) AS soma_total, min(created_at) AS primeiro, "
    "max(created_at) AS ultimo FROM r_orders GROUP BY 1"))
def eda_yearly(c: Context):
    return eda.yearly(c.raw["orders"], "created_at", "total")


@query("eda_future_share", over_ctes(
    f"SELECT TIMESTAMP '{AS_OF}' AS data_de_referencia, count(*) FILTER (created_at > TIMESTAMP '{AS_OF}') AS pedidos_futuros, "
    f"count(*) AS pedidos_total, round(100.0 * CAST(count(*) FILTER (created_at > TIMESTAMP '{AS_OF}') AS DOUBLE) / count(*), 2) AS pct_futuro, "
    "max(created_at) AS data_mais_distante FROM r_orders"))
def eda_future_share(c: Context):
    return eda.future_share(c.raw["orders"], "created_at", c.as_of)


@query("eda_timestamp_census", over_ctes(
    "SELECT count(*) AS pedidos, count(*) FILTER (placed_at = created_at) AS placed_igual_created, "
    "count(*) FILTER (created_at = updated_at) AS created_igual_updated, "
    "count(*) FILTER (placed_at = created_at AND created_at = updated_at) AS os_tres_iguais FROM r_orders"))
def eda_timestamp_census(c: Context):
    return eda.timestamp_census(c.raw["orders"], "placed_at", "created_at", "updated_at")


@query("eda_arithmetic_closure", over_ctes(
    "SELECT count(*) AS pedidos, count(*) FILTER (subtotal - discount_amount = total) AS aritmetica_fecha, "
    "count(*) FILTER (subtotal - discount_amount <> total) AS aritmetica_quebra, count(*) FILTER (discount_amount = 0) AS sem_desconto, "
    "count(DISTINCT id) AS ids_distintos, count(DISTINCT order_number) AS order_numbers_distintos FROM r_orders"))
def eda_arithmetic_closure(c: Context):
    return eda.arithmetic_closure(c.raw["orders"], "id", "order_number", "subtotal", "discount_amount", "total")


@query("customer_ranking", over_ctes(
    "SELECT m.customer_id, CAST(faturamento AS DOUBLE) AS faturamento_total, frequencia, CAST(ticket_medio AS DOUBLE) AS ticket_medio, "
    "coalesce(d.categorias, 0) AS diversidade_categorias FROM g_metricas m LEFT JOIN g_diversidade d ON d.customer_id = m.customer_id"))
def customer_ranking(c: Context):
    return customers.customer_ranking(c.metrics, c.diversity)


@query("elite_ranking", over_ctes(
    "SELECT posicao, customer_id, CAST(faturamento AS DOUBLE) AS faturamento_total, frequencia, "
    "CAST(ticket_medio AS DOUBLE) AS ticket_medio, categorias AS diversidade_categorias FROM g_elite"))
def elite_ranking(c: Context):
    return customers.elite_ranking(c.metrics, c.diversity, MIN_CATEGORIES, ELITE_SIZE)


@query("elite_consumption", over_ctes(
    "SELECT c.category_id, c.categoria, CAST(sum(i.quantidade) AS BIGINT) AS total_itens_comprados, count(*) AS linhas_de_item, "
    "count(DISTINCT p.customer_id) AS clientes_do_grupo FROM g_elite e JOIN s_pedidos p ON p.customer_id = e.customer_id "
    "JOIN s_itens i ON i.order_id = p.order_id JOIN s_produtos pr ON pr.product_id = i.product_id "
    "JOIN s_categorias c ON c.category_id = pr.category_id GROUP BY 1, 2"))
def elite_consumption(c: Context):
    group = customers.elite_ids(c.metrics, c.diversity, MIN_CATEGORIES, ELITE_SIZE)
    lines = c.raw["order_items"].select("order_id", "product_variant_id", F.col("quantity").alias("quantidade"))
    return customers.group_consumption(
        group, c.silver["pedidos"], lines, c.silver["categorias"], c.raw["product_variants"], c.raw["products"])


@query("diversity_histogram", over_ctes(
    "SELECT categorias AS categorias_distintas, count(*) AS clientes, "
    "round(100.0 * CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE), 2) AS pct, "
    f"CAST(sum(CASE WHEN categorias >= {MIN_CATEGORIES} THEN count(*) ELSE 0 END) OVER () AS BIGINT) AS passam_no_filtro "
    "FROM g_diversidade GROUP BY categorias"))
def diversity_histogram(c: Context):
    return customers.diversity_histogram(c.diversity, MIN_CATEGORIES)


@query("category_count", over_ctes("SELECT count(*) AS categorias_existentes FROM s_categorias"))
def category_count(c: Context):
    return c.silver["categorias"].agg(F.count(F.lit(1)).alias("categorias_existentes"))


@query("fan_out_proof", over_ctes(
    "SELECT 'orders' AS metodo, CAST(sum(total) AS DOUBLE) AS faturamento FROM s_pedidos UNION ALL "
    "SELECT 'orders_x_lines', CAST(sum(p.total) AS DOUBLE) FROM s_pedidos p JOIN r_items i ON i.order_id = p.order_id UNION ALL "
    "SELECT 'orders_x_payments', CAST(sum(p.total) AS DOUBLE) FROM s_pedidos p JOIN r_payments g ON g.order_id = p.order_id"))
def fan_out_proof(c: Context):
    return customers.fan_out_proof(c.silver["pedidos"], c.raw["order_items"], c.raw["payments"])


@query("orders_of_elite_semi_join", over_ctes(
    "SELECT canal, status, count(*) AS pedidos FROM s_pedidos WHERE customer_id IN (SELECT customer_id FROM g_elite) GROUP BY 1, 2"))
def orders_of_elite_semi_join(c: Context):
    group = customers.elite_ids(c.metrics, c.diversity, MIN_CATEGORIES, ELITE_SIZE)
    return c.silver["pedidos"].join(F.broadcast(group), "customer_id", "left_semi").groupBy("canal", "status").agg(
        F.count(F.lit(1)).alias("pedidos"))


@query("calendar_summary", over_ctes(
    "SELECT count(*) AS dias_no_calendario, CAST(min(data) AS TIMESTAMP) AS primeira_data, CAST(max(data) AS TIMESTAMP) AS ultima_data, "
    "count(DISTINCT dia_da_semana) AS nomes_distintos FROM g_semana"))
def calendar_summary(c: Context):
    days = c.gold["fct_venda_diaria_pos"].withColumn("nome_dia_semana", weekday_name(F.col("data")))
    return calendar.calendar_summary(days)


@query("calendar_first_days", over_ctes(
    f"SELECT {ts('data')}, n AS num_dia_semana, dia_da_semana AS nome_dia_semana, n >= 6 AS eh_fim_de_semana FROM g_semana ORDER BY g_semana.data LIMIT 7"))
def calendar_first_days(c: Context):
    return calendar.store_calendar(c.gold["fct_venda_diaria_pos"]).orderBy("data").limit(7).select(
        "data", "num_dia_semana", "nome_dia_semana", "eh_fim_de_semana")


@query("dense_summary", over_ctes(
    "SELECT count(*) AS dias_totais, count(*) FILTER (dia_sem_venda) AS dias_sem_venda, "
    "count(*) FILTER (NOT dia_sem_venda) AS dias_com_venda, CAST(sum(valor_venda) AS DOUBLE) AS faturamento_pos_total FROM g_fct_diaria"))
def dense_summary(c: Context):
    return calendar.dense_summary(c.gold["fct_venda_diaria_pos"])


@query("weekday_means", over_ctes(
    "SELECT n, dia_da_semana, count(*) AS dias_no_periodo, count(*) FILTER (dia_sem_venda) AS dias_sem_venda, "
    f"CAST(sum(valor_venda) AS DOUBLE) AS faturamento_total, {mean('sum(valor_venda)', 'count(*)')} AS media_por_dia "
    "FROM g_semana GROUP BY n, dia_da_semana"))
def weekday_means(c: Context):
    return calendar.weekday_means(c.gold["fct_venda_diaria_pos"])


# Per weekday: its days and its sales, over all days and over the days that sold.
_COMPARISON = (
    "SELECT n, dia_da_semana, d AS dias_calendario, d - z AS dias_com_venda, z AS dias_sem_venda, "
    f"{mean('v', 'd')} AS media_com_calendario, {mean('v', '(d - z)')} AS media_sem_calendario, "
    "round(CAST(v AS DOUBLE) / nullif(d - z, 0) - CAST(v AS DOUBLE) / d, 2) AS inflacao_valor, "
    "round(100.0 * (CAST(v AS DOUBLE) / nullif(d - z, 0) / (CAST(v AS DOUBLE) / d) - 1), 2) AS inflacao_pct "
    "FROM (SELECT n, dia_da_semana, count(*) AS d, count_if(dia_sem_venda) AS z, sum(valor_venda) AS v FROM g_semana GROUP BY ALL)"
)


@query("weekday_comparison", over_ctes(_COMPARISON))
def weekday_comparison(c: Context):
    return calendar.weekday_comparison(c.gold["fct_venda_diaria_pos"])


@query("worst_day", over_ctes(
    "SELECT 'all_days' AS metodo, arg_min(dia_da_semana, media_com_calendario) AS pior_dia, "
    f"min(media_com_calendario) AS media_do_pior_dia FROM ({_COMPARISON}) UNION ALL "
    "SELECT 'selling_days', arg_min(dia_da_semana, media_sem_calendario), "
    f"min(media_sem_calendario) FROM ({_COMPARISON})"))
def worst_day(c: Context):
    return calendar.worst_day(c.gold["fct_venda_diaria_pos"])


@query("empty_days_by_weekday", over_ctes(
    "SELECT n, dia_da_semana, count(*) AS dias_no_periodo, count(*) FILTER (dia_sem_venda) AS dias_sem_venda, "
    "round(100.0 * CAST(count(*) FILTER (dia_sem_venda) AS DOUBLE) / count(*), 2) AS pct_vazio FROM g_semana GROUP BY 1, 2"))
def empty_days_by_weekday(c: Context):
    return calendar.empty_days_by_weekday(c.gold["fct_venda_diaria_pos"])


@query("empty_days_by_year", over_ctes(
    "SELECT ano, count(*) AS dias, count(*) FILTER (dia_sem_venda) AS dias_sem_venda FROM g_semana GROUP BY 1"))
def empty_days_by_year(c: Context):
    return calendar.empty_days_by_year(c.gold["fct_venda_diaria_pos"])


@query("weekday_of_narrow_channel", over_ctes(
    "SELECT isodow(d) AS n, count(*) AS dias, count(*) FILTER (v IS NULL) AS dias_sem_venda, CAST(coalesce(sum(v), 0) AS DOUBLE) AS total FROM ("
    "SELECT unnest(generate_series((SELECT min(data) FROM s_pedidos WHERE canal = 'pos' AND total > 400000), "
    "(SELECT max(data) FROM s_pedidos WHERE canal = 'pos' AND total > 400000), INTERVAL 1 DAY)) AS d) LEFT JOIN "
    "(SELECT data, sum(total) AS v FROM s_pedidos WHERE canal = 'pos' AND total > 400000 GROUP BY 1) ON data = CAST(d AS DATE) GROUP BY 1"))
def weekday_of_narrow_channel(c: Context):
    where = (F.col("canal") == "pos") & (F.col("total") > 400000)
    dense = calendar.dense_daily(c.silver["pedidos"], "data", "total", where)
    return dense.groupBy(iso_weekday(F.col("data")).alias("n")).agg(
        F.count(F.lit(1)).alias("dias"), F.count_if("dia_sem_venda").alias("dias_sem_venda"),
        F.sum("valor_venda").alias("total"))


@query("raw_tokens_preserved", over_ctes(
    "SELECT count(*) FILTER (legal_name IN ('TBD', 'Sem Nome')) AS lixo_preservado, "
    "count(*) FILTER (tax_id LIKE '0%') AS zeros_a_esquerda FROM r_customers"))
def raw_tokens_preserved(c: Context):
    return c.raw["customers"].agg(
        F.count_if(F.col("legal_name").isin("TBD", "Sem Nome")).alias("lixo_preservado"),
        F.count_if(F.col("tax_id").startswith("0")).alias("zeros_a_esquerda"))


@query("status_names_ordered", over_ctes(
    "SELECT canal, string_agg(status, ', ' ORDER BY status) AS estados FROM (SELECT DISTINCT canal, status FROM s_pedidos) GROUP BY canal"))
def status_names_ordered(c: Context):
    pairs = c.silver["pedidos"].select("canal", "status").distinct()
    return pairs.groupBy("canal").agg(F.array_join(F.sort_array(F.collect_list("status")), ", ").alias("estados"))


@query("row_counts_of_layer", over_ctes(
    " UNION ALL ".join(f"SELECT '{t}' AS tabela, count(*) AS linhas FROM r_{s}" for t, s in
                       [("customers", "customers"), ("orders", "orders"), ("order_items", "items"), ("payments", "payments")])))
def row_counts_of_layer(c: Context):
    parts = [c.raw[t].agg(F.count(F.lit(1)).alias("linhas")).select(F.lit(t).alias("tabela"), "linhas")
             for t in ("customers", "orders", "order_items", "payments")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])
