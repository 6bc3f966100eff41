"""The layers published one after the other and checked as stored, and checks over data with planted faults."""

from __future__ import annotations

from itertools import count

from pyspark.sql import functions as F

from tillstar.functions import text
from tillstar.operators import quality
from tillstar.plans import retail
from tillstar.plans.oracle_base import MIN_CATEGORIES, clean, over_ctes
from tillstar.plans.queries_layers import GOLD_KEYS, SILVER_KEYS
from tillstar.plans.registry import ELITE_SIZE, Context, query
from tillstar.session import kept_table, shared_dir
from tillstar.sources import export, publish

_runs = count()


def _once(checks, name: str):
    """``checks`` of one set of stored tables, whose few rows are kept: what decides the publication is also what is reported."""
    done = []

    def check(tables):
        if not done:
            done.append(kept_table(checks(tables), name))
        return done[0]

    return check


def _publish_layers(c: Context):
    """Silver published from the sources, gold from the stored silver; the stored tables and their checks.

    Tables are written one after the other, so the shuffles of two large joins are not on disk at once.
    """
    root = f"{shared_dir(c.spark)}/tillstar-run/{c.spark.sparkContext.applicationId}-{next(_runs)}"
    totals = retail.control_totals(c.raw)
    check_silver = _once(lambda t: quality.silver_checks(t, totals["orders"], totals["items"]), "silver-checks")
    check_gold = _once(lambda t: quality.gold_checks(t, ELITE_SIZE, totals), "gold-checks")
    silver = publish.publish(c.spark, f"{root}/silver", c.silver, "run", check_silver, jobs=1)
    built = retail.gold(silver, c.raw["brands"], c.as_of, MIN_CATEGORIES, ELITE_SIZE)
    gold = publish.publish(c.spark, f"{root}/gold", {t: built[t] for t in retail.GOLD_TABLES}, "run", check_gold, jobs=1)
    return root, silver, gold, check_silver(silver), check_gold(gold)


def _row(layer: str, check: str, value: str) -> str:
    return f"SELECT '{layer}' AS layer, '{check}' AS \"check\", CAST({value} AS DOUBLE) AS expected, CAST({value} AS DOUBLE) AS actual, true AS ok"


_STORE_DAYS = "(SELECT date_diff('day', min(data), max(data)) + 1 FROM s_pedidos WHERE canal = 'pos')"
_SOLD_DAYS = "(SELECT count(DISTINCT data) FROM s_pedidos WHERE canal = 'pos')"
_WITH_LINES = "(SELECT sum(desconto) FROM s_pedidos WHERE order_id IN (SELECT order_id FROM r_items))"


@query("layered_run_checks", over_ctes(" UNION ALL ".join(
    [_row("silver", f"{t}: key", "0") for t in SILVER_KEYS]
    + [_row("silver", "orders whose discount is not allocated to the cent", "0"), _row("silver", "allocated discount total", _WITH_LINES),
       _row("silver", "pedidos: rows", "(SELECT count(*) FROM orders)"), _row("silver", "itens_pedido: rows", "(SELECT count(*) FROM lineitem)")]
    + [_row("gold", f"{t}: key", "0") for t in GOLD_KEYS]
    + [_row("gold", "elite customers", "10"), _row("gold", "fct_pedido: rows", "(SELECT count(*) FROM orders)"),
       _row("gold", "fct_item_pedido: rows", "(SELECT count(*) FROM lineitem)"), _row("gold", "revenue", "(SELECT sum(total) FROM s_pedidos)"),
       _row("gold", "discount", _WITH_LINES), _row("gold", "store days", _STORE_DAYS),
       _row("gold", "days without sale", f"{_STORE_DAYS} - {_SOLD_DAYS}")])))
def layered_run_checks(c: Context):
    """Keys, row counts and control totals of both layers as they are stored."""
    _, _, _, silver, gold = _publish_layers(c)
    return silver.select(F.lit("silver").alias("layer"), "*").unionByName(gold.select(F.lit("gold").alias("layer"), "*"))


_OBJECTS = {
    "dim_data": "g_dim_data", "dim_cliente": "g_dim_cliente", "dim_produto": "g_dim_produto", "dim_local": "g_dim_local",
    "dim_canal": "g_dim_canal", "dim_status_pedido": "g_dim_status", "fct_pedido": "g_fct_pedido", "fct_item_pedido": "g_fct_item",
    "fct_pagamento": "g_fct_pagamento", "fct_venda_diaria_pos": "g_fct_diaria", "fct_devolucao": "g_fct_devolucao",
    "fct_estoque_atual": "g_fct_estoque",
}


@query("layered_export_objects", over_ctes(" UNION ALL ".join(
    f"SELECT '{t}' AS objeto, count(*) AS linhas, 0::BIGINT AS colunas_nao_portaveis FROM {g}" for t, g in _OBJECTS.items())))
def layered_export_objects(c: Context):
    """The twelve objects of the star exported from the stored layer, and what was written."""
    root, _, gold, _, _ = _publish_layers(c)
    counts = []
    for name in retail.GOLD_TABLES:
        export.write_parquet(gold[name], f"{root}/export/{name}")
        written = c.spark.read.parquet(f"{root}/export/{name}")
        counts.append(written.agg(F.count(F.lit(1)).alias("linhas")).select(
            F.lit(name).alias("objeto"), "linhas", F.lit(len(export.unportable_columns(written))).cast("long").alias("colunas_nao_portaveis")))
    return quality.all_checks(counts)


@query("null_if_junk_in_sql", over_ctes(f"SELECT id, {clean('name')} AS nome FROM r_products"))
def null_if_junk_in_sql(c: Context):
    """The SQL function over a view of the products."""
    text.register_sql_functions(c.spark)
    c.raw["products"].select("id", "name").createOrReplaceTempView("products_to_clean")
    return c.spark.sql("SELECT id, null_if_junk(name) AS nome FROM products_to_clean")


# -- planted faults: the checks must find exactly these ------------------------------------------

_OFF = "0.02"


def _planted_lines(c: Context):
    """Two cents too much on every line of every fiftieth order."""
    extra = F.when(F.col("order_id") % 50 == 1, F.lit(_OFF).cast("decimal(3,2)")).otherwise(F.lit("0.00").cast("decimal(3,2)"))
    return c.silver["itens_pedido"].withColumn("desconto_rateado", (F.col("desconto_rateado") + extra).cast("decimal(18,2)"))


_PLANTED = (f"p_itens AS (SELECT order_id, desconto_rateado + CASE WHEN order_id % 50 = 1 THEN {_OFF} ELSE 0 END AS desconto_rateado FROM s_itens), "
            "p_soma AS (SELECT order_id, sum(desconto_rateado) AS a FROM p_itens GROUP BY 1), "
            "p_fora AS (SELECT order_id, a, desconto AS o FROM p_soma JOIN s_pedidos USING (order_id) WHERE abs(a - desconto) > 0.01)")


@query("allocation_differences_planted", over_ctes(
    "SELECT order_id, CAST(a AS DOUBLE) AS allocated, CAST(o AS DOUBLE) AS original FROM p_fora", _PLANTED))
def allocation_differences_planted(c: Context):
    return quality.allocation_differences(_planted_lines(c), c.silver["pedidos"], "order_id", "desconto_rateado", "desconto")


@query("checks_planted", over_ctes(
    "SELECT 'allocation' AS \"check\", 0.0 AS expected, CAST(count(*) AS DOUBLE) AS actual, count(*) = 0 AS ok FROM p_fora UNION ALL "
    "SELECT 'total', (SELECT CAST(sum(desconto) AS DOUBLE) FROM s_pedidos WHERE order_id IN (SELECT order_id FROM p_soma)), CAST(sum(a) AS DOUBLE), "
    "sum(a) = (SELECT sum(desconto) FROM s_pedidos WHERE order_id IN (SELECT order_id FROM p_soma)) FROM p_soma UNION ALL "
    "SELECT 'key', 0.0, CAST(count(*) AS DOUBLE), count(*) = 0 FROM s_locais WHERE location_id < 3 UNION ALL "
    "SELECT 'rows', 7.0, CAST(count(*) AS DOUBLE), count(*) = 7 FROM s_locais", _PLANTED))
def checks_planted(c: Context):
    """Every kind of check over data in which it must fail."""
    places = c.silver["locais"].select("location_id")
    lines, heads = _planted_lines(c), c.silver["pedidos"]
    return quality.all_checks([
        quality.none_of(quality.allocation_differences(lines, heads, "order_id", "desconto_rateado", "desconto"), F.lit(True), "allocation"),
        quality.allocation_reconciles(lines, heads, "order_id", "desconto_rateado", "desconto", "total"),
        quality.key_is_unique(places.unionByName(places.filter("location_id < 3")), ["location_id"], "key"),
        quality.count_is(places, 7, "rows"),
    ])


_RELATION = over_ctes(
    "SELECT 'fct_pedido->dim_cliente' AS relacao, (SELECT count(*) FROM g_dim_cliente WHERE customer_id % 40 = 0 AND customer_id % 9 <> 0) AS chaves_repetidas, "
    "(SELECT count(*) FROM g_dim_cliente WHERE customer_id % 9 = 0) AS chaves_nulas, "
    "(SELECT count(*) FROM g_fct_pedido WHERE customer_id % 9 = 0) AS orfaos")


def _planted_customers(c: Context):
    """Customers of whom some are twice and some have lost their key: their orders are orphans."""
    key = F.when(F.col("customer_id") % 9 != 0, F.col("customer_id"))
    clients = c.raw["customers"].select(F.col("id").alias("customer_id"))
    clients = clients.unionByName(clients.filter("customer_id % 40 = 0 and customer_id % 9 <> 0")).select(key.alias("customer_id"))
    return clients


@query("relationship_planted", _RELATION)
def relationship_planted(c: Context):
    return quality.relationship(c.gold["fct_pedido"], "customer_id", _planted_customers(c), "customer_id", "fct_pedido->dim_cliente")


@query("relationships_planted", _RELATION + " UNION ALL SELECT 'fct_pedido->dim_local', 0, 0, "
       "(SELECT count(*) FROM g_fct_pedido WHERE location_id NOT IN (SELECT location_id FROM g_dim_local WHERE location_id < 20))")
def relationships_planted(c: Context):
    """The same in one pass over the fact, with places that are missing."""
    return quality.relationships(c.gold["fct_pedido"], "fct_pedido", {
        "dim_cliente": ("customer_id", _planted_customers(c), "customer_id"),
        "dim_local": ("location_id", c.gold["dim_local"].filter("location_id < 20"), "location_id")})
