"""The star schema: dimensions, facts, and the edges between them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.numbers import MONEY, percent
from tillstar.operators import calendar, customers

# The order statuses with display name, display order and revenue flags.
STATUSES = (
    ("draft", "Rascunho", 1, False, False),
    ("confirmed", "Confirmado", 2, True, False),
    ("paid", "Pago", 3, True, True),
    ("cancelled", "Cancelado", 4, False, False),
)

# Display names of known channels.
CHANNEL_NAMES = {"pos": "Loja física", "ecommerce": "E-commerce"}

# Elite threshold (distinct categories), elite size, and the store channel.
MIN_CATEGORIES = 13
ELITE_SIZE = 10
STORE_CHANNEL = "pos"

# Fact -> dimension -> join column. Many-to-one, filters flow from dimension to
# fact only. Payments have no edge: an order can have several, so they must not meet lines.
EDGES: Mapping[str, Mapping[str, str]] = {
    "fct_pedido": {
        "dim_data": "data", "dim_cliente": "customer_id", "dim_local": "location_id",
        "dim_canal": "canal", "dim_status_pedido": "status",
    },
    "fct_item_pedido": {
        "dim_data": "data", "dim_cliente": "customer_id", "dim_produto": "product_id",
        "dim_local": "location_id", "dim_canal": "canal", "dim_status_pedido": "status",
    },
    "fct_venda_diaria_pos": {"dim_data": "data"},
    "fct_devolucao": {"dim_data": "data", "dim_produto": "product_id"},
    "fct_estoque_atual": {"dim_produto": "product_id", "dim_local": "location_id"},
    "fct_pagamento": {},
}


class UnrelatedError(ValueError):
    """A dimension was asked to filter or group a fact it has no edge to."""


def edge(fact: str, dim: str) -> str:
    """The column joining ``fact`` to ``dim``."""
    try:
        return EDGES[fact][dim]
    except KeyError:
        raise UnrelatedError(f"{fact} has no relationship to {dim}") from None


def join_dims(star: Mapping[str, DataFrame], fact: str, dims: Sequence[str], held: Sequence[str] = ()) -> DataFrame:
    """The fact with its dimensions, along known edges only; no fact row is lost or repeated.

    The fact has the columns of the dimensions ``held`` already, so it is not joined to them.
    """
    joined = star[fact]
    for dim in dims:
        key = edge(fact, dim)
        if dim in held:
            continue
        others = [c for c in star[dim].columns if c == key or c not in joined.columns]
        joined = joined.join(star[dim].select(*others), key, "left")
    return joined


def dim_date(orders: DataFrame, returns: DataFrame, as_of: date) -> DataFrame:
    """Dense days over everything dated: returns can be later than the last order."""
    bounds = calendar.date_bounds((orders, "data"), (returns, "data"))
    return calendar.date_dimension(calendar.date_series(bounds), as_of)


def dim_customer(
    clients: DataFrame, orders: DataFrame, items: DataFrame, products: DataFrame | None = None,
    min_categories: int = MIN_CATEGORIES, k: int = ELITE_SIZE,
) -> DataFrame:
    """Every customer with revenue, frequency, ticket, diversity and the elite flag.

    Without ``products`` the items carry their category themselves.
    """
    metrics = customers.order_metrics(orders)
    diversity = customers.category_diversity(orders, items, products)
    elite = customers.elite_ids(metrics, diversity, min_categories, k).withColumn("_elite", F.lit(True))
    # The elite list has at most k rows.
    return (
        clients.join(metrics, "customer_id", "left")
        .join(diversity, "customer_id", "left")
        .join(F.broadcast(elite), "customer_id", "left")
        .select(
            "customer_id",
            F.col("nome_exibicao").alias("cliente"),
            F.col("person_type").alias("tipo_pessoa"),
            "flag_nome_suspeito",
            "faturamento_total",
            "frequencia",
            "ticket_medio",
            F.coalesce("diversidade_categorias", F.lit(0)).alias("diversidade_categorias"),
            F.coalesce("_elite", F.lit(False)).alias("flag_elite"),
        )
    )


def dim_product(products: DataFrame, categories: DataFrame, brands: DataFrame) -> DataFrame:
    category = categories.select("category_id", "categoria", "flag_capitalizacao_corrigida")
    brand = brands.select(F.col("id").alias("brand_id"), F.col("name").alias("marca"))
    return (
        products.withColumnRenamed("category_id", "_category")
        .join(category, F.col("_category") == F.col("category_id"), "left")
        .join(brand, "brand_id", "left")
        .select(
            "product_id", F.col("nome_exibicao").alias("produto"), "flag_nome_suspeito", "flag_homonimo",
            "category_id", "categoria", "flag_capitalizacao_corrigida", "marca",
            F.col("is_active").alias("ativo"),
        )
    )


def dim_location(locations: DataFrame) -> DataFrame:
    return locations.select("location_id", "local", "tipo_local", "cidade", "uf")


def dim_channel(orders: DataFrame) -> DataFrame:
    name = F.initcap("canal")
    for channel, shown in CHANNEL_NAMES.items():
        name = F.when(F.col("canal") == channel, shown).otherwise(name)
    return orders.select("canal").distinct().withColumn("canal_exibicao", name)


def dim_status(spark: SparkSession) -> DataFrame:
    schema = "status string, status_exibicao string, ordem int, eh_receita_efetivada boolean, eh_pago boolean"
    return spark.createDataFrame(list(STATUSES), schema)


def fct_order(orders: DataFrame) -> DataFrame:
    """Order grain: the only source of order counts, revenue and tickets."""
    return orders.select(
        "order_id", "data", "customer_id", "location_id", "canal", "status",
        "subtotal", "desconto", "total", "eh_futuro",
    )


# What a line of the fact takes from its order.
LINE_HEAD = ("data", "customer_id", "location_id", "canal", "status")


def fct_order_item(items: DataFrame, orders: DataFrame | None = None, more: Sequence[str] = ()) -> DataFrame:
    """Line grain: mix and margin. It has no order total, which would invite summing it.

    Without ``orders`` the items carry ``LINE_HEAD`` themselves. ``more`` names columns of the items that stay.
    """
    if orders is not None:
        items = items.join(orders.select("order_id", *LINE_HEAD), "order_id")
    return items.select(
        "order_item_id", "order_id", "data", "customer_id", "location_id", "canal", "status",
        "product_id", "product_variant_id", "quantidade", "preco_unitario", "valor_linha",
        "custo", "desconto_rateado", "margem_bruta", "margem_liquida", *more,
    )


def fct_payment(payments: DataFrame) -> DataFrame:
    return payments.select(
        "payment_id", "order_id", F.to_date("data_pagamento").alias("data"),
        "metodo", "parcelas", "valor", "status",
    )


def fct_daily_store_sales(orders: DataFrame, channel: str = STORE_CHANNEL) -> DataFrame:
    return calendar.dense_daily(orders, "data", "total", F.col("canal") == channel)


def fct_return(returns: DataFrame, items: DataFrame, variants: DataFrame | None = None) -> DataFrame:
    """Returned lines with their product; items have one row per line.

    With ``variants`` the items name their variant alone, and only the returned ones meet it.
    """
    refund = F.round(F.col("quantidade") * F.col("valor_unitario_reembolso"), 2).cast(MONEY)
    if variants is None:
        found = returns.join(items.select("order_item_id", "product_id"), "order_item_id", "left")
    else:
        found = returns.join(items.select("order_item_id", "product_variant_id"), "order_item_id", "left") \
            .join(variants.select("product_variant_id", "product_id"), "product_variant_id", "left")
    return found.select(
        "return_item_id", "return_id", "order_id", "customer_id", "data", "product_id",
        "quantidade", "acao", refund.alias("valor_reembolso"), "motivo", "status",
    )


def fct_stock(stock: DataFrame, variants: DataFrame) -> DataFrame:
    value = F.round(F.col("quantidade_em_maos") * F.col("cost_price"), 2).cast(MONEY)
    return stock.join(
        variants.select("product_variant_id", "product_id", "cost_price"), "product_variant_id"
    ).select(
        "product_variant_id", "product_id", "location_id", "quantidade_em_maos",
        "ponto_de_reposicao", value.alias("valor_em_estoque"),
    )


def daily_store_view(daily: DataFrame, dates: DataFrame) -> DataFrame:
    """Dense store days with their calendar names, for the weekday reports."""
    attributes = dates.select(
        "data", "num_dia_semana", F.col("dia_semana").alias("nome_dia_semana"), "ano",
        F.col("num_mes").alias("mes"),
    )
    return daily.join(attributes, "data").select(
        "data", "num_dia_semana", "nome_dia_semana", "ano", "mes",
        "valor_venda", "qtd_pedidos", "dia_sem_venda",
    )


def margin_totals(items: DataFrame) -> DataFrame:
    """Reference totals of the line fact."""
    wide = "decimal(28,2)"
    value, gross, net = F.sum("valor_linha"), F.sum("margem_bruta"), F.sum("margem_liquida")
    return items.agg(
        value.cast(wide).alias("receita_bruta_itens"),
        gross.cast(wide).alias("margem_bruta"),
        percent(gross, value).alias("pct_margem_bruta"),
        F.sum("desconto_rateado").cast(wide).alias("desconto"),
        net.cast(wide).alias("margem_liquida"),
        percent(net, value).alias("pct_margem_liquida"),
    )
