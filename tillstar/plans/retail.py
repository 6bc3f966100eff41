"""The layers of the retail warehouse: loaded tables -> cleaned tables -> star schema.

Each layer is a lazy set of frames. Pass published tables of one layer (see
``tillstar.sources.publish``) to the next to build them one after the other, or chain the
layers directly and let Spark plan the whole way from the source files.
"""

from __future__ import annotations

from collections.abc import Mapping
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.operators import cleaning, customers, star
from tillstar.operators.skew import HOT_GROUP_ROWS
from tillstar.sources.tables import Tables

GOLD_TABLES = (
    "dim_data", "dim_cliente", "dim_produto", "dim_local", "dim_canal", "dim_status_pedido",
    "fct_pedido", "fct_item_pedido", "fct_pagamento", "fct_venda_diaria_pos", "fct_devolucao",
    "fct_estoque_atual",
)


def silver(
    raw: Mapping[str, DataFrame], as_of: datetime, hot_rows: int = HOT_GROUP_ROWS, hot_orders: DataFrame | None = None,
) -> Tables:
    """The ten cleaned tables."""
    tables: Tables
    tables = Tables({
        "categorias": lambda: cleaning.clean_categories(raw["categories"]),
        "produtos": lambda: cleaning.clean_products(raw["products"], hot_rows),
        "variantes": lambda: cleaning.clean_variants(raw["product_variants"]),
        "clientes": lambda: cleaning.clean_customers(raw["customers"]),
        "locais": lambda: cleaning.clean_locations(raw["locations"]),
        "pedidos": lambda: cleaning.clean_orders(raw["orders"], as_of),
        "itens_pedido": lambda: cleaning.clean_items(
            raw["order_items"], tables["pedidos"], tables["variantes"], hot_orders, hot_rows),
        "pagamentos": lambda: cleaning.clean_payments(raw["payments"]),
        "devolucoes": lambda: cleaning.clean_returns(raw["returns"], raw["return_items"]),
        "estoque": lambda: cleaning.clean_stock(raw["stock_levels"]),
    })
    return tables


def lines_with_product(raw: Mapping[str, DataFrame], *columns: str) -> DataFrame:
    """Product and category of each order line, by its variant, with further ``columns`` of the line."""
    lines = raw["order_items"].select(F.col("id").alias("order_item_id"), "order_id", "product_variant_id", *columns)
    return customers.line_products(lines, raw["product_variants"], raw["products"])


def lines_with_heads(raw: Mapping[str, DataFrame], silver: Mapping[str, DataFrame], products: DataFrame | None = None) -> DataFrame:
    """The cleaned lines with what the line fact takes from their order, which they meet once, in the allocation.

    With ``products`` (the dimension) they also have its columns: variants meet their product first, so the lines meet both at once.
    """
    variants, more = silver["variantes"], []
    if products is not None:
        variants, more = variants.join(products, "product_id", "left"), [c for c in products.columns if c != "product_id"]
    return cleaning.clean_items(raw["order_items"], silver["pedidos"], variants, of_order=star.LINE_HEAD, of_variant=more)


def gold(
    silver: Mapping[str, DataFrame], brands: DataFrame, as_of: datetime,
    min_categories: int = star.MIN_CATEGORIES, elite_size: int = star.ELITE_SIZE,
    raw: Mapping[str, DataFrame] | None = None,
) -> Tables:
    """The star schema: six dimensions, six facts and the daily store view.

    Where the layers are chained without publishing them, ``raw``, the tables that ``silver`` was made of, saves work: the
    line fact is made with its order at hand (``lines_with_heads``), and tables that need only product and category of a
    line allocate no discounts for it.
    """
    s, chained = silver, raw is not None
    tables: Tables
    tables = Tables({
        "dim_data": lambda: star.dim_date(s["pedidos"], s["devolucoes"], as_of.date()),
        "dim_cliente": lambda: star.dim_customer(
            s["clientes"], s["pedidos"], lines_with_product(raw) if chained else s["itens_pedido"],
            None if chained else s["produtos"], min_categories, elite_size),
        "dim_produto": lambda: star.dim_product(s["produtos"], s["categorias"], brands),
        "dim_local": lambda: star.dim_location(s["locais"]),
        "dim_canal": lambda: star.dim_channel(s["pedidos"]),
        "dim_status_pedido": lambda: star.dim_status(brands.sparkSession),
        "fct_pedido": lambda: star.fct_order(s["pedidos"]),
        "fct_item_pedido": lambda: star.fct_order_item(lines_with_heads(raw, s)) if chained
        else star.fct_order_item(s["itens_pedido"], s["pedidos"]),
        "fct_pagamento": lambda: star.fct_payment(s["pagamentos"]),
        "fct_venda_diaria_pos": lambda: star.fct_daily_store_sales(s["pedidos"]),
        "fct_devolucao": lambda: star.fct_return(s["devolucoes"], raw["order_items"].select(
            F.col("id").alias("order_item_id"), "product_variant_id"), s["variantes"]) if chained
        else star.fct_return(s["devolucoes"], s["itens_pedido"]),
        "fct_estoque_atual": lambda: star.fct_stock(s["estoque"], s["variantes"]),
        "vw_venda_diaria_pos": lambda: star.daily_store_view(
            tables["fct_venda_diaria_pos"], tables["dim_data"]),
    })
    return tables


def control_totals(raw: Mapping[str, DataFrame]) -> dict[str, Column]:
    """What the layers must reproduce, as scalars from the sources: rows, revenue, discount, store days and empty days."""
    orders, items = raw["orders"], raw["order_items"]
    rows = lambda df: df.agg(F.count(F.lit(1))).scalar()
    discounted = orders.join(items.select(F.col("order_id").alias("id")).distinct(), "id", "left_semi")
    day = F.to_date("created_at")
    store = orders.filter(F.col("channel") == star.STORE_CHANNEL)
    days = store.agg(F.date_diff(F.max(day), F.min(day)) + 1).scalar()
    return {
        "orders": rows(orders), "items": rows(items), "revenue": orders.agg(F.sum("total")).scalar(),
        "discount": discounted.agg(F.sum("discount_amount")).scalar(), "store_days": days,
        "empty_days": days - store.agg(F.count_distinct(day)).scalar(),
    }
