"""The cleaned layer: junk becomes NULL plus a flag, and no row is dropped."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.functions.numbers import MONEY
from tillstar.functions.text import (
    display_label,
    fix_all_caps,
    is_junk,
    is_shouting,
    label_or_id,
    null_if_junk,
)
from tillstar.operators.allocate import allocate
from tillstar.operators.skew import HOT_GROUP_ROWS, with_group_totals

# Statuses that count as revenue, and the one that counts as paid.
REVENUE_STATUSES = ("paid", "confirmed")
PAID_STATUS = "paid"


def clean_categories(categories: DataFrame) -> DataFrame:
    return categories.select(
        F.col("id").alias("category_id"),
        fix_all_caps("name").alias("categoria"),
        is_shouting("name").alias("flag_capitalizacao_corrigida"),
        "parent_category_id",
        "is_active",
    )


def clean_products(products: DataFrame, hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    counted = with_group_totals(
        products, ["name"], F.count(F.lit(1)).alias("_same_name"), hot_rows=hot_rows
    )
    return counted.select(
        F.col("id").alias("product_id"),
        F.col("name").alias("nome_bruto"),
        null_if_junk("name").alias("nome"),
        display_label("id", "name", "_same_name").alias("nome_exibicao"),
        is_junk("name").alias("flag_nome_suspeito"),
        (F.col("_same_name") > 1).alias("flag_homonimo"),
        "brand_id",
        "category_id",
        "is_active",
    )


def clean_variants(variants: DataFrame) -> DataFrame:
    return variants.select(
        F.col("id").alias("product_variant_id"),
        "product_id", "sku", "sale_price", "cost_price", "weight_kg", "is_active",
    )


def clean_customers(customers: DataFrame) -> DataFrame:
    return customers.select(
        F.col("id").alias("customer_id"),
        "person_type",
        null_if_junk("legal_name").alias("razao_social"),
        label_or_id("id", "legal_name").alias("nome_exibicao"),
        is_junk("legal_name").alias("flag_nome_suspeito"),
        null_if_junk("trade_name").alias("nome_fantasia"),
        "tax_id",
        null_if_junk("email").alias("email"),
        "is_active",
        "created_at",
    )


def clean_locations(locations: DataFrame) -> DataFrame:
    return locations.select(
        F.col("id").alias("location_id"),
        F.col("name").alias("local"),
        F.col("location_type").alias("tipo_local"),
        F.col("city").alias("cidade"),
        F.col("state").alias("uf"),
        "is_active",
    )


def clean_orders(orders: DataFrame, as_of: datetime) -> DataFrame:
    """Order headers with their date and flags; "future" means later than ``as_of``."""
    return orders.select(
        F.col("id").alias("order_id"),
        "order_number",
        F.col("channel").alias("canal"),
        "customer_id",
        "salesperson_id",
        "location_id",
        "status",
        "subtotal",
        F.col("discount_amount").alias("desconto"),
        "total",
        F.col("created_at").alias("data_pedido"),
        F.to_date("created_at").alias("data"),
        F.col("status").isin(*REVENUE_STATUSES).alias("eh_receita_efetivada"),
        (F.col("status") == PAID_STATUS).alias("eh_pago"),
        (F.col("created_at") > F.lit(as_of).cast("timestamp_ntz")).alias("eh_futuro"),
    )


def clean_items(
    items: DataFrame, orders: DataFrame, variants: DataFrame, hot: DataFrame | None = None, hot_rows: int = HOT_GROUP_ROWS,
    of_order: Sequence[str] = (), of_variant: Sequence[str] = (),
) -> DataFrame:
    """Order lines with their part of the order discount, cost and margins.

    ``orders`` and ``variants`` are the cleaned tables. Gross margin is line value minus cost;
    net margin also takes off the allocated discount. Lines meet their order and their variant once each;
    ``of_order`` and ``of_variant`` name columns that they take along from there.
    """
    lines = items.select(
        F.col("id").alias("order_item_id"),
        "order_id",
        "product_variant_id",
        F.col("quantity").alias("quantidade"),
        F.col("unit_price").alias("preco_unitario"),
        F.col("line_total").alias("valor_linha"),
    )
    allocated = allocate(
        lines, orders, "order_id", "valor_linha", "desconto", ["order_item_id"],
        name="desconto_rateado", hot=hot, hot_rows=hot_rows, carry=of_order,
    )
    cost = F.col("quantidade").cast("decimal(12,0)") * F.col("cost_price").cast(MONEY)
    gross = F.round(F.col("valor_linha") - cost, 2).cast(MONEY)
    return allocated.join(
        variants.select("product_variant_id", "product_id", "cost_price", *of_variant), "product_variant_id"
    ).select(
        "order_item_id", "order_id", "product_variant_id", "product_id",
        "quantidade", "preco_unitario", "valor_linha", "desconto_rateado",
        F.round(cost, 2).cast(MONEY).alias("custo"),
        gross.alias("margem_bruta"),
        (gross - F.col("desconto_rateado")).cast(MONEY).alias("margem_liquida"),
        *of_order, *of_variant,
    )


def clean_payments(payments: DataFrame) -> DataFrame:
    """Payments on their own: an order may have several, so they are never joined to lines."""
    return payments.select(
        F.col("id").alias("payment_id"),
        "order_id",
        F.col("method").alias("metodo"),
        F.col("installments").alias("parcelas"),
        F.col("amount").alias("valor"),
        "status",
        F.col("paid_at").alias("data_pagamento"),
    )


def clean_returns(returns: DataFrame, return_items: DataFrame) -> DataFrame:
    heads = returns.select(
        F.col("id").alias("return_id"), "order_id", "customer_id", "status",
        null_if_junk("reason").alias("motivo"), F.to_date("created_at").alias("data"),
    )
    return return_items.join(heads, "return_id").select(
        F.col("id").alias("return_item_id"),
        "return_id", "order_id", "customer_id", "order_item_id",
        F.col("quantity").alias("quantidade"),
        F.col("action").alias("acao"),
        F.col("unit_refund_amount").alias("valor_unitario_reembolso"),
        "status", "motivo", "data",
    )


def clean_stock(stock: DataFrame) -> DataFrame:
    """Stock levels; the reorder point gets the type it would have if it held data."""
    return stock.select(
        "product_variant_id",
        "location_id",
        F.col("quantity_on_hand").alias("quantidade_em_maos"),
        F.nullif(F.trim("reorder_point"), F.lit("")).try_cast("int").alias("ponto_de_reposicao"),
        "updated_at",
    )
