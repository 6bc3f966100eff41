"""Customer metrics, category diversity and the elite group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions.numbers import mean_money, percent
from tillstar.operators.ranking import top_k, top_k_positions

TOTAL = "decimal(28,2)"


def order_metrics(orders: DataFrame) -> DataFrame:
    """Revenue, order count and mean ticket per customer, from orders alone (no join)."""
    return orders.groupBy("customer_id").agg(
        F.sum("total").cast(TOTAL).alias("faturamento_total"),
        F.count(F.lit(1)).alias("frequencia"),
    ).withColumn("ticket_exato", F.try_divide(
        F.col("faturamento_total"), F.col("frequencia").cast("decimal(10,0)")
    )).withColumn("ticket_medio", mean_money(F.col("faturamento_total"), F.col("frequencia")))


def line_products(items: DataFrame, variants: DataFrame, products: DataFrame, variant: str = "product_variant_id") -> DataFrame:
    """Lines with product and category: variants meet their products first, so the lines are joined once.

    Columns: ``variants(id, product_id)``, ``products(id, category_id)``; a variant without product has no category.
    Variants are shuffled to their products: before they are made, Spark may take many for few and send them all to the driver.
    """
    category = products.select(F.col("id").alias("_product"), "category_id")
    hop = variants.select(F.col("id").alias("_variant"), "product_id").hint("merge") \
        .join(category, F.col("product_id") == F.col("_product"), "left")
    return items.join(hop.drop("_product"), F.col(variant) == F.col("_variant")).drop("_variant")


def category_diversity(orders: DataFrame, lines: DataFrame, products: DataFrame | None = None) -> DataFrame:
    """Distinct categories bought per customer.

    Lines shrink to distinct (order, category) pairs before they meet the orders, and to
    distinct (customer, category) pairs before they are counted, so neither a long order nor
    a busy customer reaches one task whole. Columns: ``orders(order_id, customer_id)``, and either
    ``lines(order_id, category_id)`` or ``lines(order_id, product_id)`` with ``products(product_id, category_id)``.
    """
    if products is not None:
        lines = lines.select("order_id", "product_id").join(products.select("product_id", "category_id"), "product_id")
    in_order = lines.filter(F.col("category_id").isNotNull()).select("order_id", "category_id").distinct()
    pairs = in_order.join(orders.select("order_id", "customer_id"), "order_id") \
        .select("customer_id", "category_id").distinct()
    return pairs.groupBy("customer_id").agg(F.count(F.lit(1)).alias("diversidade_categorias"))


def customer_ranking(metrics: DataFrame, diversity: DataFrame) -> DataFrame:
    """All customers with orders; diversity is 0 for those without lines."""
    return metrics.join(diversity, "customer_id", "left").select(
        "customer_id", "faturamento_total", "frequencia", "ticket_medio",
        F.coalesce("diversidade_categorias", F.lit(0)).alias("diversidade_categorias"),
    )


def _by_ticket() -> tuple[Column, ...]:
    return F.desc("ticket_exato"), F.asc("customer_id")


def eligible(metrics: DataFrame, diversity: DataFrame, min_categories: int) -> DataFrame:
    return metrics.join(diversity.filter(F.col("diversidade_categorias") >= min_categories), "customer_id")


def elite_ranking(metrics: DataFrame, diversity: DataFrame, min_categories: int, k: int = 10) -> DataFrame:
    """The k highest mean tickets among customers with enough categories, with positions.

    The threshold applies before the limit; equal tickets go to the smaller id.
    """
    return top_k_positions(eligible(metrics, diversity, min_categories), _by_ticket(), k, "posicao").select(
        "posicao", "customer_id", "faturamento_total", "frequencia", "ticket_medio", "diversidade_categorias"
    )


def elite_ids(metrics: DataFrame, diversity: DataFrame, min_categories: int, k: int = 10) -> DataFrame:
    return top_k(eligible(metrics, diversity, min_categories), _by_ticket(), k).select("customer_id")


def group_consumption(
    group: DataFrame, orders: DataFrame, lines: DataFrame, categories: DataFrame,
    variants: DataFrame | None = None, products: DataFrame | None = None,
) -> DataFrame:
    """What a group of customers bought, by category. Whether the group is broadcast is left to its size.

    With ``variants`` and ``products`` (see ``line_products``) the lines name their variant alone, and only the group's meet it.
    """
    theirs = orders.select("order_id", "customer_id").join(group, "customer_id")
    if variants is None:
        met = lines.select("order_id", "category_id", "quantidade").join(theirs, "order_id")
    else:
        met = line_products(lines.select("order_id", "product_variant_id", "quantidade").join(theirs, "order_id"), variants, products)
    bought = met.groupBy("category_id").agg(
        F.sum("quantidade").alias("total_itens_comprados"),
        F.count(F.lit(1)).alias("linhas_de_item"),
        F.count_distinct("customer_id").alias("clientes_do_grupo"),
    )
    return bought.join(categories.select("category_id", "categoria"), "category_id").select(
        "category_id", "categoria", "total_itens_comprados", "linhas_de_item", "clientes_do_grupo"
    )


def diversity_histogram(diversity: DataFrame, min_categories: int) -> DataFrame:
    """Customers per number of categories, their share, and how many pass the threshold.

    The windows run over one row per number of categories.
    """
    everyone = Window.partitionBy()
    passing = F.when(F.col("categorias_distintas") >= min_categories, F.col("clientes")).otherwise(0)
    return diversity.groupBy(F.col("diversidade_categorias").alias("categorias_distintas")).agg(
        F.count(F.lit(1)).alias("clientes")
    ).select(
        "categorias_distintas",
        "clientes",
        percent(F.col("clientes"), F.sum("clientes").over(everyone)).alias("pct"),
        F.sum(passing).over(everyone).alias("passam_no_filtro"),
    )


def fan_out_proof(orders: DataFrame, lines: DataFrame, payments: DataFrame) -> DataFrame:
    """Order money summed correctly, and summed after joins that repeat orders.

    The repeated sums are taken as total times rows per order, which is what the join would
    add up, with the detail side counted per order first.
    """

    def labelled(label: str, df: DataFrame, amount) -> DataFrame:
        return df.agg(F.sum(amount).cast(TOTAL).alias("faturamento")).select(
            F.lit(label).alias("metodo"), "faturamento"
        )

    def repeated(detail: DataFrame) -> DataFrame:
        per_order = detail.groupBy("order_id").agg(F.count(F.lit(1)).alias("_rows"))
        return orders.select("order_id", "total").join(per_order, "order_id")

    times = F.col("total") * F.col("_rows").cast("decimal(12,0)")
    return (
        labelled("orders", orders, F.col("total"))
        .unionByName(labelled("orders_x_lines", repeated(lines), times))
        .unionByName(labelled("orders_x_payments", repeated(payments), times))
    )
