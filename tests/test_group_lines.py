"""Variants are not sent to the driver because Spark takes them for few, and only a group's lines meet them."""

from helpers import rows
from pyspark.sql import functions as F

from tillstar.operators.customers import group_consumption, line_products
from tillstar.plans.queries_analysis import elite_consumption
from tillstar.plans.registry import Context

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_variants_are_not_broadcast(spark):
    """Fifty variants a product, which Spark reckons as one."""
    products = spark.range(20).select("id", (F.col("id") % 3).alias("category_id"))
    each = spark.range(20).select(F.col("id").alias("product_id"), F.explode(F.sequence(F.lit(0), F.lit(49))).alias("n"))
    variants = each.select((F.col("n") * 20 + F.col("product_id")).alias("id"), "product_id")
    lines = spark.range(5).select((F.col("id") * 210).alias("product_variant_id"))
    found = line_products(lines, variants, products)
    assert "SortMergeJoin [product_id#" in _plan(found)
    assert rows(found, "product_variant_id", "category_id") == [(0, 0), (210, 1), (420, 0), (630, 1), (840, 0)]


def test_only_lines_of_the_group_meet_their_variant(spark):
    """Also lines that come twice, and those without order, variant, product or category."""
    lines = [(o, v, 1 + (o or 0) + (v or 0)) for o in (1, 2, 3, None, 9) for v in (10, 11, 12, 13, 99, None)]
    lines = spark.createDataFrame(lines + lines[:4], "order_id long, product_variant_id long, quantidade int")
    orders = spark.createDataFrame([(1, 7), (2, 8), (3, 5), (9, None)], "order_id long, customer_id long")
    variants = spark.createDataFrame([(10, 1), (11, 2), (12, 3), (13, None), (None, 1)], "id long, product_id long")
    products = spark.createDataFrame([(1, 100), (2, 200), (3, None)], "id long, category_id long")
    categories = spark.createDataFrame([(100, "a"), (200, "b"), (300, "c")], "category_id long, categoria string")
    group = spark.createDataFrame([(7,), (8,)], "customer_id long")
    whole = group_consumption(group, orders, line_products(lines, variants, products), categories)
    few = group_consumption(group, orders, lines, categories, variants, products)
    assert rows(few) == rows(whole) and few.count() == 2


def test_the_query_meets_orders_first(spark):
    """The lines of the consumption meet the group's orders before the variants."""
    plan = elite_consumption(Context(spark, SF))._jdf.queryExecution().optimizedPlan().toString().splitlines()
    at = [i for i, row in enumerate(plan) if "Join Inner, (order_id#" in row or "Join Inner, (product_variant_id#" in row]
    assert "product_variant_id#" in plan[at[0]] and "order_id#" in plan[at[1]]
