"""The retail source tables, derived by Spark from the star-shaped test tables.

Every table here has the columns of its retail counterpart, so the whole pipeline (cleaning,
star, analyses) runs on the test data exactly as it runs on loaded retail files. Roles that the
test data lacks (junk names, channels, payments, stock) are functions of existing columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.functions.numbers import MONEY, money
from tillstar.sources.tables import Tables

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")

# Variants per product; a supplier number modulo this selects the variant of a line.
VARIANTS = 4


def driver_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables({t: lambda t=t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in DRIVER_TABLES})


def _orders(d: Tables) -> DataFrame:
    key, pri, status = F.col("o_orderkey"), F.col("o_orderpriority"), F.col("o_orderstatus")
    total = money("o_totalprice")
    discount = F.round(total * (key % 11).cast("decimal(2,0)") * F.lit("0.01").cast("decimal(3,2)"), 2).cast(MONEY)
    channel = F.when(pri == "1-URGENT", "pos").when(pri == "2-HIGH", "marketplace").otherwise("ecommerce")
    return d["orders"].select(
        key.alias("id"),
        F.concat(F.lit("PED-"), F.lpad(key.cast("string"), 9, "0")).alias("order_number"),
        channel.alias("channel"),
        F.col("o_custkey").alias("customer_id"),
        F.when(channel != "ecommerce", F.col("o_custkey") % 15 + 1).alias("salesperson_id"),
        (key % 25).alias("location_id"),
        F.when(status == "F", "paid").when(status == "O", "confirmed")
        .when(pri.isin("1-URGENT", "2-HIGH"), "draft").otherwise("cancelled").alias("status"),
        (total + discount).cast(MONEY).alias("subtotal"),
        discount.alias("discount_amount"),
        total.alias("total"),
        F.col("o_orderdate").alias("placed_at"),
        F.col("o_orderdate").alias("created_at"),
        F.when(key % 3 == 0, F.col("o_orderdate") + F.expr("interval 1 day"))
        .otherwise(F.col("o_orderdate")).alias("updated_at"),
    )


def _item_id():
    parts = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    texts = [F.col(c).cast("string") for c in parts] + [F.col("l_quantity").cast("bigint").cast("string")]
    return F.concat_ws("-", *texts)


def _variant_id():
    return F.col("l_partkey") * VARIANTS + F.col("l_suppkey") % VARIANTS


def _unit_price():
    cents = (money("l_extendedprice") * 100).cast("bigint")
    return (F.call_function("div", cents, F.col("l_quantity").cast("bigint")).cast("decimal(16,0)")
            * F.lit("0.01").cast("decimal(3,2)")).cast(MONEY)


def _order_items(d: Tables) -> DataFrame:
    return d["lineitem"].select(
        _item_id().alias("id"),
        F.col("l_orderkey").alias("order_id"),
        _variant_id().alias("product_variant_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        _unit_price().alias("unit_price"),
        money("l_extendedprice").alias("line_total"),
    )


def _products(d: Tables) -> DataFrame:
    key = F.col("p_partkey")
    name = (
        F.when(key % 20 == 3, "?").when(key % 20 == 7, " n/a ").when(key % 20 == 11, "asdf")
        .when(key % 20 == 13, "  ").otherwise(F.col("p_name"))
    )
    return d["part"].select(
        key.alias("id"),
        name.alias("name"),
        F.ascii(F.substring("p_type", 2, 1)).cast("long").alias("brand_id"),
        F.substring("p_brand", 7, 10).cast("long").alias("category_id"),
        (key % 10 != 0).alias("is_active"),
    )


def _product_variants(d: Tables) -> DataFrame:
    price = money("p_retailprice")
    return d["part"].select(
        "p_partkey", price.alias("price"),
        F.explode(F.sequence(F.lit(0), F.lit(VARIANTS - 1))).alias("n"),
    ).select(
        (F.col("p_partkey") * VARIANTS + F.col("n")).alias("id"),
        F.col("p_partkey").alias("product_id"),
        F.concat_ws("-", F.lit("SKU"), F.col("p_partkey").cast("string"), F.col("n").cast("string")).alias("sku"),
        F.col("price").alias("sale_price"),
        F.round(F.col("price") * F.lit("0.6").cast("decimal(2,1)"), 2).cast(MONEY).alias("cost_price"),
        (F.col("n").cast("decimal(7,3)") + F.lit("0.250").cast("decimal(7,3)")).cast("decimal(7,3)").alias("weight_kg"),
        (F.col("n") != 3).alias("is_active"),
    )


def _categories(d: Tables) -> DataFrame:
    number = F.substring("p_brand", 7, 10).cast("long")
    return d["part"].select(
        number.alias("id"),
        F.when(number % 5 == 0, F.upper("p_brand")).otherwise(F.col("p_brand")).alias("name"),
        F.when(number > 20, number - 20).alias("parent_category_id"),
        (number != 24).alias("is_active"),
    ).distinct()


def _brands(d: Tables) -> DataFrame:
    return d["part"].select(
        F.ascii(F.substring("p_type", 2, 1)).cast("long").alias("id"), F.col("p_type").alias("name")
    ).distinct()


def _customers(d: Tables) -> DataFrame:
    key = F.col("c_custkey")
    return d["customer"].select(
        key.alias("id"),
        F.when(key % 3 == 0, "PJ").otherwise("PF").alias("person_type"),
        F.when(key % 25 == 4, "TBD").when(key % 25 == 9, "Sem Nome").otherwise(F.col("c_name")).alias("legal_name"),
        F.when(key % 4 == 1, "--").otherwise(F.col("c_mktsegment")).alias("trade_name"),
        F.lpad(key.cast("string"), 11, "0").alias("tax_id"),
        F.when(key % 10 == 6, "n/a").otherwise(
            F.concat(F.lit("c"), key.cast("string"), F.lit("@example.com"))).alias("email"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
        F.lit("1994-12-31 00:00:00").cast("timestamp_ntz").alias("created_at"),
    )


def _locations(d: Tables) -> DataFrame:
    return d["nation"].join(d["region"], F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").cast("long").alias("id"),
        F.concat(F.lit("Loja "), F.col("n_name")).alias("name"),
        F.when(F.col("n_nationkey") % 2 == 0, "store").otherwise("warehouse").alias("location_type"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("state"),
        F.lit(True).alias("is_active"),
    )


def _payments(d: Tables) -> DataFrame:
    """Two payments for every seventh order, one for the others: joining them repeats orders."""
    key, total = F.col("o_orderkey"), money("o_totalprice")
    split = key % 7 == 0
    first = F.when(split, F.floor((total * 50).cast("bigint")).cast("decimal(18,0)")
                   * F.lit("0.01").cast("decimal(3,2)")).otherwise(total).cast(MONEY)
    return d["orders"].select(
        key.alias("order_id"), total.alias("total"), first.alias("first"), "o_orderdate", "o_orderstatus",
        F.explode(F.sequence(F.lit(0), F.when(split, 1).otherwise(0))).alias("n"),
    ).select(
        (F.col("order_id") * 2 + F.col("n")).alias("id"),
        "order_id",
        F.when(F.col("n") == 1, "pix").when(F.col("order_id") % 2 == 0, "card").otherwise("boleto").alias("method"),
        (F.col("order_id") % 12 + 1).cast("int").alias("installments"),
        F.when(F.col("n") == 0, F.col("first")).otherwise(F.col("total") - F.col("first")).cast(MONEY).alias("amount"),
        F.when(F.col("o_orderstatus") == "F", "captured").otherwise("pending").alias("status"),
        (F.col("o_orderdate") + F.expr("interval 1 day")).alias("paid_at"),
    )


def _returned(d: Tables) -> DataFrame:
    return d["lineitem"].filter(F.col("l_returnflag") == "R")


def _returns(d: Tables) -> DataFrame:
    heads = _returned(d).groupBy("l_orderkey").agg(F.max("l_shipdate").alias("created_at"))
    return heads.join(d["orders"], F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("l_orderkey").alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.when(F.col("l_orderkey") % 2 == 0, "approved").otherwise("open").alias("status"),
        F.when(F.col("l_orderkey") % 6 == 1, " xxx ").when(F.col("l_orderkey") % 6 == 2, None)
        .otherwise("defeito").alias("reason"),
        "created_at",
    )


def _return_items(d: Tables) -> DataFrame:
    return _returned(d).select(
        _item_id().alias("id"),
        F.col("l_orderkey").alias("return_id"),
        _item_id().alias("order_item_id"),
        F.col("l_quantity").cast("decimal(12,3)").alias("quantity"),
        F.when(F.col("l_linenumber") % 2 == 0, "refund").otherwise("exchange").alias("action"),
        _unit_price().alias("unit_refund_amount"),
    )


def _stock_levels(d: Tables) -> DataFrame:
    return _product_variants(d).select(
        F.col("id").alias("product_variant_id"),
        (F.col("id") % 25).alias("location_id"),
        (F.col("id") % 50).cast("decimal(12,3)").alias("quantity_on_hand"),
        F.when(F.col("id") % 2 == 0, "").otherwise("  ").alias("reorder_point"),
        F.lit("2001-08-01 00:00:00").cast("timestamp_ntz").alias("updated_at"),
    )


def raw_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """The retail source tables over the test tables in ``sf_dir``."""
    d = driver_tables(spark, sf_dir)
    builders = {
        "orders": _orders, "order_items": _order_items, "products": _products,
        "product_variants": _product_variants, "categories": _categories, "brands": _brands,
        "customers": _customers, "locations": _locations, "payments": _payments,
        "returns": _returns, "return_items": _return_items, "stock_levels": _stock_levels,
    }
    return Tables({name: lambda build=build: build(d) for name, build in builders.items()})
