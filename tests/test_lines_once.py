"""Lines meet their order and their variant once, with the same rows as by joining them again."""

from decimal import Decimal

import pytest
from helpers import rows

from tillstar.operators import star
from tillstar.operators.cleaning import clean_items
from tillstar.operators.skew import hot_keys
from tillstar.plans.registry import Context

SF = "/root/testdata/sf0.001"
MONEY = "decimal(18,2)"


@pytest.fixture(scope="module")
def raw(spark):
    """Lines of four orders: two have one without variant, one order is not known."""
    money = lambda n: Decimal(n) / 100
    items = [(f"l{i}", i % 4, 99 if i % 5 == 0 else i % 3, i, money(100 + i), money(1000 * i + 7)) for i in range(30)]
    orders = [(o, f"d{o}", 10 + o, o % 2, "pos", "paid", money(100 * o + 1)) for o in range(3)]
    return {
        "items": spark.createDataFrame(items, f"id string, order_id long, product_variant_id long, quantity int, unit_price {MONEY}, line_total {MONEY}"),
        "orders": spark.createDataFrame(orders, f"order_id long, data string, customer_id long, location_id int, canal string, status string, desconto {MONEY}"),
        "variants": spark.createDataFrame([(v, v // 2, money(50 * v)) for v in range(3)], f"product_variant_id long, product_id long, cost_price {MONEY}"),
        "products": spark.createDataFrame([(0, "a")], "product_id long, categoria string"),
    }


@pytest.mark.parametrize("hot_rows", [3, 1000])
def test_lines_take_columns_of_their_order_and_variant(raw, hot_rows):
    lines = raw["items"].withColumnRenamed("id", "order_item_id")
    hot = hot_keys(lines, ["order_id"], hot_rows) if hot_rows < 30 else None
    plain = star.fct_order_item(clean_items(raw["items"], raw["orders"], raw["variants"]), raw["orders"])
    wide = clean_items(
        raw["items"], raw["orders"], raw["variants"].join(raw["products"], "product_id", "left"), hot,
        of_order=star.LINE_HEAD, of_variant=["categoria"])
    assert rows(star.fct_order_item(wide)) == rows(plain)
    joined = star.join_dims({"fct_item_pedido": plain, "dim_produto": raw["products"]}, "fct_item_pedido", ["dim_produto"])
    held = star.join_dims({"fct_item_pedido": star.fct_order_item(wide, more=["categoria"])}, "fct_item_pedido", ["dim_produto"], ["dim_produto"])
    assert rows(held, "order_item_id", "data", "categoria", "desconto_rateado") == rows(joined, "order_item_id", "data", "categoria", "desconto_rateado")
    assert plain.count() == 18


def test_the_line_fact_joins_lines_twice(spark):
    """Once to their orders and once to their variants."""
    plan = Context(spark, SF).gold["fct_item_pedido"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join Inner") == 2 and plan.count("Relation [o_orderkey") == 1


def test_returned_lines_alone_meet_their_variant(spark, raw):
    """Also returned lines that are not known, or whose variant is not."""
    back = spark.createDataFrame(
        [(f"r{i}", i // 2, 0, 1, f"l{2 * i}", Decimal(i), Decimal("1.5"), "refund", "open", None, "d") for i in range(20)],
        "return_item_id string, return_id int, order_id int, customer_id int, order_item_id string, quantidade decimal(12,3), "
        f"valor_unitario_reembolso {MONEY}, acao string, status string, motivo string, data string")
    lines = raw["items"].withColumnRenamed("id", "order_item_id")
    whole = star.fct_return(back, lines.join(raw["variants"], "product_variant_id"))
    assert rows(star.fct_return(back, lines, raw["variants"])) == rows(whole)
    assert (whole.count(), whole.filter("product_id is null").count()) == (20, 8)
    plan = Context(spark, SF).gold["fct_devolucao"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftOuter") == 2
