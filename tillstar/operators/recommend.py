"""Cross-sell: rules of given items with support, confidence and lift; recommendations judged on held-out orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions.numbers import ratio
from tillstar.operators.ranking import number_all_rows
from tillstar.operators.similarity import cosine_rows, interactions
from tillstar.session import kept_table

# Positions of one list that are broadcast; a longer one is shuffled.
BROADCAST_POSITIONS = 200_000


def basket_rules(lines: DataFrame, references: DataFrame, min_orders: int, order: str = "order_id", item: str = "product_id") -> DataFrame:
    """Rules ``reference -> item`` from the orders that hold both: counts, support, confidence and lift.

    ``references`` has a column ``item``. Items, references and pairs in fewer than ``min_orders`` orders are left out;
    the items before any pair is made, since a pair cannot be more frequent than its items. Lines without order or item
    do not count, repeated ones count once. Only orders with a reference are expanded, by the references they hold, so
    the work is linear in their lines; an order of any size is rows of an equi-join that can be split.
    """
    baskets = lines.select(F.col(order).alias("order_id"), F.col(item).alias("item")).filter("order_id is not null and item is not null").distinct()
    baskets = kept_table(baskets, "baskets")
    total = baskets.select("order_id").distinct().agg(F.count(F.lit(1))).scalar()
    frequent = baskets.groupBy("item").agg(F.count(F.lit(1)).alias("pedidos_item")).filter(F.col("pedidos_item") >= min_orders)
    named = references.select(F.col("item").alias("reference")).distinct()
    asked = frequent.join(named, F.col("item") == F.col("reference")).select("reference", F.col("pedidos_item").alias("pedidos_referencia"))
    holding = baskets.join(asked, F.col("item") == F.col("reference")).select("order_id", "reference", "pedidos_referencia")
    pairs = baskets.join(frequent, "item").join(holding, "order_id").filter(F.col("item") != F.col("reference"))
    both = pairs.groupBy("reference", "pedidos_referencia", "item", "pedidos_item").agg(F.count(F.lit(1)).alias("pedidos_ambos"))
    kept = both.filter(F.col("pedidos_ambos") >= min_orders).withColumn("pedidos", total)
    return kept.select(
        "reference", "item", "pedidos", "pedidos_referencia", "pedidos_item", "pedidos_ambos",
        ratio(F.col("pedidos_ambos"), F.col("pedidos")).alias("suporte"),
        ratio(F.col("pedidos_ambos"), F.col("pedidos_referencia")).alias("confianca"),
        F.try_divide(F.col("pedidos_ambos").cast("double") * F.col("pedidos"), F.col("pedidos_referencia").cast("double") * F.col("pedidos_item")).alias("lift"))


def top_rules(rules: DataFrame, n: int) -> DataFrame:
    """The ``n`` rules of every reference with the highest lift; then more common orders, then the smaller item."""
    order = Window.partitionBy("reference").orderBy(F.desc("lift"), F.desc("pedidos_ambos"), "item")
    return rules.withColumn("posicao", F.row_number().over(order)).filter(F.col("posicao") <= n)


def last_orders(purchases: DataFrame, customer: str = "customer_id", order: str = "order_id", ts: str = "data_pedido") -> DataFrame:
    """Every customer's latest order (of equal times the larger id) and the number of its orders."""
    heads = purchases.select(F.col(customer).alias("customer_id"), F.col(order).alias("order_id"), F.col(ts).alias("_ts")) \
        .filter("customer_id is not null and order_id is not null").distinct()
    return heads.groupBy("customer_id").agg(
        F.max(F.struct("_ts", "order_id"))["order_id"].alias("held_order"), F.count_distinct("order_id").alias("orders"))


def _hits(asked: DataFrame, lists: DataFrame, on: list[str], k: int) -> Column:
    """Held-out items among the first ``k`` that a customer does not own, in ``lists`` (``on``, position from 1), as a scalar.

    ``asked`` has the items of a customer, owned or held. A held item at position p with b owned ones before it is the
    (p - b)th new one, so only positions up to k beyond the number of owned items (``_s``) count, and no list is
    copied for a customer.
    """
    placed = asked.join(lists, on).filter(F.col("position") <= F.col("_s") + k)
    owned = F.count_if(~F.col("held")).over(Window.partitionBy("customer_id").orderBy("position"))
    return placed.withColumn("_owned", owned).agg(F.count_if(F.col("held") & (F.col("position") - F.col("_owned") <= k))).scalar()


def precision_at_k(purchases: DataFrame, references: DataFrame, k: int = 5, customer: str = "customer_id", item: str = "product_id",
                   order: str = "order_id", ts: str = "data_pedido") -> DataFrame:
    """One row: how often k recommended items are in the customer's held-out order, against the k most popular ones.

    The latest order of every customer is held out; all else is history, and the only thing models see. A customer with one
    order has none, and one whose history lacks every reference (``references``, column ``item``) cannot be served;
    both are counted apart, the others judged. The model takes the reference bought last (of equal times the smaller
    one) and recommends the items most similar to it, the baseline those with most buyers; neither recommends what the
    customer has. Precision divides by k, also where there are fewer items. Equal values go to the smaller item.

    Owned and held items learn their positions and are counted (``_hits``), so the work is linear in the pairs of
    customers and items, whatever k is. Tables of customers and their items are shuffled, never broadcast: they are
    stored in far less room than they take in memory.
    """
    rows = purchases.select(F.col(customer).alias("customer_id"), F.col(item).alias("item"), F.col(order).alias("order_id"), F.col(ts).alias("_ts")) \
        .filter("customer_id is not null and item is not null and order_id is not null")
    last = kept_table(last_orders(rows, ts="_ts"), "last-orders")
    marked = rows.join(last.select(F.col("held_order").alias("order_id"), F.lit(True).alias("_held")), "order_id", "left")
    marked = kept_table(marked.select("customer_id", "item", "_ts", F.coalesce("_held", F.lit(False)).alias("held")), "holdout")
    history = marked.filter("not held")
    bought = kept_table(interactions(history, item="item"), "history")
    held = marked.filter("held").select("customer_id", "item").distinct()
    sizes = bought.groupBy("customer_id").agg(F.count(F.lit(1)).alias("_s"))
    named = references.select("item").distinct()
    latest = history.join(named, "item", "left_semi").groupBy("customer_id").agg(
        F.max(F.struct("_ts", (-F.col("item")).alias("_i")))["_i"].alias("_i")).select("customer_id", (-F.col("_i")).alias("reference"))
    judged = kept_table(latest.join(sizes, "customer_id").select("customer_id", "reference", "_s"), "judged")
    new = held.join(bought.hint("merge"), ["customer_id", "item"], "left_anti")
    items = bought.select("customer_id", "item", F.lit(False).alias("held")).unionByName(new.withColumn("held", F.lit(True)))
    asked = kept_table(items.join(judged.hint("merge"), "customer_id"), "asked")
    # Nobody looks beyond this position of a list.
    reach = (judged.agg(F.max("_s")).first()[0] or 0) + k

    popular = number_all_rows(bought.groupBy("item").agg(F.count(F.lit(1)).alias("n")), [F.desc("n"), F.asc("item")])
    similar = cosine_rows(bought, named).filter(F.col("reference") != F.col("item"))
    listed = number_all_rows(similar.select("reference", "item", "similaridade"), [F.asc("reference"), F.desc("similaridade"), F.asc("item")], "_place")
    listed = kept_table(listed, "similar-lists")
    starts = listed.groupBy("reference").agg(F.min("_place").alias("_first"))
    listed = listed.join(starts, "reference").select("reference", "item", (F.col("_place") - F.col("_first") + 1).alias("position"))
    listed = listed.filter(F.col("position") <= reach).hint("merge")
    # At most ``reach`` rows.
    first = popular.filter(F.col("position") <= reach).select("item", "position")
    first = F.broadcast(first) if reach <= BROADCAST_POSITIONS else first.hint("merge")

    counts = last.agg(F.count(F.lit(1)).alias("clientes"), F.count_if(F.col("orders") == 1).alias("sem_historico"))
    served = judged.agg(F.count(F.lit(1))).scalar()
    result = counts.select(
        F.lit(k).alias("k"), "clientes", "sem_historico", (F.col("clientes") - F.col("sem_historico") - served).alias("sem_referencia"),
        served.alias("julgados"), _hits(asked, listed, ["reference", "item"], k).alias("acertos_modelo"),
        _hits(asked, first, ["item"], k).alias("acertos_popularidade"))
    return result.select("*", *[ratio(F.col(f"acertos_{m}"), F.col("julgados") * k).alias(f"precisao_{m}") for m in ("modelo", "popularidade")])
