"""Data-quality checks. Each is a frame of (check, expected, actual, ok); nothing is collected
until ``require`` asks whether any failed."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class CheckFailed(AssertionError):
    """At least one check did not hold."""


def _row(df: DataFrame, check: str, expected: Column, actual: Column) -> DataFrame:
    wide = "decimal(28,2)"
    return (
        df.agg(actual.cast(wide).alias("actual"))
        .select(F.lit(check).alias("check"), expected.cast(wide).alias("expected"), "actual")
        .withColumn("ok", F.col("expected").eqNullSafe(F.col("actual")))
    )


def count_is(df: DataFrame, expected: int | Column, check: str) -> DataFrame:
    return _row(df, check, F.lit(expected), F.count(F.lit(1)))


def total_is(df: DataFrame, column: str, expected, check: str) -> DataFrame:
    return _row(df, check, F.lit(expected), F.round(F.sum(column), 2))


def none_of(df: DataFrame, condition: Column, check: str) -> DataFrame:
    """No row satisfies ``condition``."""
    return _row(df, check, F.lit(0), F.count_if(condition))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).filter("rows > 1")


def key_is_unique(df: DataFrame, keys: Sequence[str], check: str) -> DataFrame:
    """No key occurs twice and none is NULL."""
    any_null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return none_of(groups, (F.col("rows") > 1) | any_null, check)


def orphans(many: DataFrame, column: str, one: DataFrame, key: str) -> DataFrame:
    """Distinct non-NULL values of ``many.column`` missing from ``one.key``, with their rows.

    Values are counted before the anti join, so a frequent value travels once.
    """
    values = many.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(
        F.count(F.lit(1)).alias("rows")
    )
    known = one.select(F.col(key).alias("_key"))
    return values.join(known, F.col("value") == F.col("_key"), "left_anti")


def relationship(many: DataFrame, column: str, one: DataFrame, key: str, name: str) -> DataFrame:
    """One row: repeated and NULL keys on the one side, orphan rows on the many side."""
    keys = one.groupBy(F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("rows"))
    bad = keys.agg(
        F.count_if((F.col("rows") > 1) & F.col("_key").isNotNull()).alias("chaves_repetidas"),
        F.coalesce(F.sum(F.when(F.col("_key").isNull(), F.col("rows"))), F.lit(0)).alias("chaves_nulas"),
    )
    lost = orphans(many, column, one, key).agg(F.coalesce(F.sum("rows"), F.lit(0))).scalar()
    return bad.select(F.lit(name).alias("relacao"), "*", lost.alias("orfaos"))


def relationships(many: DataFrame, name: str, edges: Mapping[str, tuple[str, DataFrame, str]]) -> DataFrame:
    """``relationship`` for all ``edges`` (one side: column, its frame, its key) of a fact, in one pass over the fact.

    The key columns are unpivoted and their values counted in the map tasks, so a frequent value travels once.
    Keys are compared as text.
    """
    text = lambda df, c: df[c].cast("string").alias("value")
    cells = F.explode(F.array(*[F.struct(F.lit(one).alias("one"), text(many, c)) for one, (c, _, _) in edges.items()]))
    values = many.select(cells.alias("c")).select("c.*").filter("value is not null").groupBy("one", "value").agg(F.count(F.lit(1)).alias("rows"))
    listed = reduce(lambda a, b: a.unionByName(b), [df.select(F.lit(one).alias("one"), text(df, k)) for one, (_, df, k) in edges.items()])
    keys = listed.groupBy("one", "value").agg(F.count(F.lit(1)).alias("rows"))
    bad = keys.groupBy("one").agg(
        F.count_if((F.col("rows") > 1) & F.col("value").isNotNull()).alias("chaves_repetidas"),
        F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("rows"))), F.lit(0)).alias("chaves_nulas"))
    lost = values.join(keys.select("one", "value"), ["one", "value"], "left_anti").groupBy("one").agg(F.sum("rows").alias("orfaos"))
    # One row per edge, also where one side has no rows at all.
    names = many.sparkSession.range(1).select(F.explode(F.array(*[F.lit(one) for one in edges])).alias("one"))
    numbers = ("chaves_repetidas", "chaves_nulas", "orfaos")
    parts = names.unionByName(bad, allowMissingColumns=True).unionByName(lost, allowMissingColumns=True)
    return parts.groupBy(F.concat(F.lit(f"{name}->"), "one").alias("relacao")).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in numbers])


def allocation_differences(
    lines: DataFrame, headers: DataFrame, key: str, allocated: str, amount: str, tolerance: str = "0.01"
) -> DataFrame:
    """Keys whose allocated parts do not add up to their amount. Expected to be empty."""
    sums = lines.groupBy(key).agg(F.sum(allocated).alias("allocated"))
    return sums.join(headers.select(key, F.col(amount).alias("original")), key).filter(
        F.abs(F.col("allocated") - F.col("original")) > F.lit(tolerance).cast("decimal(18,2)")
    )


def allocation_reconciles(
    lines: DataFrame, headers: DataFrame, key: str, allocated: str, amount: str, check: str
) -> DataFrame:
    """The allocated total equals the total amount of the headers that have lines, to the cent."""
    with_lines = headers.join(lines.select(key).distinct(), key, "left_semi")
    expected = with_lines.agg(F.sum(amount)).scalar()
    return _row(lines, check, expected, F.sum(allocated))


def _exploded(one: DataFrame, checks: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """A check per row from one row of numbers; each is its name, what is expected, what is so."""
    wide = "decimal(28,2)"
    numbers = [x.cast(wide).alias(f"_{side}{i}") for i, (_, e, a) in enumerate(checks) for side, x in (("e", e), ("a", a))]
    cells = F.array(*[F.struct(F.lit(name).alias("check"), F.col(f"_e{i}").alias("expected"), F.col(f"_a{i}").alias("actual"))
                      for i, (name, _, _) in enumerate(checks)])
    rows = one.select(*numbers).select(F.explode(cells).alias("c")).select("c.*")
    return rows.withColumn("ok", F.col("expected").eqNullSafe(F.col("actual")))


def table_checks(
    df: DataFrame, name: str, keys: Sequence[str], rows: int | Column | None = None,
    counts: Mapping[str, tuple[Column, int | Column]] | None = None, totals: Mapping[str, tuple[str, object]] | None = None,
) -> DataFrame:
    """All checks of one table in one pass: its key, number of rows, rows that meet a condition, sums of columns.

    Rows are added up per key in the map tasks, and the keys after the only shuffle. A key with a NULL counts as
    broken. An empty table has no rows and no broken key, and NULL totals.
    """
    counts, totals = dict(counts or {}), dict(totals or {})
    groups = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_rows"), *[F.count_if(c).alias(f"_c{i}") for i, (c, _) in enumerate(counts.values())],
        *[F.sum(c).alias(f"_t{i}") for i, (c, _) in enumerate(totals.values())])
    broken = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.col("_rows") > 1)
    added = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    one = groups.agg(
        F.count_if(broken).alias("_broken"), added("_rows"), *[added(f"_c{i}") for i in range(len(counts))],
        *[F.round(F.sum(f"_t{i}"), 2).alias(f"_t{i}") for i in range(len(totals))])
    checks = [(f"{name}: key", F.lit(0), F.col("_broken"))]
    if rows is not None:
        checks.append((f"{name}: rows", F.lit(rows), F.col("_rows")))
    checks += [(check, F.lit(expected), F.col(f"_c{i}")) for i, (check, (_, expected)) in enumerate(counts.items())]
    checks += [(check, F.lit(expected), F.col(f"_t{i}")) for i, (check, (_, expected)) in enumerate(totals.items())]
    return _exploded(one, checks)


def allocation_checks(
    lines: DataFrame, headers: DataFrame, key: str, allocated: str, amount: str, each: str, total: str, tolerance: str = "0.01"
) -> DataFrame:
    """``allocation_differences`` (check ``each``) and ``allocation_reconciles`` (``total``) in one pass over both sides.

    Lines are added up per key before they meet their header, and amounts of a repeated key are added up too.
    Lines without a header count in the allocated total only, headers without lines not at all.
    """
    sums = lines.groupBy(key).agg(F.sum(allocated).alias("_allocated"))
    amounts = headers.filter(F.col(key).isNotNull()).groupBy(key).agg(F.sum(amount).alias("_amount"))
    one = sums.join(amounts, key, "left").agg(
        F.count_if(F.abs(F.col("_allocated") - F.col("_amount")) > F.lit(tolerance).cast("decimal(18,2)")).alias("_differ"),
        F.sum("_allocated").alias("_allocated"), F.sum("_amount").alias("_amount"))
    return _exploded(one, [(each, F.lit(0), F.col("_differ")), (total, F.col("_amount"), F.col("_allocated"))])


def all_checks(checks: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), checks)


def require(checks: DataFrame) -> None:
    """Raise ``CheckFailed`` naming the failed checks; there is a row per check, so all are listed."""
    failed = checks.filter(~F.col("ok")).collect()
    if failed:
        raise CheckFailed("; ".join(f"{r['check']}: expected {r['expected']}, got {r['actual']}" for r in failed))


def silver_checks(silver: Mapping[str, DataFrame], orders: int | Column | None = None, items: int | Column | None = None) -> DataFrame:
    """The checks that decide whether the cleaned layer counts as built: a pass per table, and one of lines with orders."""
    keys = {
        "categorias": ["category_id"], "produtos": ["product_id"], "variantes": ["product_variant_id"],
        "clientes": ["customer_id"], "locais": ["location_id"], "pedidos": ["order_id"], "itens_pedido": ["order_item_id"],
        "pagamentos": ["payment_id"], "devolucoes": ["return_item_id"], "estoque": ["product_variant_id", "location_id"],
    }
    rows = {"pedidos": orders, "itens_pedido": items}
    return all_checks([
        *[table_checks(silver[t], t, k, rows.get(t)) for t, k in keys.items()],
        allocation_checks(silver["itens_pedido"], silver["pedidos"], "order_id", "desconto_rateado", "desconto",
                          "orders whose discount is not allocated to the cent", "allocated discount total"),
    ])


def gold_checks(gold: Mapping[str, DataFrame], elite: int, expected: Mapping[str, object] | None = None) -> DataFrame:
    """Keys of the star, the size of the elite group, and control totals where they are known: a pass per table.

    ``expected`` may hold ``orders``, ``items``, ``revenue``, ``discount``, ``store_days`` and
    ``empty_days``.
    """
    e = dict(expected or {})
    keys = {
        "dim_data": ["data"], "dim_cliente": ["customer_id"], "dim_produto": ["product_id"],
        "dim_local": ["location_id"], "dim_canal": ["canal"], "dim_status_pedido": ["status"],
        "fct_pedido": ["order_id"], "fct_item_pedido": ["order_item_id"], "fct_pagamento": ["payment_id"],
        "fct_venda_diaria_pos": ["data"], "fct_devolucao": ["return_item_id"],
        "fct_estoque_atual": ["product_variant_id", "location_id"],
    }
    rows = {"fct_pedido": e.get("orders"), "fct_item_pedido": e.get("items")}
    counts = {
        "dim_cliente": {"elite customers": (F.col("flag_elite"), elite)},
        "fct_venda_diaria_pos": {
            check: (condition, e[k]) for k, check, condition in (
                ("store_days", "store days", F.lit(True)), ("empty_days", "days without sale", F.col("dia_sem_venda"))) if k in e},
    }
    totals = {
        t: {k: (column, e[k])} for t, k, column in (
            ("fct_pedido", "revenue", "total"), ("fct_item_pedido", "discount", "desconto_rateado")) if k in e}
    return all_checks([table_checks(gold[t], t, k, rows.get(t), counts.get(t), totals.get(t)) for t, k in keys.items()])
