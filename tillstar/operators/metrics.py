"""Named measures over the star, with filters, grouping, ranked lists and series.

Filters and groups are dimension columns written ``dimension.column``; they reach a fact only
along the edges of the star, and an unrelated one is an error instead of a silent no-op.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions.dates import month_index
from tillstar.functions.numbers import ratio
from tillstar.operators.ranking import competition_rank
from tillstar.operators.star import UnrelatedError, edge
from tillstar.session import kept_table

TOTAL = "decimal(28,2)"


@dataclass(frozen=True)
class Measure:
    """An aggregate over one fact.

    ``where`` is a condition on the fact's own columns, ``dim_where`` one on a dimension's
    (``dimension``, condition). Filters on the dimensions in ``ignores`` do not apply.
    """

    fact: str
    kind: str  # sum, count or distinct
    column: str | None = None
    where: str | None = None
    dim_where: tuple[str, str] | None = None
    ignores: tuple[str, ...] = ()


@dataclass(frozen=True)
class Ratio:
    """``top / bottom``, or ``(top - bottom) / bottom`` when ``relative``. NULL over zero."""

    top: str
    bottom: str
    relative: bool = False


MEASURES: Mapping[str, Measure | Ratio] = {
    "orders": Measure("fct_pedido", "count"),
    "gross_revenue": Measure("fct_pedido", "sum", "total"),
    "recognised_revenue": Measure(
        "fct_pedido", "sum", "total", dim_where=("dim_status_pedido", "eh_receita_efetivada")),
    "average_ticket": Ratio("gross_revenue", "orders"),
    "cancelled_orders": Measure(
        "fct_pedido", "count", where="status = 'cancelled'", ignores=("dim_status_pedido",)),
    "orders_any_status": Measure("fct_pedido", "count", ignores=("dim_status_pedido",)),
    "cancellation_rate": Ratio("cancelled_orders", "orders_any_status"),
    "item_revenue": Measure("fct_item_pedido", "sum", "valor_linha"),
    "gross_margin": Measure("fct_item_pedido", "sum", "margem_bruta"),
    "net_margin": Measure("fct_item_pedido", "sum", "margem_liquida"),
    "discount": Measure("fct_item_pedido", "sum", "desconto_rateado"),
    "gross_margin_pct": Ratio("gross_margin", "item_revenue"),
    "net_margin_pct": Ratio("net_margin", "item_revenue"),
    "items_sold": Measure("fct_item_pedido", "sum", "quantidade"),
    "store_sales": Measure("fct_venda_diaria_pos", "sum", "valor_venda"),
    "store_days": Measure("fct_venda_diaria_pos", "count"),
    "selling_days": Measure("fct_venda_diaria_pos", "count", where="not dia_sem_venda"),
    "days_without_sale": Measure("fct_venda_diaria_pos", "count", where="dia_sem_venda"),
    "mean_per_day": Ratio("store_sales", "store_days"),
    "mean_per_selling_day": Ratio("store_sales", "selling_days"),
    "mean_inflation": Ratio("mean_per_selling_day", "mean_per_day", relative=True),
    "customers": Measure("fct_pedido", "distinct", "customer_id"),
    "category_diversity": Measure("dim_produto", "distinct", "category_id"),
    "returned_items": Measure("fct_devolucao", "sum", "quantidade"),
    "return_rate": Ratio("returned_items", "items_sold"),
    "payments": Measure("fct_pagamento", "count"),
    "payment_value": Measure("fct_pagamento", "sum", "valor"),
    "stock_value": Measure("fct_estoque_atual", "sum", "valor_em_estoque"),
    "actual_units": Measure("fct_previsao", "sum", "realizado"),
    "forecast_moving_average": Measure("fct_previsao", "sum", "prev_mm3"),
    "forecast_seasonal": Measure("fct_previsao", "sum", "prev_sazonal"),
    "forecast_naive": Measure("fct_previsao", "sum", "prev_naive"),
    "cosine": Measure("fct_similaridade_produto", "sum", "similaridade"),
    "orders_in_common": Measure("fct_similaridade_produto", "sum", "pedidos_em_comum"),
    "actual_in_test": Measure("fct_previsao", "sum", "realizado", where="not eh_treino"),
    "forecast_error": Ratio("forecast_moving_average", "actual_in_test", relative=True),
}

# The indicator strips: which measures appear together.
STRIPS: Mapping[str, Sequence[str]] = {
    "overview": ("gross_revenue", "recognised_revenue", "orders", "average_ticket", "net_margin_pct"),
    "margin": ("item_revenue", "gross_margin", "gross_margin_pct", "discount", "net_margin", "net_margin_pct"),
    "customers": ("customers", "average_ticket", "orders", "items_sold", "return_rate"),
    "seasonality": ("mean_per_day", "mean_per_selling_day", "days_without_sale", "mean_inflation"),
    "forecast": ("actual_in_test", "forecast_moving_average", "forecast_error"),
}


def _split(reference: str) -> tuple[str, str]:
    table, _, column = reference.partition(".")
    return table, column


def _base_measures(names: Sequence[str]) -> dict[str, Measure]:
    found: dict[str, Measure] = {}

    def visit(name: str) -> None:
        definition = MEASURES[name]
        if isinstance(definition, Ratio):
            visit(definition.top)
            visit(definition.bottom)
        else:
            found[name] = definition

    for name in names:
        visit(name)
    return found


def _value(name: str) -> Column:
    definition = MEASURES[name]
    if isinstance(definition, Measure):
        return F.col(name)
    top, bottom = _value(definition.top), _value(definition.bottom)
    quotient = ratio(top, bottom)
    return quotient - 1 if definition.relative else quotient


def _filtered(
    star: Mapping[str, DataFrame], fact: str, filters: Mapping[str, Sequence], ignores: Sequence[str]
) -> DataFrame:
    """The fact's rows whose dimension members pass every filter."""
    df = star[fact]
    wanted: dict[str, Column] = {}
    for reference, values in filters.items():
        dim, column = _split(reference)
        if dim in ignores:
            continue
        condition = F.col(column).isin(*values)
        wanted[dim] = wanted[dim] & condition if dim in wanted else condition
    for dim, condition in wanted.items():
        if dim == fact:
            df = df.filter(condition)
        else:
            key = edge(fact, dim)
            df = df.join(star[dim].filter(condition).select(key), key, "left_semi")
    return df


def _context(
    star: Mapping[str, DataFrame], fact: str, distinct: str | None, ignores: Sequence[str],
    measures: Mapping[str, Measure], filters: Mapping[str, Sequence], groups: Sequence[str],
) -> DataFrame:
    """The measures of one fact that share a filter context, per group.

    The fact is first added up by the dimension keys in play (by distinct values for a distinct
    count). Dimension joins then see at most one row per key combination, however busy a key is.
    """
    df = _filtered(star, fact, filters, ignores)
    dims = {_split(g)[0] for g in groups} | {m.dim_where[0] for m in measures.values() if m.dim_where}
    own = [_split(g)[1] for g in groups if _split(g)[0] == fact]
    joined = sorted(dims - {fact})
    keys = list(dict.fromkeys(own + [edge(fact, d) for d in joined]))
    for dim in joined:
        if dim in ignores:
            raise UnrelatedError(f"{sorted(measures)} ignore {dim}, so they cannot be grouped by it")

    def part(m: Measure) -> Column:
        condition = F.expr(m.where) if m.where else F.lit(True)
        if m.kind == "count":
            return F.count_if(condition)
        return F.sum(F.when(condition, F.col(m.column)))

    if distinct:
        small = df.select(*keys, F.col(distinct).alias("_distinct")).distinct()
    else:
        small = df.groupBy(*keys).agg(*[part(m).alias(name) for name, m in measures.items()])
    for dim in joined:
        key = edge(fact, dim)
        columns = {c for g in groups for d, c in [_split(g)] if d == dim}
        conditions = {m.dim_where[1]: f"_where_{dim}" for m in measures.values() if m.dim_where and m.dim_where[0] == dim}
        side = star[dim].select(
            key,
            *[F.col(c).alias(f"{dim}.{c}") for c in sorted(columns)],
            *[F.expr(text).alias(alias) for text, alias in conditions.items()],
        ).withColumnRenamed(key, "_key")
        small = small.join(side, F.col(f"`{key}`") == F.col("_key"), "left").drop("_key")

    def total(name: str, m: Measure) -> Column:
        if distinct:
            return F.count_distinct("_distinct").alias(name)
        kept = F.col(name)
        if m.dim_where:
            kept = F.when(F.col(f"_where_{m.dim_where[0]}"), kept)
        summed = F.sum(kept)
        return (F.nullif(summed, F.lit(0)) if m.kind == "count" else summed).alias(name)

    by = [F.col(c if d == fact else f"`{d}.{c}`").alias(c) for g in groups for d, c in [_split(g)]]
    return small.groupBy(*by).agg(*[total(name, m) for name, m in measures.items()])


def metric(
    star: Mapping[str, DataFrame],
    names: Sequence[str] | str,
    group_by: Sequence[str] = (),
    filters: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """The measures ``names`` per group, or one row without ``group_by``.

    Counts of nothing are NULL rather than 0. Facts are aggregated apart and meet by group, so
    no measure is repeated by another fact's rows.
    """
    names = [names] if isinstance(names, str) else list(names)
    contexts: dict[tuple, dict[str, Measure]] = {}
    for name, m in _base_measures(names).items():
        distinct = m.column if m.kind == "distinct" else None
        contexts.setdefault((m.fact, distinct, m.ignores), {})[name] = m
    columns = [_split(g)[1] for g in group_by]
    parts = [
        _context(star, fact, distinct, ignores, measures, filters or {}, group_by)
        for (fact, distinct, ignores), measures in contexts.items()
    ]
    merged = parts[0]
    if len(parts) > 1:
        for other in parts[1:]:
            merged = merged.unionByName(other, allowMissingColumns=True)
        values = [c for c in merged.columns if c not in columns]
        merged = merged.groupBy(*columns).agg(*[F.max(c).alias(c) for c in values])
    return merged.select(*columns, *[_value(n).alias(n) for n in names])


def strip(star: Mapping[str, DataFrame], name: str, filters: Mapping[str, Sequence] | None = None) -> DataFrame:
    """One row with the measures of an indicator strip."""
    return metric(star, STRIPS[name], filters=filters)


def mix(
    star: Mapping[str, DataFrame], names: Sequence[str], by: Sequence[str], filters: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Measures per group with the share each group has of the total; NULL shares where the total is zero.

    The window over all groups sees one row for each.
    """
    values = metric(star, names, by, filters)
    whole = Window.partitionBy()
    return values.select("*", *[ratio(F.col(n), F.sum(n).over(whole)).alias(f"share_{n}") for n in names])


def ranked(
    star: Mapping[str, DataFrame], name: str, by: str, n: int,
    second: str | None = None, filters: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """The members of ``by`` ranked by a measure, ties kept, with bar lengths.

    Each bar is the share of that measure's own maximum over its top n.
    """
    label = _split(by)[1]
    names = [name] if second is None else [name, second]
    # Read for the ranks, for every maximum and for the rows.
    values = kept_table(metric(star, names, [by], filters), "measure")
    listed = competition_rank(values, name, n)
    for value, share in ((name, "share_of_max"), (second, "second_share")):
        if value is not None:
            top = values.agg(F.max(value)).scalar()
            listed = listed.withColumn(share, ratio(F.col(value), top))
    return listed.select("position", label, *names, "share_of_max", *(["second_share"] if second else []))


def natural_list(
    star: Mapping[str, DataFrame], names: Sequence[str], by: str, order: str,
    filters: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Members in their own order instead of by value; those without a value are left out."""
    label, position = _split(by)[1], _split(order)[1]
    values = kept_table(metric(star, names, [by, order], filters).filter(F.col(names[0]).isNotNull()), "measure")
    shares = ["share_of_max", "second_share"][: len(names)]
    return values.select(
        position, label, *names,
        *[ratio(F.col(n), values.agg(F.max(n)).scalar()).alias(s) for n, s in zip(names, shares, strict=True)],
    )


def series(
    star: Mapping[str, DataFrame], names: Sequence[str], by: str,
    filters: Mapping[str, Sequence] | None = None,
) -> DataFrame:
    """Measures per period with the period's running index (0 for the first)."""
    label = _split(by)[1]
    points = kept_table(metric(star, names, [by], filters).filter(F.col(label).isNotNull()), "measure")
    index = month_index(F.col(label)) if dict(points.dtypes)[label] == "string" else F.col(label)
    indexed = points.withColumn("_i", index)
    first = indexed.agg(F.min("_i")).scalar()
    return indexed.select(label, (F.col("_i") - first).alias("idx"), *names)


def series_frame(points: DataFrame, label: str, names: Sequence[str], zero_based: bool = True) -> DataFrame:
    """What a chart of ``series`` needs besides its points: labels, axis bounds, last values.

    The axis starts at zero, or leaves 12 % of room around the values.
    """
    values = [F.col(n).cast("double") for n in names]
    highest = F.max(F.greatest(*values) if len(values) > 1 else values[0])
    lowest = F.min(F.least(*values) if len(values) > 1 else values[0])
    room = (highest - lowest) * 0.12
    last = [
        F.max_by(F.when(F.col(n).isNotNull(), F.col(n)), F.when(F.col(n).isNotNull(), F.col("idx"))).alias(f"last_{n}")
        for n in names
    ]
    bounds = points.withColumn("_end", points.agg(F.max("idx")).scalar())
    centre = F.abs(F.col("idx") - F.col("_end") / 2)
    return bounds.agg(
        F.min_by(label, "idx").cast("string").alias("first_label"),
        F.min(F.struct(centre.alias("d"), F.col(label).alias("l")))["l"].cast("string").alias("middle_label"),
        F.max_by(label, "idx").cast("string").alias("last_label"),
        F.max("idx").alias("periods"),
        (F.lit(0.0) if zero_based else lowest - room).alias("axis_min"),
        (highest if zero_based else highest + room).alias("axis_max"),
        *last,
    )


