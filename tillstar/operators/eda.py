"""Single-table exploration: no joins, no rows dropped."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.numbers import (
    currency_text,
    grouped_number,
    mean_money,
    percent,
    timestamp_text,
)
from tillstar.operators.quantiles import percentile_values
from tillstar.session import kept_table

TOTAL = "decimal(28,2)"


def _rows() -> Column:
    return F.count(F.lit(1))


def summary(df: DataFrame, ts: str, amount: str) -> DataFrame:
    """Row count, time span and min/max/mean amount, in one scan."""
    return df.agg(
        _rows().alias("qtd_total_linhas"),
        F.min(ts).alias("data_minima"),
        F.max(ts).alias("data_maxima"),
        F.min(amount).alias("total_minimo"),
        F.max(amount).alias("total_maximo"),
        mean_money(F.sum(amount), F.count(amount)).alias("total_medio"),
    )


def summary_text(df: DataFrame, ts: str, amount: str) -> DataFrame:
    """``summary`` formatted for reading."""
    s = summary(df, ts, amount)
    return s.select(
        grouped_number(F.col("qtd_total_linhas")).alias("qtd_total_linhas"),
        timestamp_text(F.col("data_minima")).alias("data_minima"),
        timestamp_text(F.col("data_maxima")).alias("data_maxima"),
        *[currency_text(F.col(c)).alias(c) for c in ("total_minimo", "total_maximo", "total_medio")],
    )


def null_census(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NULLs in every column, in one scan."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"nulos_{c}") for c in columns or df.columns])


def null_rate_by(df: DataFrame, by: str, column: str) -> DataFrame:
    """Whether the NULLs of ``column`` belong to particular groups."""
    missing = F.count_if(F.col(column).isNull())
    return df.groupBy(by).agg(
        _rows().alias("linhas"), missing.alias("nulos"), percent(missing, _rows(), 1).alias("pct_nulos")
    )


def mix(df: DataFrame, by: str, amount: str) -> DataFrame:
    """Share of rows and of value per group; the totals enter as scalars."""
    groups = df.groupBy(by).agg(_rows().alias("pedidos"), F.sum(amount).cast(TOTAL).alias("soma_total"))
    n_all, sum_all = groups.agg(F.sum("pedidos")).scalar(), groups.agg(F.sum("soma_total")).scalar()
    return groups.select(
        by,
        "pedidos",
        percent(F.col("pedidos"), n_all).alias("pct_pedidos"),
        "soma_total",
        percent(F.col("soma_total"), sum_all).alias("pct_valor"),
        mean_money(F.col("soma_total"), F.col("pedidos")).alias("ticket_medio"),
    )


QUARTILES = {"q1": 0.25, "mediana": 0.5, "q3": 0.75}


def tukey(df: DataFrame, amount: str) -> DataFrame:
    """Quartiles, spread, and what lies above the upper Tukey fence q3 + 1.5 * (q3 - q1).

    The table is read once, to store its amounts; quartiles and totals come from them.
    """
    amounts = kept_table(df.select(amount), "amounts")
    limits = percentile_values(amounts, amount, QUARTILES)
    fence = None if limits["q3"] is None else limits["q3"] + 1.5 * (limits["q3"] - limits["q1"])
    known = {**limits, "cerca": fence}
    shown = {name: F.round(F.lit(x).cast("double"), 2) for name, x in known.items()}
    value = F.col(amount).cast("double")
    above = value > F.lit(fence).cast("double")
    stats = amounts.agg(
        F.avg(value).alias("media"),
        F.stddev_samp(value).alias("desvio"),
        F.count_if(above).alias("acima_da_cerca"),
        F.sum(F.when(above, F.col(amount))).cast(TOTAL).alias("_above"),
        F.sum(amount).cast(TOTAL).alias("_all"),
        F.count_if(F.col(amount) <= 0).alias("total_zero_ou_negativo"),
    )
    return stats.select(
        *[shown[c].alias(c) for c in QUARTILES],
        F.round("media", 2).alias("media"),
        F.round("desvio", 2).alias("desvio_padrao"),
        F.round(F.try_divide(F.col("media"), F.lit(known["mediana"]).cast("double")), 3).alias("razao_media_mediana"),
        shown["cerca"].alias("cerca_superior"),
        "acima_da_cerca",
        percent(F.coalesce("_above", F.lit(0)), F.col("_all")).alias("pct_receita_acima_da_cerca"),
        "total_zero_ou_negativo",
    )


def yearly(df: DataFrame, ts: str, amount: str) -> DataFrame:
    return df.groupBy(F.year(ts).alias("ano")).agg(
        _rows().alias("pedidos"),
        F.sum(amount).cast(TOTAL).alias("soma_total"),
        F.min(ts).alias("primeiro"),
        F.max(ts).alias("ultimo"),
    )


def future_share(df: DataFrame, ts: str, as_of: datetime) -> DataFrame:
    """How much of the table lies after ``as_of``; the reference date is part of the result."""
    future = F.count_if(F.col(ts) > F.lit(as_of).cast("timestamp_ntz"))
    return df.agg(
        future.alias("pedidos_futuros"),
        _rows().alias("pedidos_total"),
        percent(future, _rows()).alias("pct_futuro"),
        F.max(ts).alias("data_mais_distante"),
    ).select(F.lit(as_of.date()).alias("data_de_referencia"), "*")


def timestamp_census(df: DataFrame, placed: str, created: str, updated: str) -> DataFrame:
    """How often three timestamps carry no information of their own."""
    first, second = F.col(placed) == F.col(created), F.col(created) == F.col(updated)
    return df.agg(
        _rows().alias("pedidos"),
        F.count_if(first).alias("placed_igual_created"),
        F.count_if(second).alias("created_igual_updated"),
        F.count_if(first & second).alias("os_tres_iguais"),
    )


def arithmetic_closure(df: DataFrame, key: str, number: str, subtotal: str, discount: str, total: str) -> DataFrame:
    """Whether subtotal - discount = total holds in each row, and whether the keys are keys.

    The two distinct counts are separate two-step aggregates, so each is spread over its values.
    """
    closes = F.col(subtotal) - F.col(discount) == F.col(total)
    rows = df.agg(
        _rows().alias("pedidos"),
        F.count_if(closes).alias("aritmetica_fecha"),
        F.count_if(~closes).alias("aritmetica_quebra"),
        F.count_if(F.col(discount) == 0).alias("sem_desconto"),
    )

    def distinct_count(column: str):
        return df.select(column).filter(F.col(column).isNotNull()).distinct().agg(_rows()).scalar()

    return rows.withColumn("ids_distintos", distinct_count(key)).withColumn(
        "order_numbers_distintos", distinct_count(number)
    )
