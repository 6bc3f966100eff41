"""Dense calendars: a day or month without a sale is a zero row, not a missing row."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions import dates
from tillstar.functions.numbers import mean_money, percent, ratio

TOTAL = "decimal(28,2)"


def date_bounds(*sources: tuple[DataFrame, str]) -> DataFrame:
    """One row with the first and last date over all ``(frame, date column)`` pairs."""
    parts = [df.agg(F.min(c).alias("first_day"), F.max(c).alias("last_day")) for df, c in sources]
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged.agg(F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"))


def date_series(bounds: DataFrame, name: str = "data") -> DataFrame:
    """Every day from ``first_day`` to ``last_day``, both included."""
    days = F.sequence(F.col("first_day"), F.col("last_day"), F.expr("interval 1 day"))
    return bounds.select(F.explode(days).alias(name))


def month_series(bounds: DataFrame, name: str = "mes") -> DataFrame:
    """The first day of every month from ``first_day`` to ``last_day``."""
    months = F.sequence(
        dates.month_start(F.col("first_day")), dates.month_start(F.col("last_day")), F.expr("interval 1 month")
    )
    return bounds.select(F.explode(months).alias(name))


def date_dimension(days: DataFrame, as_of: date, day: str = "data") -> DataFrame:
    """Calendar attributes of each day; "future" means later than ``as_of``."""
    d = F.col(day)
    return days.select(
        d.alias("data"),
        dates.iso_weekday(d).alias("num_dia_semana"),
        dates.weekday_name(d).alias("dia_semana"),
        F.year(d).alias("ano"),
        F.month(d).alias("num_mes"),
        dates.month_name(d).alias("mes"),
        dates.month_key(d).alias("ano_mes"),
        F.quarter(d).alias("num_trimestre"),
        dates.quarter_label(d).alias("trimestre"),
        dates.is_weekend(d).alias("eh_fim_de_semana"),
        (d > F.lit(as_of)).alias("eh_futuro"),
    )


def store_calendar(days: DataFrame, day: str = "data") -> DataFrame:
    """The calendar of the store question: the same attributes under its own column names."""
    d = F.col(day)
    return days.select(
        d.alias("data"),
        dates.iso_weekday(d).alias("num_dia_semana"),
        dates.weekday_name(d).alias("nome_dia_semana"),
        F.year(d).alias("ano"),
        F.month(d).alias("mes"),
        dates.month_name(d).alias("nome_mes"),
        F.quarter(d).alias("trimestre"),
        F.dayofmonth(d).alias("dia_do_mes"),
        dates.is_weekend(d).alias("eh_fim_de_semana"),
    )


def daily_sales(orders: DataFrame, day: str, amount: str, where: Column | None = None) -> DataFrame:
    """Sum and count per day that has sales. Aggregated before any join."""
    kept = orders if where is None else orders.filter(where)
    return kept.groupBy(F.to_date(day).alias("data")).agg(
        F.sum(amount).cast(TOTAL).alias("valor_venda"), F.count(F.lit(1)).alias("qtd_pedidos")
    )


def dense_daily(orders: DataFrame, day: str, amount: str, where: Column | None = None) -> DataFrame:
    """One row per day between the first and the last sale, zero where nothing was sold.

    Each selling day is stretched to the day before the next one, so the gaps are filled from
    the aggregated days themselves and the orders are read once. The window sees one row per day.
    """
    daily = daily_sales(orders, day, amount, where)
    following = F.lead("data").over(Window.orderBy("data"))
    span = F.sequence(F.col("first"), F.coalesce(F.date_sub("next", 1), F.col("first")), F.expr("interval 1 day"))
    sold = F.col("data") == F.col("first")
    return (
        daily.withColumn("next", following).withColumnRenamed("data", "first")
        .withColumn("data", F.explode(span))
        .select(
            "data",
            F.when(sold, F.col("valor_venda")).otherwise(F.lit(0)).cast(TOTAL).alias("valor_venda"),
            F.when(sold, F.col("qtd_pedidos")).otherwise(F.lit(0)).alias("qtd_pedidos"),
            (~sold).alias("dia_sem_venda"),
        )
    )


def fill_calendar(calendar: DataFrame, daily: DataFrame) -> DataFrame:
    """The calendar, left joined to aggregated sales. The calendar drives: no day goes missing."""
    sales = daily.withColumnRenamed("data", "_sale_day")
    return calendar.join(sales, F.col("data") == F.col("_sale_day"), "left").select(
        *calendar.columns,
        F.coalesce("valor_venda", F.lit(0).cast(TOTAL)).alias("valor_venda"),
        F.coalesce("qtd_pedidos", F.lit(0)).alias("qtd_pedidos"),
        F.col("_sale_day").isNull().alias("dia_sem_venda"),
    )


def with_weekday(dense: DataFrame) -> DataFrame:
    d = F.col("data")
    return dense.withColumn("n", dates.iso_weekday(d)).withColumn("dia_da_semana", dates.weekday_name(d))


def _empty_days() -> Column:
    return F.count_if(F.col("dia_sem_venda"))


def _selling_days() -> Column:
    return F.count_if(~F.col("dia_sem_venda"))


def calendar_summary(calendar: DataFrame, name_column: str = "nome_dia_semana") -> DataFrame:
    return calendar.agg(
        F.count(F.lit(1)).alias("dias_no_calendario"),
        F.min("data").alias("primeira_data"),
        F.max("data").alias("ultima_data"),
        F.count_distinct(name_column).alias("nomes_distintos"),
    )


def dense_summary(dense: DataFrame) -> DataFrame:
    return dense.agg(
        F.count(F.lit(1)).alias("dias_totais"),
        _empty_days().alias("dias_sem_venda"),
        _selling_days().alias("dias_com_venda"),
        F.sum("valor_venda").cast(TOTAL).alias("faturamento_pos_total"),
    )


def weekday_means(dense: DataFrame) -> DataFrame:
    """Mean sales per weekday over all calendar days."""
    days = F.count(F.lit(1))
    total = F.sum("valor_venda")
    return with_weekday(dense).groupBy("n", "dia_da_semana").agg(
        days.alias("dias_no_periodo"),
        _empty_days().alias("dias_sem_venda"),
        total.cast(TOTAL).alias("faturamento_total"),
        mean_money(total, days).alias("media_por_dia"),
    )


def weekday_comparison(dense: DataFrame) -> DataFrame:
    """Mean over all days against mean over selling days, and how far the second is inflated."""
    totals = with_weekday(dense).groupBy("n", "dia_da_semana").agg(
        F.count(F.lit(1)).alias("dias_calendario"),
        _selling_days().alias("dias_com_venda"),
        _empty_days().alias("dias_sem_venda"),
        F.sum("valor_venda").alias("_total"),
    )
    all_days = ratio(F.col("_total"), F.col("dias_calendario"))
    selling = ratio(F.col("_total"), F.col("dias_com_venda"))
    return totals.select(
        "n", "dia_da_semana", "dias_calendario", "dias_com_venda", "dias_sem_venda",
        mean_money(F.col("_total"), F.col("dias_calendario")).alias("media_com_calendario"),
        mean_money(F.col("_total"), F.col("dias_com_venda")).alias("media_sem_calendario"),
        F.round(selling - all_days, 2).alias("inflacao_valor"),
        F.round(F.lit(100.0) * (F.try_divide(selling, all_days) - 1), 2).alias("inflacao_pct"),
    )


def worst_day(dense: DataFrame) -> DataFrame:
    """The weekday with the lowest mean under both methods, one row per method.

    Equal means go to the earlier weekday.
    """
    means = weekday_comparison(dense)

    def verdict(label: str, mean: str) -> DataFrame:
        lowest = F.min(F.struct(F.col(mean), F.col("n"), F.col("dia_da_semana")))
        return means.filter(F.col(mean).isNotNull()).agg(lowest.alias("w")).select(
            F.lit(label).alias("metodo"),
            F.col("w.dia_da_semana").alias("pior_dia"),
            F.col(f"w.{mean}").alias("media_do_pior_dia"),
        )

    return verdict("all_days", "media_com_calendario").unionByName(
        verdict("selling_days", "media_sem_calendario")
    )


def empty_days_by_weekday(dense: DataFrame) -> DataFrame:
    return with_weekday(dense).groupBy("n", "dia_da_semana").agg(
        F.count(F.lit(1)).alias("dias_no_periodo"),
        _empty_days().alias("dias_sem_venda"),
        percent(_empty_days(), F.count(F.lit(1))).alias("pct_vazio"),
    )


def empty_days_by_year(dense: DataFrame) -> DataFrame:
    return dense.groupBy(F.year("data").alias("ano")).agg(
        F.count(F.lit(1)).alias("dias"), _empty_days().alias("dias_sem_venda")
    )


