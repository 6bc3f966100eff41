"""Monthly demand: dense series, three forecasts, and how wrong each of them is."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.functions.dates import month_key, month_start

MODELS = ("moving_average", "seasonal_naive", "naive")


def unified_items(items: DataFrame, variants: DataFrame, products: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per line with its product, customer and order date, before any aggregation."""
    named = products.select(
        F.col("id").alias("product_id"), F.col("name").alias("produto"), "brand_id", "category_id"
    )
    # Variants meet their products before the lines, which are then joined once for both.
    hop = variants.select(F.col("id").alias("product_variant_id"), "product_id").join(named, "product_id")
    heads = orders.select(
        F.col("id").alias("order_id"), "customer_id", "status", "channel",
        F.col("created_at").alias("data_pedido"),
    )
    return (
        items.join(hop, "product_variant_id").join(heads, "order_id")
        .select(
            "order_id", "product_variant_id", "product_id", "produto", "brand_id", "category_id",
            "customer_id", "status", "channel", F.col("quantity").alias("quantidade"),
            "unit_price", "line_total", "data_pedido",
            month_start(F.col("data_pedido")).alias("mes"),
        )
    )


def ids_of_name(products: DataFrame, name: str) -> DataFrame:
    """Every product carrying ``name``. A name may belong to several ids."""
    return products.filter(F.col("name") == name).select(F.col("id").alias("product_id"))


def monthly_units(items: DataFrame, ids: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Units per month (and ``keys``) for a set of product ids; months without sales are absent."""
    return (
        items.join(ids, "product_id", "left_semi")
        .groupBy(*keys, "mes").agg(F.sum("quantidade").cast("double").alias("unidades"))
    )


def dense_months(monthly: DataFrame, first_month: DataFrame, last: date) -> DataFrame:
    """``monthly`` with a row for each month from ``first_month`` to ``last``, zero where unsold.

    Without this, "the last three months" would be the last three months that had a sale.
    """
    span = F.sequence("first_month", F.lit(last), F.expr("interval 1 month"))
    spine = first_month.select(F.explode(span).alias("_m"))
    return spine.join(monthly, F.col("_m") == F.col("mes"), "left").select(
        F.col("_m").alias("mes"), F.coalesce("unidades", F.lit(0.0)).alias("unidades")
    )


def first_month(orders: DataFrame, ts: str = "created_at") -> DataFrame:
    return orders.agg(month_start(F.min(ts)).alias("first_month"))


def with_forecasts(
    dense: DataFrame, train_end: date, window: int = 3, partition: Sequence[str] = ()
) -> DataFrame:
    """The dense series with three forecasts on the months after ``train_end``.

    Every forecast is made from training months alone. The moving average is static: the mean
    of the last ``window`` training months, the same for the whole horizon. The windows run over
    one row per month (and ``partition``).
    """
    all_rows = Window.partitionBy(*partition)
    in_order = all_rows.orderBy("mes")
    end = F.lit(train_end)
    is_train = F.col("mes") <= end
    in_window = is_train & (F.col("mes") > F.add_months(end, -window))
    mean = F.avg(F.when(in_window, F.col("unidades"))).over(all_rows)
    last = F.max(F.when(F.col("mes") == F.trunc(end, "month"), F.col("unidades"))).over(all_rows)
    year_ago = F.when(F.add_months("mes", -12) <= end, F.lag("unidades", 12).over(in_order))

    def ahead(c: Column) -> Column:
        return F.when(~is_train, c)

    return dense.select(
        *partition, "mes", "unidades", is_train.alias("eh_treino"),
        ahead(mean).alias("moving_average"),
        ahead(year_ago).alias("seasonal_naive"),
        ahead(last).alias("naive"),
    )


def forecast_fact(forecasts: DataFrame) -> DataFrame:
    """One row per month: actual, three forecasts (NULL in training), and the training flag."""
    return forecasts.select(
        month_key(F.col("mes")).alias("ano_mes"),
        F.col("mes").alias("data"),
        F.col("unidades").alias("realizado"),
        F.col("moving_average").alias("prev_mm3"),
        F.col("seasonal_naive").alias("prev_sazonal"),
        F.col("naive").alias("prev_naive"),
        "eh_treino",
    )


def last_months(dense: DataFrame, train_end: date, n: int) -> DataFrame:
    return dense.filter(F.col("mes") <= F.lit(train_end)).orderBy(F.desc("mes")).limit(n)


def error_rows(forecasts: DataFrame, model: str = "moving_average") -> DataFrame:
    """Forecast, actual and absolute error per month of the horizon."""
    return forecasts.filter(~F.col("eh_treino")).select(
        "mes",
        F.col(model).alias("previsto"),
        F.col("unidades").alias("realizado"),
        F.abs(F.col("unidades") - F.col(model)).alias("erro_abs"),
    )


def error_totals(forecasts: DataFrame, model: str = "moving_average") -> DataFrame:
    """Sums, mean absolute error, and the rounded sum against the sum of rounded months."""
    return error_rows(forecasts, model).agg(
        F.sum("previsto").alias("soma_prevista"),
        F.sum("realizado").alias("soma_real"),
        F.avg("erro_abs").alias("mae"),
        F.bround(F.sum("previsto"), 0).cast("long").alias("soma_arredondada"),
        F.sum(F.bround("previsto", 0)).cast("long").alias("soma_dos_arredondados"),
    )


def long_forecasts(forecasts: DataFrame) -> DataFrame:
    """One row per model and month of the horizon."""
    return forecasts.filter(~F.col("eh_treino")).unpivot(
        [c for c in forecasts.columns if c not in MODELS], list(MODELS), "modelo", "previsto"
    )


def model_errors(forecasts: DataFrame) -> DataFrame:
    """Sum and mean absolute error per model. ``melhor`` marks the smallest error, first wins ties."""
    order = F.array_position(F.array(*[F.lit(m) for m in MODELS]), F.col("modelo"))
    errors = long_forecasts(forecasts).groupBy("modelo").agg(
        F.sum("previsto").alias("soma"),
        F.avg(F.abs(F.col("unidades") - F.col("previsto"))).alias("mae"),
    )
    # Three rows.
    best = F.row_number().over(Window.orderBy(F.asc_nulls_last("mae"), order))
    return errors.select("modelo", "soma", "mae", (best == 1).alias("melhor"))


def by_scenario(
    items: DataFrame, ids: DataFrame, first: DataFrame, train_end: date, last: date, window: int = 3
) -> DataFrame:
    """Forecast and error for each id on its own and for all of them together, an id without sales included.

    The lines are added up by id and month once; the scenarios are made from those sums.
    """
    monthly = monthly_units(items, ids, ["product_id"])
    each = F.explode(F.array(F.col("product_id").cast("string"), F.lit("all"))).alias("cenario")
    sums = monthly.select(each, "mes", "unidades").groupBy("cenario", "mes").agg(F.sum("unidades").alias("unidades"))
    start = first.scalar()
    months = F.explode(F.sequence(start, F.lit(last), F.expr("interval 1 month")))
    named = ids.select(each).distinct()
    spine = named.select(F.col("cenario").alias("_c"), months.alias("_m"))
    dense = spine.join(
        sums, (F.col("_c") == F.col("cenario")) & (F.col("_m") == F.col("mes")), "left"
    ).select(F.col("_c").alias("cenario"), F.col("_m").alias("mes"), F.coalesce("unidades", F.lit(0.0)).alias("unidades"))
    rows = with_forecasts(dense, train_end, window, ["cenario"]).filter(~F.col("eh_treino"))
    return rows.groupBy("cenario").agg(
        F.max("moving_average").alias("media_movel"),
        F.bround(F.sum("moving_average"), 0).cast("long").alias("previsao"),
        F.sum("unidades").alias("real"),
        F.avg(F.abs(F.col("unidades") - F.col("moving_average"))).alias("mae"),
    )


def training_rows(dense: DataFrame, train_end: date) -> DataFrame:
    return dense.filter(F.col("mes") <= F.lit(train_end)).select(
        F.year("mes").alias("ano"), F.month("mes").alias("mes_num"), "unidades"
    )


def year_month_pivot(training: DataFrame) -> DataFrame:
    """Years down, months across, zero where the series has no month."""
    months = list(range(1, 13))
    table = training.groupBy("ano").pivot("mes_num", months).agg(F.sum("unidades"))
    return table.na.fill(0.0).withColumnsRenamed({str(m): f"m{m:02d}" for m in months})


def month_profile(training: DataFrame) -> DataFrame:
    return training.groupBy("mes_num").agg(F.avg("unidades").alias("media"))


def quarter_contrast(training: DataFrame) -> DataFrame:
    """Mean of the monthly means for January-March and for October-December, and the low month."""
    profile = month_profile(training)
    return profile.agg(
        F.avg(F.when(F.col("mes_num").isin(1, 2, 3), F.col("media"))).alias("media_jan_mar"),
        F.avg(F.when(F.col("mes_num").isin(10, 11, 12), F.col("media"))).alias("media_out_dez"),
        F.min(F.struct("media", "mes_num"))["mes_num"].alias("mes_minimo"),
        F.min("media").alias("media_minima"),
    )


def yearly_units(training: DataFrame) -> DataFrame:
    """Units per year, in its first quarter, and growth over the first year of the series."""
    years = training.groupBy("ano").agg(
        F.sum("unidades").alias("total"),
        F.coalesce(F.sum(F.when(F.col("mes_num") <= 3, F.col("unidades"))), F.lit(0.0)).alias("primeiro_trimestre"),
    )
    # One row per year.
    first = F.first("total").over(Window.orderBy("ano"))
    return years.withColumn("crescimento_pct", F.lit(100.0) * (F.try_divide(F.col("total"), first) - 1))


def december_effect(training: DataFrame, window: int = 3) -> DataFrame:
    """The last December against earlier ones, and how far it moves the moving average."""
    decembers = training.filter(F.col("mes_num") == 12)
    last_year = F.max("ano").over(Window.partitionBy())
    flagged = decembers.withColumn("_last", F.col("ano") == last_year)
    earlier = F.avg(F.when(~F.col("_last"), F.col("unidades")))
    final = F.max(F.when(F.col("_last"), F.col("unidades")))
    return flagged.agg(
        earlier.alias("dezembros_anteriores"),
        final.alias("ultimo_dezembro"),
        ((earlier - final) / window).alias("impacto_mensal"),
    )
