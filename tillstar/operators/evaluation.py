"""Forecasts compared fairly: many origins instead of one, and what each averaging scheme is allowed to see."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.operators.forecast import MODELS

SCHEMES = ("estatica", "recursiva", "movel")


def dense_series(monthly: DataFrame, keys: Sequence[str], first_month: DataFrame, last: date, months: int | None = None) -> DataFrame:
    """One row per series and month from ``first_month`` to ``last``, zero where a series has none.

    ``monthly`` has ``keys, mes, unidades``, one row per month that has any. A series is there if it has a row at all;
    null units count as zero. With ``months``, only so many months up to ``last`` are made, for readers that look no further
    back (``months_seen``); the series are the same. The rows of a series come from one row, in one task.
    """
    first = first_month.scalar()
    if months is not None:
        first = F.when(first.isNotNull(), F.greatest(first, F.add_months(F.trunc(F.lit(last), "month"), 1 - months)))
    made = F.col("mes").between(first, F.lit(last))
    sold = F.collect_list(F.when(made, F.struct("mes", F.col("unidades").cast("double"))))
    series = monthly.groupBy(*keys).agg(F.map_from_entries(sold).alias("_sold"))
    spread = series.select(*keys, "_sold", F.explode(F.sequence(first, F.lit(last), F.expr("interval 1 month"))).alias("mes"))
    return spread.select(*keys, "mes", F.coalesce(F.try_element_at("_sold", F.col("mes")), F.lit(0.0)).alias("unidades"))


def months_seen(origins: int = 12, horizon: int = 3, window: int = 3) -> int:
    """How many of the last months ``rolling_origin`` looks at: up to a year, or the window, before the first origin's end."""
    return horizon + origins + max(window, 12) - 1


def _judged(dense: DataFrame, origins: int, horizon: int, window: int, keys: Sequence[str]) -> DataFrame:
    """``rolling_origin`` with a column per model: a row per series, origin and step."""
    order = Window.partitionBy(*keys).orderBy("mes")
    running = dense.select(
        *keys, "mes", "unidades", F.sum("unidades").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("_sum"),
        F.row_number().over(order).alias("_t"), F.max("mes").over(Window.partitionBy(*keys)).alias("_last"))

    def step(h: int) -> Column:
        before = F.col("_t") - h
        mean = (F.lag("_sum", h).over(order) - F.coalesce(F.lag("_sum", h + window).over(order), F.lit(0.0))) / window
        year_ago = F.lag("unidades", 12).over(order) if h <= 12 else F.lit(None).cast("double")
        return F.struct(F.lit(h).alias("passo"), F.add_months("mes", -h).alias("origem"), F.when(before >= window, mean).alias("moving_average"),
                        year_ago.alias("seasonal_naive"), F.lag("unidades", h).over(order).alias("naive"))

    steps = running.select(*keys, "mes", "unidades", "_last", F.array(*[step(h) for h in range(1, horizon + 1)]).alias("_steps"))
    each = steps.select(*keys, "mes", "unidades", "_last", F.explode("_steps").alias("_s")).select(*keys, "mes", "unidades", "_last", "_s.*")
    return each.filter((F.col("origem") <= F.add_months("_last", -horizon)) & (F.col("origem") > F.add_months("_last", -horizon - origins))
                       & F.col("naive").isNotNull())


def rolling_origin(dense: DataFrame, origins: int = 12, horizon: int = 3, window: int = 3, keys: Sequence[str] = ()) -> DataFrame:
    """Forecasts of every series from each of its last ``origins`` months that still have ``horizon`` actual months after them.

    Rows: ``keys, origem, passo, mes, unidades, modelo, previsto``. A forecast from an origin uses that month and earlier
    ones alone: running sums give the mean of the last ``window`` months, the value a year before the month (if that is
    not after the origin), and the origin's own. NULL where the series is too short. One pass over the dense series:
    every month looks back to its origins. Windows run over the months of one series.
    """
    judged = _judged(dense, origins, horizon, window, keys)
    kinds = F.explode(F.array(*[F.struct(F.lit(m).alias("modelo"), F.col(m).alias("previsto")) for m in MODELS]))
    return judged.select(*keys, "origem", "passo", "mes", "unidades", kinds.alias("_k")).select(*keys, "origem", "passo", "mes", "unidades", "_k.*")


def rolling_errors(dense: DataFrame, origins: int = 12, horizon: int = 3, window: int = 3, keys: Sequence[str] = ()) -> DataFrame:
    """``origin_errors`` of ``rolling_origin``, added up per origin for all models at once, without a row per forecast and model."""
    error = lambda m: F.abs(F.col("unidades") - F.col(m))
    sums = _judged(dense, origins, horizon, window, keys).groupBy("origem").agg(
        *[F.struct(F.lit(m).alias("modelo"), F.count(m).alias("previsoes"), F.avg(error(m)).alias("mae")).alias(m) for m in MODELS])
    return sums.select("origem", F.explode(F.array(*MODELS)).alias("_k")).select("origem", "_k.*")


def origin_errors(forecasts: DataFrame) -> DataFrame:
    """Mean absolute error per origin and model, over all series and steps that have a forecast."""
    return forecasts.groupBy("origem", "modelo").agg(
        F.count("previsto").alias("previsoes"), F.avg(F.abs(F.col("unidades") - F.col("previsto"))).alias("mae"))


def model_summary(errors: DataFrame) -> DataFrame:
    """Per model: origins judged, mean and spread of their errors, origins it wins, and whether its mean is the best.

    Equal errors go to the model named first. The windows see one row per origin and model.
    """
    place = F.array_position(F.array(*[F.lit(m) for m in MODELS]), F.col("modelo"))
    first = F.row_number().over(Window.partitionBy("origem").orderBy(F.asc_nulls_last("mae"), place))
    won = errors.withColumn("_won", F.col("mae").isNotNull() & (first == 1))
    summed = won.groupBy("modelo").agg(
        F.count("mae").alias("origens"), F.avg("mae").alias("media_mae"), F.stddev_samp("mae").alias("desvio_mae"),
        F.min("mae").alias("menor_mae"), F.max("mae").alias("maior_mae"), F.count_if("_won").alias("vitorias"))
    best = F.row_number().over(Window.orderBy(F.asc_nulls_last("media_mae"), place))
    return summed.withColumn("melhor", F.col("media_mae").isNotNull() & (best == 1))


def recursive_mean(last: Column, horizon: int, window: int) -> Column:
    """``horizon`` forecasts, each the mean of the ``window`` values before it, earlier forecasts among them.

    ``last`` has the latest known values, oldest first; fewer than ``window`` are averaged as they are, none give NULL.
    """
    def following(state: Column, _) -> Column:
        known = state["known"]
        mean = F.aggregate(known, F.lit(0.0), lambda a, x: a + x) / F.size(known)
        shorter = F.when(F.size(known) >= window, F.slice(known, 2, window)).otherwise(known)
        return F.struct(F.concat(shorter, F.array(mean)).alias("known"), F.concat(state["out"], F.array(mean)).alias("out"))

    start = F.struct(F.slice(last, F.greatest(F.lit(1), F.size(last) - window + 1), F.lit(window)).alias("known"), F.array().cast("array<double>").alias("out"))
    return F.when(F.size(last) > 0, F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, following, lambda s: s["out"]))


def averaging_schemes(dense: DataFrame, train_end: date, horizon: int, window: int = 3, keys: Sequence[str] = ()) -> DataFrame:
    """The months after ``train_end`` with three readings of a moving average of ``window`` months.

    ``estatica`` is the mean of the last training months throughout; ``recursiva`` feeds its own forecasts back;
    ``movel`` is the mean of the months just before, actual months of the test among them, which no forecast made at
    ``train_end`` can know: ``movel_usa_teste`` marks them. Windows run over the months of one series.
    """
    all_rows = Window.partitionBy(*keys)
    end = F.trunc(F.lit(train_end), "month")
    known = (F.col("mes") <= end) & (F.col("mes") > F.add_months(end, -window))
    # At most ``window`` months of a series.
    latest = F.transform(F.sort_array(F.collect_list(F.when(known, F.struct("mes", "unidades"))).over(all_rows)), lambda x: x["unidades"])
    ahead = F.months_between("mes", end).cast("int")
    before = F.avg("unidades").over(all_rows.orderBy("mes").rowsBetween(-window, -1))
    rows = dense.select(*keys, "mes", "unidades", latest.alias("_latest"), ahead.alias("_h"), before.alias("movel"),
                        F.avg(F.when(known, F.col("unidades"))).over(all_rows).alias("estatica"))
    return rows.filter((F.col("_h") >= 1) & (F.col("_h") <= horizon)).select(
        *keys, "mes", "unidades", "estatica", F.get(recursive_mean(F.col("_latest"), horizon, window), F.col("_h") - 1).alias("recursiva"),
        "movel", (F.col("_h") > 1).alias("movel_usa_teste"))


def scheme_totals(schemes: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Sum, rounded sum and mean absolute error per scheme. ``eh_previsao`` is false where actual test months were used."""
    named = [c for c in schemes.columns if c not in SCHEMES]
    rows = schemes.unpivot(named, list(SCHEMES), "esquema", "previsto")
    return rows.groupBy(*keys, "esquema").agg(
        F.sum("previsto").alias("soma"), F.bround(F.sum("previsto"), 0).cast("long").alias("soma_arredondada"),
        F.sum("unidades").alias("soma_real"), F.avg(F.abs(F.col("unidades") - F.col("previsto"))).alias("mae"),
        (~F.bool_or(F.col("movel_usa_teste") & (F.col("esquema") == "movel"))).alias("eh_previsao"))
