"""Exact interpolated percentiles of a whole table."""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.session import kept_table

# Parts into which the stretch around a rank is cut by every pass.
_BINS = 1024


def _refine(df: DataFrame, column: str, stretches: list[tuple[float, float]]) -> dict[tuple[int, int], tuple[int, float, float]]:
    """Rows, smallest and largest value of every bin of some disjoint stretches (both ends included)."""
    v = F.col(column).cast("double")
    found = F.lit(None).cast("struct<s:int,b:int>")
    for i, (low, high) in enumerate(stretches):
        # Halves where the width of a stretch is no double. Every step keeps the order of values.
        by = 1.0 if math.isfinite(high - low) else 0.5
        part = F.floor((v * by - low * by) / (high * by - low * by) * _BINS)
        at = F.greatest(F.lit(0), F.least(F.lit(_BINS - 1), part)).cast("int")
        found = F.when(v.between(low, high), F.struct(F.lit(i).alias("s"), at.alias("b"))).otherwise(found)
    bins = df.select(v.alias("_v"), found.alias("_at")).filter("_at is not null").groupBy("_at").agg(
        F.count(F.lit(1)).alias("n"), F.min("_v").alias("low"), F.max("_v").alias("high"))
    return {(r["_at"]["s"], r["_at"]["b"]): (r["n"], r["low"], r["high"]) for r in bins.collect()}


def values_at(df: DataFrame, column: str, ranks: set[int], low: float, high: float) -> dict[int, float]:
    """The values of some ranks (from 0) of a column whose smallest and largest are ``low`` and ``high``.

    Every pass counts the bins of the stretches that still hold a rank, one job for all, and keeps the bin of each rank;
    a bin of one value answers its ranks. The two ends of a stretch fall into different bins, so it ends.
    """
    known: dict[int, float] = {}
    open_ranks = {(low, high): (0, sorted(ranks))} if ranks else {}
    while open_ranks:
        done = {s: r for s, r in open_ranks.items() if s[0] == s[1]}
        for (value, _), (_, some) in done.items():
            known |= dict.fromkeys(some, value)
        stretches = [s for s in open_ranks if s not in done]
        bins = _refine(df, column, stretches) if stretches else {}
        after: dict[tuple[float, float], tuple[int, list[int]]] = {}
        for i, s in enumerate(stretches):
            before, some = open_ranks[s]
            for b in range(_BINS):
                n, first, last = bins.get((i, b), (0, 0.0, 0.0))
                inside = [r for r in some if before <= r < before + n]
                if inside:
                    after[first, last] = (before, inside)
                before += n
        open_ranks = after
    return known


def percentile_values(df: DataFrame, column: str, probabilities: Mapping[str, float]) -> dict[str, float | None]:
    """Percentiles of a numeric column by name, interpolated between neighbours; None where it has no value.

    NULL and NaN do not count. ``df`` is read a few times, so it should be a stored column. Each read is one partial
    aggregate over all tasks; the driver sees at most ``_BINS`` rows for each rank asked for.
    """
    v = F.col(column).cast("double")
    values = df.filter(v.isNotNull() & ~F.isnan(v))
    n, low, high = values.agg(F.count(F.lit(1)), F.min(v), F.max(v)).first()
    if not n:
        return dict.fromkeys(probabilities)
    places = {name: p * (n - 1) for name, p in probabilities.items()}
    ranks = {r for x in places.values() for r in (math.floor(x), math.ceil(x))}
    at = values_at(values, column, ranks, low, high)
    return {name: at[math.floor(x)] + (at[math.ceil(x)] - at[math.floor(x)]) * (x - math.floor(x)) for name, x in places.items()}


def exact_percentiles(df: DataFrame, column: str, probabilities: Mapping[str, float]) -> DataFrame:
    """One row with a double column per entry of ``probabilities``; see ``percentile_values``.

    The table is read once, to store the column.
    """
    found = percentile_values(kept_table(df.select(F.col(column).cast("double").alias("_v")), "percentiles"), "_v", probabilities)
    return df.sparkSession.range(1).select(*[F.lit(x).cast("double").alias(name) for name, x in found.items()])
