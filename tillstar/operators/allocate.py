"""Exact allocation of a header amount to its lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.functions.numbers import MONEY, proportional_share
from tillstar.operators.skew import HOT_GROUP_ROWS, PIECE, hot_keys_if_any, join_in_pieces

# Decimal places that a column of doubles is taken to have.
DOUBLE_SCALE = 6


def _scale(df: DataFrame, column: str) -> int:
    kind = df.schema[column].dataType
    if isinstance(kind, T.DecimalType):
        return kind.scale
    return 0 if isinstance(kind, T.IntegralType) else DOUBLE_SCALE


def allocate(
    lines: DataFrame,
    headers: DataFrame,
    key: str,
    value: str,
    amount: str,
    line_id: Sequence[str],
    name: str = "allocated",
    hot: DataFrame | None = None,
    hot_rows: int = HOT_GROUP_ROWS,
    carry: Sequence[str] = (),
) -> DataFrame:
    """``lines`` with the part of their header's ``amount`` that falls to each of them.

    A line gets ``amount * value / sum(value)`` rounded to cents (a NULL value counts as zero); what rounding
    leaves over goes whole to one line: the one of the largest value, then of the smallest ``line_id`` (NULL
    first), then by a hash of the line's content. So the parts of a header always add up to its amount, and
    of lines that agree in everything only one is chosen. Headers whose lines sum to zero give everything to
    that line. ``headers`` has one row per ``key``; lines without a header are left out. The columns ``carry`` of the
    header, which have no names of the lines, come along, so that nobody joins it again.

    The lines are shuffled once, to meet their header, and the windows run on that partitioning. Lines of keys
    with more than ``hot_rows`` lines are dealt to pieces by content, and their totals come from map-side aggregates
    over these lines alone. Such keys are looked for when this is called, in tables of more rows than that, unless the
    caller knows them (``hot``, see ``skew.hot_keys``). The result is the same with any ``hot`` and ``hot_rows``,
    down to the line that takes the left-over.
    """
    if hot is None:
        hot = hot_keys_if_any(lines, [key], hot_rows)
    part_scale, amount_scale = _scale(lines, value), _scale(headers, amount)
    part = F.coalesce(F.col(value).cast(f"decimal(28,{part_scale})"), F.lit(0).cast(f"decimal(28,{part_scale})"))
    content = F.xxhash64(*[F.col(f"`{c}`") for c in lines.columns])
    ready = lines.withColumn("_part", part).withColumn("_content", content)
    heads = headers.select(key, F.col(amount).cast(f"decimal(28,{amount_scale})").alias("_amount"), *carry)
    share = lambda whole: proportional_share(F.col("_amount"), F.col("_part"), whole, amount_scale, part_scale)
    rank = ["_part", *line_id, "_content"]
    in_order = Window.partitionBy(key, PIECE).orderBy(F.desc(rank[0]), *rank[1:])
    piece = Window.partitionBy(key, PIECE)
    if hot is None:
        placed = ready.join(heads, key).withColumn(PIECE, F.lit(0))
        whole, chosen = F.sum("_part").over(piece), F.row_number().over(in_order) == 1
        shared = placed.withColumn("_whole", whole).withColumn("_first", chosen).withColumn("_share", share(F.col("_whole")))
        total = F.sum("_share").over(piece)
    else:
        totals = _hot_totals(ready, heads, key, rank, hot, share)
        placed = join_in_pieces(ready, heads, hot, [key], content="_content").join(F.broadcast(totals), key, "left")
        own, first = F.sum("_part").over(piece), F.row_number().over(in_order) == 1
        shared = placed.withColumn("_whole", F.coalesce("_hot_whole", own)) \
            .withColumn("_first", first & F.coalesce(F.col(PIECE) == F.col("_hot_piece"), F.lit(True))) \
            .withColumn("_share", share(F.col("_whole")))
        total = F.coalesce(F.col("_hot_sum"), F.sum("_share").over(piece))
    left_over = F.when(F.col("_first"), F.coalesce(F.col("_amount") - F.col("_total"), F.lit(0))).otherwise(F.lit(0))
    return shared.withColumn("_total", total).withColumn(name, (F.col("_share") + left_over).cast(MONEY)).select(*lines.columns, name, *carry)


def _hot_totals(ready: DataFrame, heads: DataFrame, key: str, rank: Sequence[str], hot: DataFrame, share) -> DataFrame:
    """Per hot key: the sum of its values, the sum of the shares, and the piece of the line that ranks first."""
    rows = ready.join(F.broadcast(hot), key).withColumn(PIECE, F.pmod(F.col("_content"), F.col("_pieces")).cast("int"))
    wholes = heads.join(F.broadcast(rows.groupBy(key).agg(F.sum("_part").alias("_hot_whole"))), key)
    first = F.min(F.struct((-F.col(rank[0])).alias("_largest"), *rank[1:], PIECE))
    return rows.join(F.broadcast(wholes), key).groupBy(key).agg(
        F.max("_hot_whole").alias("_hot_whole"), F.sum(share(F.col("_hot_whole"))).alias("_hot_sum"), first.alias("_first_line")) \
        .select(key, "_hot_whole", "_hot_sum", F.col(f"_first_line.{PIECE}").alias("_hot_piece"))
