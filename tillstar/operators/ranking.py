"""Top-k, competition ranks and global positions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.session import kept_table


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """The first ``k`` rows in ``order``: Spark keeps k rows per task, with no full sort."""
    return df.orderBy(*order).limit(k)


def top_k_positions(df: DataFrame, order: Sequence[Column], k: int, name: str = "position") -> DataFrame:
    """``top_k`` with the position 1..k. The window sees only the k rows left by the limit."""
    limited = top_k(df, order, k)
    return limited.withColumn(name, F.row_number().over(Window.orderBy(*order)))


def competition_rank(df: DataFrame, value: str, n: int, name: str = "position") -> DataFrame:
    """Rows whose rank (values greater than theirs, plus one) is at most ``n``; ties are all kept.

    The rank of a value among the first n rows is its rank in the table, so at most n
    (value, rank) pairs are enough to rank any number of tied rows, wherever they are.
    """
    first = df.select(F.col(value).alias("_v")).filter("_v is not null").orderBy(F.desc("_v")).limit(n)
    ranks = (
        first.withColumn("_r", F.row_number().over(Window.orderBy(F.desc("_v"))))
        .groupBy("_v").agg(F.min("_r").alias(name))
    )
    return df.join(F.broadcast(ranks), F.col(value) == F.col("_v")).drop("_v")


def number_all_rows(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """Positions 1..n over the whole table, by a distributed sort.

    Each sorted partition numbers its own rows; partitions start after the rows before them.
    The sorted rows are kept as a table first, because the cut points of a range sort are sampled
    and must not change between the counting and the numbering.
    """
    sort_id = F.monotonically_increasing_id()
    placed = kept_table(df.orderBy(*order).withColumn("_sort_id", sort_id), "sorted")
    part = F.shiftright(F.col("_sort_id"), 33)
    local = F.col("_sort_id").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per sort partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    return (
        placed.withColumn("_p", part)
        .join(F.broadcast(starts), F.col("_p") == F.col("_part"))
        .withColumn(name, (F.col("_start") + local + 1).cast("long"))
        .drop("_p", "_part", "_start", "_sort_id")
    )
