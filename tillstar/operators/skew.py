"""Joining many rows to one row per key without gathering a key in one task.

A window or a join over a key puts all rows of that key in one task. When one key may hold a
third of the table, that task never ends. Here a hot key is spread over pieces, each of which
meets its own copy of the key's one row; all other keys stay whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.session import kept_table

# A key with more rows than this is spread over ceil(rows / HOT_GROUP_ROWS) pieces. The set of
# such keys has at most (table rows / HOT_GROUP_ROWS) entries, which is what bounds every
# broadcast of it: a trillion rows give at most half a million keys.
HOT_GROUP_ROWS = 2_000_000

PIECE = "_piece"
_PIECES = "_pieces"


def hot_keys(rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_GROUP_ROWS) -> DataFrame:
    """The few keys with more than ``hot_rows`` rows, and into how many pieces each is split.

    Only the key columns are read, and counts are combined before they are shuffled.
    """
    sizes = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > hot_rows)
    return sizes.select(*keys, F.ceil(F.col("_n") / F.lit(hot_rows)).cast("int").alias(_PIECES))


def hot_keys_if_any(rows: DataFrame, keys: Sequence[str], hot_rows: int = HOT_GROUP_ROWS) -> DataFrame | None:
    """``hot_keys`` as a kept table, or None where no key is hot. NULL keys are left out.

    A table of up to ``hot_rows`` rows has no hot key, so its keys are counted only beyond that. Both counts run when this is called.
    """
    if rows.select(*keys).count() <= hot_rows:
        return None
    found = kept_table(hot_keys(rows.select(*keys).dropna(), keys, hot_rows), "hot-keys")
    return None if found.isEmpty() else found


def join_in_pieces(
    rows: DataFrame, groups: DataFrame, hot: DataFrame, keys: Sequence[str], null_safe: bool = False,
    content: str | None = None,
) -> DataFrame:
    """Inner join of ``rows`` to ``groups`` (one row per key), partitioned by ``keys`` and ``PIECE``.

    The piece of a row depends only on its content and its input partition, so a retried task
    assigns it again alike, and identical copies of a row still spread; with ``content``, a column
    with a hash of the row, it depends on that alone. ``null_safe`` lets NULL keys match each other. ``PIECE`` stays in the result: a window over (keys, PIECE) needs no
    further shuffle and sees at most a piece.
    """

    def match(left: DataFrame, right: DataFrame, prefix: str) -> Column:
        pairs = [(left[k], right[f"{prefix}{k}"]) for k in keys]
        return reduce(lambda a, b: a & b, [a.eqNullSafe(b) if null_safe else a == b for a, b in pairs])

    split = F.broadcast(hot.withColumnsRenamed({k: f"_h_{k}" for k in keys}))
    if content:
        dealt = F.pmod(rows[content], F.col(_PIECES))
    else:
        own = F.pmod(F.xxhash64(*[rows[c] for c in rows.columns]), F.col(_PIECES))
        dealt = F.pmod(own + F.pmod(F.spark_partition_id(), F.col(_PIECES)), F.col(_PIECES))
    piece = F.when(F.col(_PIECES).isNotNull(), dealt).otherwise(F.lit(0))
    spread = rows.join(split, match(rows, split, "_h_"), "left").select(
        *[rows[c] for c in rows.columns], piece.cast("int").alias(PIECE)
    )
    copies = groups.join(split, match(groups, split, "_h_"), "left").select(
        *[groups[c].alias(f"_g_{c}" if c in keys else c) for c in groups.columns],
        F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_PIECES) - 1, F.lit(0)))).alias("_g_piece"),
    )
    joined = spread.join(copies, match(spread, copies, "_g_") & (spread[PIECE] == copies["_g_piece"]))
    return joined.drop("_g_piece", *[f"_g_{k}" for k in keys])


def with_group_totals(
    rows: DataFrame, keys: Sequence[str], *aggregates: Column, hot_rows: int = HOT_GROUP_ROWS
) -> DataFrame:
    """Every row with the ``aggregates`` of its key: an unordered window, safe for hot keys.

    NULL keys form a group, as they do in a window.
    """
    totals = rows.groupBy(*keys).agg(*aggregates)
    return join_in_pieces(rows, totals, hot_keys(rows, keys, hot_rows), keys, null_safe=True).drop(PIECE)
