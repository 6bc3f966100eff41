"""What several corpus operators share: tables in the shared folder, word expressions, checked broadcasts."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.session import kept_table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# A side of a join is broadcast only after counting it; beyond this many narrow rows Spark shuffles both sides.
BROADCAST_ROWS = 200_000


# Equal rows that are told apart are made by one task in blocks of so many.
COPY_BLOCK = 4096


# Frames that are read several times are written to the folder all executors share and read back.
stored = kept_table


def small_side(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` allow it, else as it is."""
    return F.broadcast(df) if rows <= limit else df


def each_copy(counted: DataFrame, n: str, copy: str) -> DataFrame:
    """Every row of ``counted`` as often as its column ``n`` says, with the copy's number from 0 in ``copy`` instead.

    Rows that stand for more than ``COPY_BLOCK`` copies are cut into blocks, which are dealt to tasks, so that
    equal rows however many are neither sorted nor numbered in one place.
    """
    few = counted.filter(F.col(n) <= COPY_BLOCK).withColumn("_block", F.lit(0).cast("long"))
    blocks = F.sequence(F.lit(0).cast("long"), F.floor((F.col(n) - 1) / COPY_BLOCK))
    many = counted.filter(F.col(n) > COPY_BLOCK).withColumn("_block", F.explode(blocks))
    first = F.col("_block") * COPY_BLOCK
    numbers = F.sequence(first, F.least(first + COPY_BLOCK, F.col(n)) - 1)
    return few.unionByName(many.repartition(*many.columns)).withColumn(copy, F.explode(numbers)).drop("_block", n)


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z, and no other letter, in lower case."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def alphanumeric_words(text: Column) -> Column:
    """Runs of ASCII digits, ASCII letters (lower-cased) and characters beyond ASCII; null has none."""
    parts = F.split(lower_ascii(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.array_remove(parts, "")


def ship(module: str) -> None:
    """Send the functions of a module to the Python workers by value, so that they need no copy of the library."""
    cloudpickle.register_pickle_by_value(sys.modules[module])
