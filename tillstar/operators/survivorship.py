"""One row per tax id: which row and which values stay, and how facts follow."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.functions.text import null_if_junk


def tax_key(c: Column | str) -> Column:
    """Letters and digits of a tax id in capitals; NULL where it is blank, a junk token or zeros alone."""
    plain = F.upper(F.regexp_replace(null_if_junk(c), "[^0-9A-Za-z]", ""))
    return F.when((plain != "") & ~plain.rlike("^0+$"), plain)


def _preference(columns: Sequence[str], created: str, row_id: str) -> Column:
    """Smaller is better: more known values, then the older row, then the smaller id."""
    known = sum((F.col(c).isNotNull().cast("int") for c in columns), F.lit(0))
    return F.struct((-known).alias("known"), F.col(created).isNull().alias("undated"), F.col(created).alias("created"), F.col(row_id).alias("id"))


def tax_id_crosswalk(rows: DataFrame, columns: Sequence[str], row_id: str = "id", tax_id: str = "tax_id", created: str = "created_at") -> DataFrame:
    """``id, kept_id, tax_key, linhas`` for every row: the row that stays for its tax id, and how many share it.

    Of equal tax ids the row with the most known ``columns`` stays, then the oldest (no date last), then the smallest id.
    A row without a tax id stays for itself; such rows are never merged. The groups are aggregates, so a tax id of
    very many rows is combined before the shuffle.
    """
    keyed = rows.select(F.col(row_id).alias("id"), tax_key(tax_id).alias("tax_key"), _preference(columns, created, row_id).alias("_order"))
    groups = keyed.filter("tax_key is not null").groupBy("tax_key").agg(F.min("_order")["id"].alias("_kept"), F.count(F.lit(1)).alias("_n"))
    return keyed.join(groups, "tax_key", "left").select(
        "id", F.coalesce("_kept", "id").alias("kept_id"), "tax_key", F.coalesce("_n", F.lit(1)).alias("linhas"))


def surviving_rows(rows: DataFrame, crosswalk: DataFrame, columns: Sequence[str], row_id: str = "id", created: str = "created_at") -> DataFrame:
    """One row per kept id: every column has the value of the best row that knows it, NULL if none does.

    ``linhas`` rows went into it, ``preenchidas`` columns were taken from a row that did not stay.
    """
    placed = rows.select(F.col(row_id).alias("id"), *columns, _preference(columns, created, row_id).alias("_order")).join(
        crosswalk.select("id", "kept_id"), "id")
    best = [F.min(F.when(F.col(c).isNotNull(), F.struct(F.col("_order"), F.col(c).alias("v"), F.col("id").alias("from")))).alias(f"_{c}") for c in columns]
    merged = placed.groupBy("kept_id").agg(F.count(F.lit(1)).alias("linhas"), *best)
    filled = sum((F.coalesce((F.col(f"_{c}.from") != F.col("kept_id")).cast("int"), F.lit(0)) for c in columns), F.lit(0))
    return merged.select(F.col("kept_id").alias("id"), *[F.col(f"_{c}.v").alias(c) for c in columns], "linhas", filled.alias("preenchidas"))


def follow(fact: DataFrame, crosswalk: DataFrame, key: str) -> DataFrame:
    """The fact with ``key`` renamed to the kept id; keys that the crosswalk does not know stay as they are."""
    known = crosswalk.filter("id <> kept_id").select(F.col("id").alias("_old"), F.col("kept_id").alias("_new"))
    return fact.join(known, F.col(key) == F.col("_old"), "left").withColumn(key, F.coalesce("_new", key)).drop("_old", "_new")


def follow_proof(fact: DataFrame, crosswalk: DataFrame, key: str, amount: str) -> DataFrame:
    """Rows, sum and distinct keys of a fact before and after: the first two are equal, the third may fall."""
    def totals(df: DataFrame, when: str) -> DataFrame:
        return df.agg(F.lit(when).alias("quando"), F.count(F.lit(1)).alias("linhas"), F.sum(amount).alias("soma"), F.count_distinct(key).alias("chaves"))

    return totals(fact, "antes").unionByName(totals(follow(fact, crosswalk, key), "depois"))
