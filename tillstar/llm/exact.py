"""Exact deduplication: rows grouped by a 128-bit content hash, their bytes compared within the group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import each_copy, stored

WHITE_SPACE = r"[\x20\x09-\x0D]+"


def content(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id, length in code points, text without white space, and its two digests."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    plain = base.select("doc_id", F.char_length("text").alias("chars"), F.regexp_replace("text", WHITE_SPACE, "").alias("body"))
    return plain.select("doc_id", "chars", "body", F.unhex(F.md5("body")).alias("hash"), F.sha2("body", 256).alias("text_sha256"))


def duplicate_classes(rows: DataFrame) -> DataFrame:
    """One row per group of equal bodies: its digests, the row that stays, its size.

    Grouping by the hash and the body itself compares the bytes of equal hashes, after a partial
    aggregation in every map task, so that a group of a third of all rows moves one body per task.
    Bodies that differ although the 128-bit hash is equal are kept apart by their SHA-256; should that
    be equal too, the job fails instead of merging them.
    """
    order = F.struct((-F.col("chars")).alias("fewest"), F.col("doc_id").isNull().alias("unknown"), "doc_id")
    bodies = rows.groupBy("hash", "text_sha256", "body").agg(F.min(order).alias("stays"), F.count(F.lit(1)).alias("n"))
    groups = bodies.drop("body").groupBy("hash", "text_sha256").agg(
        F.count(F.lit(1)).alias("bodies"), F.min("stays").alias("stays"), F.sum("n").alias("group_size"))
    collision = F.raise_error(F.lit("different texts with equal MD5 and SHA-256")).cast("long")
    return groups.select(
        "hash", "text_sha256", F.col("stays.doc_id").alias("keep_id"), (-F.col("stays.fewest")).alias("keep_chars"),
        F.when(F.col("bodies") == 1, F.col("group_size")).otherwise(collision).alias("group_size"))


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical without ASCII white space; null counts as empty, and empty texts form
    a group like any other. Of a group the row with the most code points stays, then the one with the
    smallest id; a null id comes last. Of rows that repeat id and length within a group exactly one stays.
    An empty table gives an empty result. Other columns are not looked at.

    The rows meet the (stored) groups in an equi-join whose both sides are plain exchanges, so that
    adaptive execution can split the partition of a hot group. Rows that could all stay are the same row of
    the result, so they are counted, in the map tasks first, and given back copy by copy.
    """
    rows = content(docs, doc_id, text)
    groups = stored(duplicate_classes(rows), "exact-groups")
    joined = rows.drop("body").join(groups, ["hash", "text_sha256"])
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("chars") == F.col("keep_chars"))
    judged = stored(joined.select("doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256"), "exact-rows")
    tied = F.col("kept") & (F.col("group_size") > 1)
    first = judged.filter(tied).groupBy("doc_id", "keep_id", "group_size", "text_sha256").agg(F.count(F.lit(1)).alias("n"))
    copies = each_copy(first, "n", "copy").withColumn("kept", F.col("copy") == 0)
    return judged.filter(~tied).unionByName(copies.select(*judged.columns))
