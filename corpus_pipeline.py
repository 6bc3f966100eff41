"""The corpus pipeline: quality, lines, near duplicates, benchmark passages, packing, in this order.

Every stage takes (session, documents, folder of tables) and returns the documents it keeps, with their columns;
the last returns packed pieces. Stages work on all rows of the one before, whatever else its columns are called.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.llm import decontaminate, lines, pack, quality, shingles
from tillstar.llm.common import small_side, stored


def _keyed(docs: DataFrame) -> DataFrame:
    """Each row in whole, with its identity: id (a null id last), hash of the text, hash of all columns.

    The identity is never null and ordered, and equal only for rows that are equal in every column.
    """
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    fields = [F.col(f"doc.`{c}`") for c in docs.columns]
    identity = F.struct(F.col("doc.doc_id").isNull().alias("unknown"), F.col("doc.doc_id").alias("id"), F.xxhash64("doc.text").alias("body"), F.xxhash64(*fields).alias("row"))
    return rows.select("doc", identity.alias("_key"), F.col("doc.text").alias("text"))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field scores at ``quality.PREDICT`` or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    field = quality.train(spark.read.parquet(f"{sf_dir}/documents.parquet"), labels)
    return docs.filter(quality.score_column(field, F.col("text")) >= quality.PREDICT)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document or line has; a document that loses every line goes."""
    kept = lines.dedup_lines(docs)
    kept = kept.filter((F.size("removed") == 0) | (F.trim("text") != ""))
    body = F.col("text")
    columns = [body.alias(c) if c == "text" else F.char_length(body).cast("long").alias(c) if c == "n_chars" else F.col(f"doc.`{c}`").alias(c)
               for c in docs.columns]
    return kept.select(*columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates one row: that of the smallest id (a null id last), then by hash of its text.

    Near are texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more (``shingles``), not
    the fingerprints of ``op9``. Rows are told apart by id and content, so null and repeated ids name no other
    row; of equal rows one stays.
    """
    rows = _keyed(docs)
    repeats = stored(shingles.repeats(rows, "_key"), "repeats")
    named = small_side(repeats, repeats.count())
    once = rows.join(named, F.col("_key") == F.col("id"), "left_anti").select("doc")
    again = named.filter("stays")
    if not again.isEmpty():
        same = rows.join(again, F.col("_key") == F.col("id"), "left_semi")
        once = once.unionByName(same.groupBy("_key").agg(F.first("doc").alias("doc")).select("doc"))
    return once.select("doc.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark, whether or not its item has an id.

    Rows are told apart by id and content: a clean row stays even if a contaminated one has the same id, or none.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    rows = _keyed(docs)
    found = decontaminate.contamination(rows, benchmark, "_key", "text")
    dirty = stored(found.filter(F.size("hit_starts") > 0).select(F.col("doc_id").alias("_dirty")).distinct(), "contaminated")
    return rows.join(dirty, F.col("_key") == F.col("_dirty"), "left_anti").select("doc.*")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return pack.packed(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("line dedup", drop_repeated_lines),
    ("simhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

# A trained field, a tokenizer and 64-bit SimHash have no counterpart in SQL; tests/llm runs brute-force stages instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages from the documents table, each one's rows stored for the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = stored(docs, name.replace(" ", "-"))
    return docs
