"""Benchmark decontamination by winnowing: fingerprints of documents and benchmark are joined and the hits extended.

A window is ``WINDOW`` consecutive words of an item (all words of a shorter item). Within a window of n
words the k-gram (k <= 5) of the smallest hash is the fingerprint, ties included, so two equal windows
always choose the same k-grams: joining fingerprints finds every shared window, and comparing the words
around a hit confirms it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import alphanumeric_words, small_side, stored

WINDOW = 10
GRAM = 5
# Bits of the benchmark's fingerprint filter: 32 for each fingerprint, within these powers of two.
MIN_FILTER_BITS, MAX_FILTER_BITS = 12, 22


def _gram(words: Column, at: Column, k: int) -> Column:
    return F.xxhash64(*[F.get(words, at + i) for i in range(k)])


def _positions(words: Column, length: int) -> Column:
    """0-based starts of runs of ``length`` words."""
    n = F.size(words)
    return F.when(n >= length, F.sequence(F.lit(0), n - length)).otherwise(F.array().cast("array<int>"))


def _chosen(words: Column, at: Column, k: int, w: int) -> Column:
    """Whether the k-gram at ``at`` is the smallest of some w consecutive k-grams."""
    own = _gram(words, at, k)
    # How far grams that are no smaller reach to either side, counted up to w - 1.
    first, last = F.greatest(at - (w - 1), F.lit(0)), F.least(at + (w - 1), F.size(words) - k)
    left = F.array_max(F.transform(F.sequence(first, at), lambda j: F.when(_gram(words, j, k) < own, j)))
    right = F.array_min(F.transform(F.sequence(at, last), lambda j: F.when(_gram(words, j, k) < own, j)))
    low, high = F.coalesce(left + 1, first), F.coalesce(right - 1, last)
    return high - low + 1 >= F.least(F.lit(w), F.size(words) - k + 1)


def _with_words(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(key).alias("key"), F.xxhash64(F.col(text)).alias("row"), alphanumeric_words(F.col(text)).alias("words"))


def benchmark_windows(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """Distinct windows of the benchmark with the ids of the items that hold them: ``length, window, items``."""
    words = _with_words(items, item_id, text).filter(F.size("words") > 0)
    length = F.least(F.size("words"), F.lit(WINDOW))
    starts = F.sequence(F.lit(1), F.size("words") - length + 1)
    windows = words.select("key", length.alias("length"), F.explode(F.transform(starts, lambda s: F.slice("words", s, length))).alias("window"))
    return windows.groupBy("length", "window").agg(F.array_sort(F.collect_set(F.col("key").cast("string"))).alias("items"))


def _fingerprints(windows: DataFrame, lengths: list[int]) -> DataFrame:
    """Distinct ``length, gram``: the smallest k-grams of every benchmark window."""
    parts = []
    for length in lengths:
        k = min(GRAM, length)
        grams = F.transform(_positions(F.col("window"), k), lambda i: _gram(F.col("window"), i, k))
        parts.append(windows.filter(F.col("length") == length).select("length", F.array_min(grams).alias("gram")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def _filter_bit(gram: Column, bits: int) -> tuple[Column, Column]:
    slot = F.shiftrightunsigned(gram, 64 - bits)
    return F.shiftright(slot, 6).cast("int"), slot.bitwiseAND(F.lit(63)).cast("int")


def _filters(prints: DataFrame, rows: int) -> tuple[int, dict[int, Column]]:
    """A bitmap of the fingerprints for each length, as constants; more fingerprints only fill it up."""
    bits = min(MAX_FILTER_BITS, max(MIN_FILTER_BITS, (32 * rows).bit_length()))
    word, bit = _filter_bit(F.col("gram"), bits)
    masks = prints.groupBy("length", word.alias("word")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit)).alias("mask")).collect()
    by_length: dict[int, dict[int, int]] = {}
    for m in masks:
        by_length.setdefault(m["length"], {})[m["word"]] = m["mask"]
    return bits, {
        length: F.split(F.lit(",".join(str(m.get(i, 0)) for i in range(1 << (bits - 6)))), ",").cast("array<bigint>")
        for length, m in by_length.items()}


def contamination(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
) -> DataFrame:
    """One row per document: ``doc_id, n_words, items, hit_starts`` (pairs of window length and first word).

    Words are lower-cased in A-Z. A null or wordless text has no words and no hits; so has everything when
    the benchmark is empty. Items without words or with a null text have no windows; a null item id is
    not named. Rows that repeat id and text are reported once each. Other columns are not looked at.

    A document keeps only positions whose k-gram passes a bitmap of the benchmark's fingerprints and is
    the document's own fingerprint there; these few rows, with the words around them, are joined with the
    fingerprints and then, as full windows, with the benchmark's windows. Both joins broadcast the
    benchmark if its counted rows allow it and shuffle both sides otherwise.
    """
    windows = stored(benchmark_windows(items, item_id, text), "benchmark-windows")
    sizes = {r["length"]: r["n"] for r in windows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    words = _with_words(docs, doc_id, text)
    none = "array<struct<length:int,at:int,gram:bigint,around:array<string>>>"
    mark = F.array(F.struct(F.lit(0).alias("length"), F.lit(0).alias("at"), F.col("row").alias("gram"), F.array().cast("array<string>").alias("around")))
    hits = mark.cast(none)
    n_windows = sum(sizes.values())
    if sizes:
        prints = stored(_fingerprints(windows, sorted(sizes)), "benchmark-fingerprints")
        n_prints = prints.count()
        bits, bitmaps = _filters(prints, n_prints)
        for length in sorted(sizes):
            hits = F.concat(hits, _document_hits(F.col("words"), length, bits, bitmaps[length]).cast(none))
    spread = words.select("key", "row", F.size("words").alias("n_words"), F.explode(hits).alias("h")) \
        .select("key", "row", "n_words", "h.*")
    if sizes:
        known = small_side(prints.withColumn("known", F.lit(True)), n_prints)
        spread = spread.join(known, ["length", "gram"], "left").filter((F.col("length") == 0) | F.col("known"))
    starts = F.sequence(F.lit(1), F.size("around") - F.col("length") + 1)
    opened = F.when(F.col("length") == 0, F.array(F.struct(F.lit(0).alias("start"), F.array().cast("array<string>").alias("window")))) \
        .otherwise(F.transform(starts, lambda s: F.struct((F.col("at") + s - 1).alias("start"), F.slice("around", s, F.col("length")).alias("window"))))
    opened = spread.select("key", "row", "n_words", "length", F.explode(opened).alias("w")).select("key", "row", "n_words", "length", "w.*")
    if sizes:
        opened = opened.join(small_side(windows, n_windows), ["length", "window"], "left")
    else:
        opened = opened.withColumn("items", F.lit(None).cast("array<string>"))
    hit = F.when(F.col("items").isNotNull(), F.struct("length", "start"))
    result = opened.groupBy("key", "row").agg(
        F.max("n_words").alias("n_words"), F.count_if(F.col("length") == 0).alias("copies"),
        F.collect_set(hit).alias("hit_starts"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    return result.select(F.col("key").alias("doc_id"), F.col("n_words").cast("long").alias("n_words"), "items", "hit_starts",
                         F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def _document_hits(words: Column, length: int, bits: int, bitmap: Column) -> Column:
    """Fingerprints of a document that the bitmap lets through, each with the words of its possible windows."""
    k = min(GRAM, length)
    w = length - k + 1

    def passes(i: Column) -> Column:
        word, bit = _filter_bit(_gram(words, i, k), bits)
        return F.getbit(F.get(bitmap, word), bit) == 1

    found = F.filter(_positions(words, k), lambda i: passes(i))
    found = F.when(F.size(words) >= length, F.filter(found, lambda i: _chosen(words, i, k, w)))
    first = lambda i: F.greatest(i - (w - 1), F.lit(0))
    return F.coalesce(F.transform(found, lambda i: F.struct(
        F.lit(length).alias("length"), first(i).alias("at"), _gram(words, i, k).alias("gram"),
        F.slice(words, first(i) + 1, i + k + w - 1 - first(i)).alias("around"))), F.array())


def hit_positions(hit_starts: Column) -> Column:
    """The distinct word positions inside the windows."""
    spans = F.transform(hit_starts, lambda h: F.sequence(h["start"], h["start"] + h["length"] - 1))
    return F.array_distinct(F.flatten(spans))
