"""Sharding by a k-d tree: weighted medians along the widest metadata dimension, found by distributed histograms."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstar.llm.common import each_copy, stored

# Buckets of one histogram pass. Two passes, over position and then over a hash within one position, place a cut
# to within a 4096th of the bucket it falls into, whatever the data.
BUCKETS = 4096
# Rows that one task numbers.
SLOT_ROWS = 4096


def ordinal(value: Column) -> Column:
    """A text as a number that keeps the order of its first seven bytes; null as the smallest."""
    head = F.substring(F.encode(F.coalesce(value, F.lit("")), "UTF-8"), 1, 7)
    return F.conv(F.rpad(F.hex(head), 14, "0"), 16, 10).cast("double")


def kd_tree_shards(
    rows: DataFrame, size: str, dimensions: list[str], identity: list[str],
    shards: int | None = None, target_bytes: int | None = None,
) -> DataFrame:
    """``rows`` with ``shard``: leaves of a k-d tree of nearly equal total ``size``.

    The number of leaves is ``shards``, or what ``target_bytes`` asks for. A node of k leaves is cut along
    its widest dimension (its range against the range of all rows, the first named of equals) where the
    weighted quantile floor(k/2)/k lies; rows of the same position are divided by a hash of ``identity``.
    Rows whose ``identity`` is equal cannot be told apart and stay together. ``dimensions`` are numeric
    columns; null counts as the smallest value. An empty table gives an empty result.

    Each level runs three small jobs over the (stored) metadata: ranges, a histogram over positions, a
    histogram over hashes inside the cut's position. Every one is aggregated in the map tasks; the driver
    sees a row per node. Rows descend by column expressions, without a shuffle, and each level is stored.
    """
    total = rows.agg(F.sum(F.col(size)), *[f(F.coalesce(F.col(d).cast("double"), F.lit(float("-inf"))))
                     for d in dimensions for f in (F.min, F.max)]).first()
    if shards is None:
        if not target_bytes or target_bytes < 1:
            raise ValueError("name the number of shards, or their bytes")
        shards = max(1, math.ceil((total[0] or 0) / target_bytes))
    lows, spans = [], []
    for i in range(len(dimensions)):
        low, high = total[1 + 2 * i] or 0.0, total[2 + 2 * i] or 0.0
        low = low if math.isfinite(low) else 0.0
        lows.append(low)
        spans.append((high - low) if math.isfinite(high) and high > low else 1.0)
    # Positions from 0 to 1 within the range of all rows.
    work = rows
    for i, d in enumerate(dimensions):
        value = F.coalesce(F.col(d).cast("double"), F.lit(lows[i]))
        work = work.withColumn(f"_p{i}", F.greatest(F.lit(0.0), (value - lows[i]) / spans[i]))
    work = work.withColumn("_h", F.pmod(F.xxhash64(*identity), F.lit(BUCKETS)).cast("int")) \
        .withColumn("_first", F.lit(0)).withColumn("_leaves", F.lit(shards))
    while True:
        cuts = _cuts(work, size, len(dimensions), shards)
        if not cuts:
            break
        work = stored(_descend(work, cuts), "shard-level")
    extra = ["_h", "_leaves", *[f"_p{i}" for i in range(len(dimensions))]]
    return work.withColumnRenamed("_first", "shard").drop(*extra)


def _bucket(low: Column, span: Column, position: Column) -> Column:
    return F.least(F.lit(BUCKETS - 1), F.floor((position - low) / span * BUCKETS)).cast("int")


def _lookup(values: dict[int, object], key: Column, kind: str, size: int) -> Column:
    """``values`` by a small non-negative key, as one constant array."""
    text = ",".join(repr(values.get(i, 0)) for i in range(size))
    return F.get(F.split(F.lit(text), ",").cast(f"array<{kind}>"), key)


def _cuts(work: DataFrame, size: str, n: int, shards: int) -> dict[int, tuple]:
    """For each node with several leaves: dimension, low, span, cut bucket, cut hash, leaves on the left."""
    open_rows = work.filter(F.col("_leaves") > 1)
    ranges = open_rows.groupBy("_first", "_leaves").agg(
        F.sum(size).alias("bytes"), *[f(f"_p{i}").alias(f"{f.__name__}{i}") for i in range(n) for f in (F.min, F.max)]).collect()
    nodes = {}
    for r in ranges:
        widths = [r[f"max{i}"] - r[f"min{i}"] for i in range(n)]
        d = max(range(n), key=lambda i: (widths[i], -i))
        nodes[r["_first"]] = (d, r[f"min{d}"], widths[d] or 1.0, r["_leaves"], r["bytes"])
    if not nodes:
        return {}
    pick = {c: {k: v[j] for k, v in nodes.items()} for j, c in enumerate(("d", "low", "span"))}
    at = F.get(F.array(*[F.col(f"_p{i}") for i in range(n)]), _lookup(pick["d"], F.col("_first"), "int", shards))
    placed = open_rows.withColumn("_b", _bucket(
        _lookup(pick["low"], F.col("_first"), "double", shards), _lookup(pick["span"], F.col("_first"), "double", shards), at))
    goal = {k: v[4] * (v[3] // 2) / v[3] for k, v in nodes.items()}
    at_bucket = _quantile(placed.groupBy("_first", "_b").agg(F.sum(size).alias("bytes")), "_b", goal, shards)
    inside = placed.filter(F.col("_b") == _lookup({k: v[0] for k, v in at_bucket.items()}, F.col("_first"), "int", shards))
    rest = {k: goal[k] - v[1] for k, v in at_bucket.items()}
    at_hash = _quantile(inside.groupBy("_first", "_h").agg(F.sum(size).alias("bytes")), "_h", rest, shards)
    found = {}
    for k, (d, low, span, leaves, _) in nodes.items():
        h, before, own = at_hash[k]
        # The bucket of hashes that straddles the goal goes to the side it overshoots less.
        h = h if rest[k] - before < own / 2 else h + 1
        found[k] = (d, low, span, at_bucket[k][0], h, leaves // 2, leaves)
    return found


def _quantile(histogram: DataFrame, key: str, goal: dict[int, float], shards: int) -> dict[int, tuple]:
    """Per node: the bucket in which the running sum reaches the goal, the sum before it, its own bytes.

    The window sees at most ``BUCKETS`` rows of a node.
    """
    running = F.sum("bytes").over(Window.partitionBy("_first").orderBy(key))
    sums = histogram.withColumn("upto", running)
    wanted = _lookup(goal, F.col("_first"), "double", shards)
    last = F.max(key).over(Window.partitionBy("_first"))
    hit = sums.withColumn("last", last).filter((F.col("upto") >= wanted) | (F.col(key) == F.col("last")))
    first = hit.groupBy("_first").agg(F.min(F.struct(key, "upto", "bytes")).alias("m"))
    return {r["_first"]: (r["m"][0], r["m"][1] - r["m"][2], r["m"][2]) for r in first.collect()}


def _descend(work: DataFrame, cuts: dict[int, tuple]) -> DataFrame:
    """Every row of a cut node moved to its child; a node is named by its first leaf."""
    size = max(cuts) + 1
    n = len([c for c in work.columns if c.startswith("_p")])
    field = lambda j, kind: _lookup({k: v[j] for k, v in cuts.items()}, F.col("_first"), kind, size)
    at = F.get(F.array(*[F.col(f"_p{i}") for i in range(n)]), field(0, "int"))
    bucket = _bucket(field(1, "double"), field(2, "double"), at)
    left = (bucket < field(3, "int")) | ((bucket == field(3, "int")) & (F.col("_h") < field(4, "int")))
    step = F.when(F.col("_leaves") == 1, F.struct(F.col("_first"), F.col("_leaves"))) \
        .when(left, F.struct(F.col("_first"), field(5, "int").alias("_leaves"))) \
        .otherwise(F.struct((F.col("_first") + field(5, "int")).alias("_first"), (F.col("_leaves") - field(5, "int")).alias("_leaves")))
    moved = work.withColumn("_step", step)
    return moved.withColumn("_first", F.col("_step._first")).withColumn("_leaves", F.col("_step._leaves")).drop("_step")


def with_slots(rows: DataFrame, identity: list[str]) -> DataFrame:
    """``rows`` with ``slot``: numbers from 0 without gaps in every shard, in the order of a hash.

    Shards are numbered piece by piece; pieces are counted first, and the counts of a shard added up.
    Rows with equal ``identity`` share a piece and are numbered in any order.
    """
    pieces = max(1, -(-rows.count() // SLOT_ROWS // 4))
    h = F.xxhash64(*identity)
    pieced = rows.withColumn("_h", h).withColumn("_piece", F.pmod(F.shiftright("_h", 8), F.lit(pieces)).cast("int"))
    counts = pieced.groupBy("shard", "_piece").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("shard").orderBy("_piece")) - F.col("_n")
    offsets = counts.select("shard", "_piece", before.alias("_before"))
    number = F.row_number().over(Window.partitionBy("shard", "_piece").orderBy("_h", *identity)) - 1
    numbered = pieced.withColumn("_number", number).join(offsets, ["shard", "_piece"])
    return numbered.withColumn("slot", F.col("_number") + F.col("_before")).drop("_h", "_piece", "_number", "_before")


def document_shards(docs: DataFrame, shards: int | None = None, target_bytes: int | None = None) -> DataFrame:
    """All documents in shards of nearly equal bytes: ``doc_id, size, text_crc32, shard, slot``.

    The dimensions are source, language, length and id. The size of a row is the UTF-8 bytes of its text
    (null: none) plus 8. Rows that are equal in all of these are counted and told apart by the number of the
    copy, so that they part like any others. No rows give no shards.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    meta = docs.select(
        "doc_id", (F.octet_length(text) + F.lit(8)).cast("long").alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        ordinal(F.col("source").cast("string")).alias("_source"), ordinal(F.col("lang").cast("string")).alias("_lang"),
        F.log2(F.octet_length(text) + F.lit(1.0)).alias("_length"), F.col("doc_id").cast("double").alias("_id"))
    counted = stored(meta.groupBy(*meta.columns).agg(F.count(F.lit(1)).alias("_n")), "shard-metadata")
    identity = ["doc_id", "text_crc32", "size", "_copy"]
    meta = each_copy(counted, "_n", "_copy")
    placed = kd_tree_shards(meta, "size", ["_source", "_lang", "_length", "_id"], identity, shards, target_bytes)
    return with_slots(placed.select(*identity, "shard"), identity).drop("_copy")
