"""SimHash near-duplicates: links between fingerprints found with a pigeonring filter, then components.

64 bits are cut into a ring of segments. If two fingerprints differ in at most t bits, then some segment begins
a chain in which every l consecutive segments differ in at most l * t / m bits together. The first segments of
such a chain agree exactly, so they are the join key; the other chain budgets prune before the full check.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import ship, stored
from tillstar.llm.components import components

ship(__name__)

BITS = 64
SHINGLE = 3
SEED = 42
# Segment widths; seven segments make a key of three, 27 or 28 bits.
WIDTHS = (9, 9, 9, 9, 9, 9, 10)
MAX_BITS = 2
# Fingerprints with the same key beyond which their links are found by flipped bits instead of pairs.
PAIR_LIMIT = 32
HASH_CHUNK = 65_536


def fingerprint(text: str | None) -> int:
    """The 64-bit SimHash of a text's word shingles; 0 without words. A bit is set if more than half the hashes set it."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False)))
    digest = xxhash.xxh64_intdigest
    parts = (shingles[at:at + HASH_CHUNK] for at in range(0, len(shingles), HASH_CHUNK))
    return _majority((np.fromiter((digest(s, SEED) for s in part), dtype="<u8", count=len(part)) for part in parts), len(shingles))


def _majority(parts: Iterable[np.ndarray], n: int) -> int:
    """The bits that more than half of ``n`` hashes set."""
    ones = np.zeros(BITS, dtype=np.int64)
    for h in parts:
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * ones > n).tolist())


def hash_fingerprint(hashes: np.ndarray) -> int:
    """The 64-bit SimHash of shingles that are hashed already; 0 of none."""
    whole = hashes.astype("<u8", copy=False)
    return _majority((whole[at:at + HASH_CHUNK] for at in range(0, len(whole), HASH_CHUNK)), len(whole))


# bytes.translate lowers A-Z only, and bytes.split() cuts at exactly the six ASCII white spaces.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def _fingerprints(texts: pa.Array) -> pa.Array:
    return pa.array([f - (1 << 64) if f >= 1 << 63 else f for f in (fingerprint(t.as_py()) for t in texts)], pa.int64())


def fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fingerprint`` (signed 64 bits) of every row."""
    return docs.select(F.col(doc_id).alias("doc_id"), F.arrow_udf(_fingerprints, "bigint")(F.col(text)).alias("fingerprint"))


def _segment_masks(first: int, count: int) -> int:
    """The bits of ``count`` consecutive segments of the ring, as a signed mask."""
    mask = 0
    for j in range(first, first + count):
        j %= len(WIDTHS)
        low = sum(WIDTHS[:j])
        mask |= ((1 << WIDTHS[j]) - 1) << low
    return mask - (1 << 64) if mask >= 1 << 63 else mask


def _exact_segments(max_bits: int) -> int:
    """How many segments a chain begins with that must agree: l * t / m < 1."""
    return (len(WIDTHS) - 1) // max_bits


def _chain_ok(ring: Column, x: Column, y: Column, max_bits: int) -> Column:
    """The chain budgets from the ring position, the last of which is the full Hamming check."""
    m = len(WIDTHS)
    difference = x.bitwiseXOR(y)
    conditions = None
    for length in range(_exact_segments(max_bits) + 1, m + 1):
        masks = F.array(*[F.lit(_segment_masks(i, length)) for i in range(m)])
        within = F.bit_count(difference.bitwiseAND(F.get(masks, ring))) <= length * max_bits // m
        conditions = within if conditions is None else conditions & within
    return conditions


def similar_fingerprints(prints: DataFrame, max_bits: int = MAX_BITS, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Links ``a, b`` between distinct fingerprints that connect all of them within ``max_bits`` bits of each other.

    ``prints`` has distinct ``fingerprint``. Keys with one fingerprint vanish. Keys with up to ``pair_limit`` are
    paired, filtered and checked. Of a fuller key every fingerprint names itself and its neighbours at one flipped
    bit outside the key; those who name the same value differ in at most two bits, and any two that differ in two
    share such a value. They number at most 1 + the free bits, so the star that links them is small, and the work
    stays linear in the fingerprints. Both ways give the same components.
    """
    if max_bits != 2:
        raise ValueError("keys and flips are laid out for two differing bits")
    m = len(WIDTHS)
    exact = _exact_segments(max_bits)
    key_masks = [_segment_masks(i, exact) for i in range(m)]
    keys = prints.select("fingerprint", F.posexplode(F.array(*[F.col("fingerprint").bitwiseAND(F.lit(k)) for k in key_masks])).alias("ring", "key"))
    counts = keys.groupBy("ring", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stored(keys.join(counts, ["ring", "key"]), "simhash-keys")
    small = shared.filter(F.col("n") <= pair_limit).select("ring", "key", "fingerprint")
    pairs = small.withColumnRenamed("fingerprint", "a").join(small.withColumnRenamed("fingerprint", "b"), ["ring", "key"]) \
        .filter((F.col("a") < F.col("b")) & _chain_ok(F.col("ring"), F.col("a"), F.col("b"), max_bits)).select("a", "b")
    full = shared.filter(F.col("n") > pair_limit)
    one = [b - (1 << 64) if b >= 1 << 63 else b for b in (1 << i for i in range(BITS))]
    flips = F.array(F.lit(0).cast("long"), *[F.lit(b) for b in one])
    key_mask = F.get(F.array(*[F.lit(k) for k in key_masks]), F.col("ring"))
    free = F.filter(flips, lambda f: f.bitwiseAND(key_mask) == 0)
    named = full.select("ring", "key", "fingerprint", F.explode(F.transform(free, lambda f: F.col("fingerprint").bitwiseXOR(f))).alias("value"))
    stars = named.groupBy("ring", "key", "value").agg(F.min("fingerprint").alias("a"), F.collect_set("fingerprint").alias("all")) \
        .filter(F.size("all") > 1).select("a", F.explode("all").alias("b")).filter("a <> b")
    return pairs.unionByName(stars).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint`` (16 hex digits), ``component_id`` (smallest id reachable).

    Words are the runs without ASCII white space, A-Z lower-cased; shingles are three words, repeats included, of a
    shorter text all its words. A null, empty or wordless text has fingerprint zero, linked like any other.
    Documents with equal fingerprints are one node, however many: pairs and links are between distinct
    fingerprints only. A null id is no smallest id unless the component has no other. Repeated rows are reported
    each, an empty table gives an empty result. Other columns are not looked at.
    """
    rows = stored(fingerprints(docs, doc_id, text), "fingerprints")
    nodes = stored(rows.groupBy("fingerprint").agg(F.min("doc_id").alias("first")), "fingerprint-nodes")
    roots = components(similar_fingerprints(nodes.select("fingerprint"), max_bits))
    rooted = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left") \
        .select("fingerprint", "first", F.coalesce("root", "fingerprint").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = stored(rooted.join(smallest, "root").select("fingerprint", "component_id"), "fingerprint-components")
    hexed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return rows.join(named, "fingerprint").select("doc_id", hexed.alias("fingerprint"), "component_id")
