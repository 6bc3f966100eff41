"""Near duplicates by the Jaccard similarity of word shingles: SimHash and MinHash propose pairs, the shingle sets decide.

Fingerprints of the shingle sets are linked by ``simhash``'s pigeonring first. At a similarity of 0.8 most of them
differ in more bits than its keys allow, so bands then propose what these links have not connected. A band is the hash of ``ROWS`` minima; two texts of similarity j share one of ``BANDS`` with probability
1 - (1 - j ** ROWS) ** BANDS, which at 0.8 leaves out two pairs in a million.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstar.llm.common import ship, small_side, stored
from tillstar.llm.components import components
from tillstar.llm.simhash import hash_fingerprint, similar_fingerprints

ship(__name__)

WIDTH = 5
# Similarity in fifths: a pair is near if 5 * common >= FIFTHS * all shingles.
FIFTHS = 4
ROWS, BANDS = 4, 25
SEED = 42
# Texts of one band key beyond which they are compared with leaders before all others.
PAIR_LIMIT = 32
LEADERS = 4
# Pairs of one text beyond which they are dealt out, and texts of a full key that one task has at hand.
DEAL = 64
BLOCK = 1024
# Words of 64 bits that mark which buckets a set has hashes in.
MARKS = 16
_CHUNK = 4096

# bytes.translate lowers A-Z only, and bytes.split() cuts at exactly the six ASCII white spaces.
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_FACTORS = np.random.default_rng(SEED).integers(0, 1 << 63, size=(2, ROWS * BANDS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    """Sorted distinct hashes of a text's word shingles; of a shorter text all its words; none without words."""
    import xxhash

    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return np.empty(0, dtype=np.uint64)
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False))
    digest = xxhash.xxh64_intdigest
    return np.unique(np.fromiter((digest(s, SEED) for s in shingles), dtype=np.uint64))


def band_keys(hashes: np.ndarray) -> list[int]:
    """One signed 64-bit key per band."""
    import xxhash

    low = np.full(ROWS * BANDS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(hashes), _CHUNK):
        low = np.minimum(low, (hashes[at:at + _CHUNK, None] * _FACTORS[0] + _FACTORS[1]).min(axis=0))
    keys = [xxhash.xxh64_intdigest(low[i * ROWS:(i + 1) * ROWS].tobytes(), i) for i in range(BANDS)]
    return [k - (1 << 64) if k >= 1 << 63 else k for k in keys]


SIGNATURE = pa.struct([("digest", pa.binary()), ("fingerprint", pa.int64()), ("keys", pa.list_(pa.int64()))])


def _signatures(texts: pa.Array) -> pa.Array:
    import xxhash

    out = []
    for t in texts:
        hashes = shingle_set(t.as_py())
        mark = hash_fingerprint(hashes)
        out.append({"digest": xxhash.xxh128_digest(hashes.tobytes()), "fingerprint": mark - (1 << 64) if mark >= 1 << 63 else mark,
                    "keys": band_keys(hashes) if len(hashes) else []})
    return pa.array(out, SIGNATURE)


def _sets(texts: pa.Array) -> pa.Array:
    return pa.array([shingle_set(t.as_py()).tobytes() for t in texts], pa.binary())


_WORDS = [f"w{i}" for i in range(MARKS)]
_MARKED = pa.struct([(c, pa.int64()) for c in ("n", "ones", *_WORDS)])


def _marks(sets: pa.Array) -> pa.Array:
    """Of every set its size, the number of buckets it has hashes in, and which these are."""
    out = np.zeros((2 + MARKS, len(sets)), dtype=np.int64)
    for at, value in enumerate(sets):
        hashes = np.frombuffer(value.as_buffer(), dtype=np.uint64)
        taken = np.zeros(64 * MARKS, dtype=np.uint8)
        taken[hashes % np.uint64(64 * MARKS)] = 1
        out[0, at], out[1, at] = len(hashes), taken.sum()
        out[2:, at] = np.packbits(taken, bitorder="little").view("<i8")
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in out], fields=list(_MARKED))


def _most_common(x: str, y: str) -> Column:
    """No fewer than the shingles that two sets have in common: one in a bucket that the other leaves empty is not."""
    both = reduce(add, [F.bit_count(F.col(f"{x}.{w}").bitwiseAND(F.col(f"{y}.{w}"))) for w in _WORDS])
    return F.least(F.col(f"{x}.n") - F.col(f"{x}.ones"), F.col(f"{y}.n") - F.col(f"{y}.ones")) + both


def _may_be_near(x: str, y: str) -> Column:
    """Whether two sets may be near by their marks. It holds for all that are."""
    return (5 + FIFTHS) * _most_common(x, y) >= FIFTHS * (F.col(f"{x}.n") + F.col(f"{y}.n"))


def _near(a: pa.Array, b: pa.Array) -> pa.Array:
    out = []
    for x, y in zip(a, b, strict=True):
        x, y = (np.frombuffer(v.as_buffer(), dtype=np.uint64) for v in (x, y))
        common = len(np.intersect1d(x, y, assume_unique=True))
        out.append(5 * common >= FIFTHS * (len(x) + len(y) - common))
    return pa.array(out, pa.bool_())


def _similar(pairs: DataFrame, marks: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of nodes that are near. One node may be in very many pairs.

    Only the sets of pairs that their marks leave possible travel. What is measured is stored before it is filtered: a
    filter on it would move below the measure and make it twice, each task with two Python workers.
    """
    of = lambda c: marks.select(F.col("node").alias(c), F.col("m").alias(f"_{c}"))
    possible = stored(pairs.join(of("a"), "a").join(of("b"), "b").filter(_may_be_near("_a", "_b")).select("a", "b"), "shingle-possible")
    # A text with many pairs is copied once for every ``DEAL`` of them.
    held = possible.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / DEAL).alias("deals"))
    dealt = possible.join(held, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("deals")).alias("deal"))
    copies = held.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("deals") - 1)).alias("deal"))
    left = copies.join(sets.select(F.col("node").alias("a"), F.col("set").alias("a_set")), "a")
    met = dealt.join(sets.select(F.col("node").alias("b"), F.col("set").alias("b_set")), "b").join(left, ["a", "deal"])
    near = F.arrow_udf(_near, "boolean")
    return stored(met.select("a", "b", near("a_set", "b_set").alias("near")), "shingle-links").filter("near").select("a", "b")


def _apart(met: DataFrame, links: DataFrame) -> DataFrame:
    """The keys of ``met`` that ``links`` do not connect whole: ``key, node, root, n``."""
    roots = stored(components(links), "shingle-roots")
    placed = met.select("key", "node").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    placed = stored(placed, "band-placed")
    keys = placed.groupBy("key").agg(F.min("root").alias("_least"), F.max("root").alias("_most"), F.count(F.lit(1)).alias("n"))
    keys = stored(keys.filter("_least < _most").select("key", "n"), "band-apart")
    return stored(placed.join(small_side(keys, keys.count()), "key"), "band-keys")


def _led(full: DataFrame, marks: DataFrame) -> DataFrame:
    """Every node ``b`` with the one of the smallest nodes ``a`` of its keys that is likeliest near it, if any may be."""
    place = F.row_number().over(Window.partitionBy("key").orderBy("node"))
    top = full.withColumn("_place", place).filter(F.col("_place") <= LEADERS).select("key", F.col("node").alias("a"), F.col("root").alias("_root"))
    top = stored(top.join(marks.select(F.col("node").alias("a"), F.col("m").alias("_a")), "a"), "band-leaders")
    rows = full.select("key", "node", "root").join(marks, "node")
    led = rows.join(small_side(top, top.count()), "key").filter((F.col("a") < F.col("node")) & (F.col("root") != F.col("_root")) & _may_be_near("_a", "m"))
    common = _most_common("_a", "m")
    share = common / (F.col("_a.n") + F.col("m.n") - common)
    return led.select("a", F.col("node").alias("b"), F.struct(share.alias("share"), (-F.col("a")).alias("first")).alias("_by")) \
        .groupBy("b").agg(F.max_by("a", "_by").alias("a")).select("a", "b")


def _full_pairs(full: DataFrame, marks: DataFrame) -> DataFrame:
    """The pairs ``a, b`` of nodes of one key and of different roots that may be near by their marks.

    Nodes of the root that most of a key have are not paired with each other, and the others meet the key in blocks, so
    a large group that is connected costs its rows once, and a task holds no key whole. Pairs that are not possible
    are never rows: that is a condition of the join.
    """
    counts = full.groupBy("key", "root").agg(F.count(F.lit(1)).alias("_c"))
    main = stored(counts.groupBy("key").agg(F.max_by("root", F.struct("_c", "root")).alias("main")), "band-main")
    blocks = F.ceil(F.col("n") / BLOCK)
    rows = stored(full.join(small_side(main, main.count()), "key").join(marks, "node").select("key", "node", "root", "main", blocks.alias("blocks"), "m"), "band-marked")
    others = rows.filter("root <> main").select("key", F.col("node").alias("x"), F.col("root").alias("_root"), F.col("m").alias("_x"),
                                                F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    whole = rows.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")))
    met = others.hint("merge").join(whole, ["key", "block"]).filter(
        (F.col("root") != F.col("_root")) & ((F.col("root") == F.col("main")) | (F.col("x") < F.col("node"))) & _may_be_near("_x", "m"))
    return met.select(F.least("x", "node").alias("a"), F.greatest("x", "node").alias("b"))


def close_nodes(prints: DataFrame) -> DataFrame:
    """Every node ``b`` whose fingerprint the pigeonring links to a smaller node's, with the smallest such node ``a``.

    ``prints`` has ``node, fingerprint``, a node once. There are no more pairs than nodes, however many links a group has.
    """
    first = stored(prints.groupBy("fingerprint").agg(F.min("node").alias("first")), "close-prints")
    equal = prints.join(first, "fingerprint").filter("first < node").select(F.col("first").alias("a"), F.col("node").alias("b"))
    of = lambda c: first.select(F.col("fingerprint").alias(c), F.col("first").alias(f"_{c}"))
    linked = similar_fingerprints(first.select("fingerprint")).join(of("a"), "a").join(of("b"), "b")
    return equal.unionByName(linked.select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))).groupBy("b").agg(F.min("a").alias("a"))


def similar_nodes(keys: DataFrame, sets_of, pair_limit: int = PAIR_LIMIT, close: DataFrame | None = None) -> DataFrame | None:
    """Links ``a, b`` (a the smaller) between similar nodes; None if no key is shared and no pair is ``close``.

    ``keys`` has distinct ``key, node``; ``sets_of(nodes)`` gives ``node, set``. The pairs ``a, b`` of ``close`` are
    compared first; then, of keys with more than ``pair_limit`` nodes, every node with one of the smallest. Keys and
    pairs of nodes that these links connect are not looked at again. All other pairs are compared, unless the marks of the
    two sets show that they are not near. So the components are those of all pairs that share a key.
    """
    n = stored(keys.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "band-counts")
    met = stored(keys.select("key", "node", F.col("node").alias("root")).join(small_side(n, n.count()), "key"), "band-keys")
    wanted = met.select("node")
    if close is not None:
        wanted = wanted.unionByName(close.select(F.col("a").alias("node"))).unionByName(close.select(F.col("b").alias("node")))
    wanted = wanted.distinct()
    if wanted.isEmpty():
        return None
    sets = stored(sets_of(wanted), "shingle-sets")
    marks = stored(sets.select("node", F.arrow_udf(_marks, f"struct<{','.join(f'{f.name}:bigint' for f in _MARKED)}>")("set").alias("m")), "shingle-marks")
    links = None
    if close is not None:
        links = _similar(close, marks, sets)
        met = _apart(met, links)
    full = met.filter(F.col("n") > pair_limit)
    if not full.isEmpty():
        near = _similar(stored(_led(full, marks), "band-led"), marks, sets)
        links = near if links is None else links.unionByName(near)
        met = _apart(met, links)
    few, many = met.filter(F.col("n") <= pair_limit), met.filter(F.col("n") > pair_limit)
    others = few.select("key", F.col("node").alias("b"), F.col("root").alias("_root"))
    pairs = few.select("key", F.col("node").alias("a"), "root").join(others, "key").filter("a < b and root <> _root").select("a", "b")
    if not many.isEmpty():
        pairs = pairs.unionByName(_full_pairs(many, marks))
    found = _similar(stored(pairs.distinct(), "shingle-pairs"), marks, sets)
    return found if links is None else links.unionByName(found)


def representatives(docs: DataFrame, doc_id: str, text: str = "text", pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """``keep``: the smallest ``doc_id`` of every group of texts that shingle similarity of 0.8 or more connects.

    Words are the runs without ASCII white space, A-Z lower-cased; shingles are sets of five words, of a shorter
    text all its words. Texts without words are one group. ``doc_id`` is of any ordered type and not null, and
    names one text. Texts of equal shingles are one node, however many. The result does not depend on ``pair_limit``.
    An empty table gives an empty result.
    """
    _, nodes, later = _grouped(docs, doc_id, text, pair_limit)
    return nodes.join(later, "node", "left_anti").select(F.col("id").alias("keep"))


def repeats(docs: DataFrame, doc_id: str, text: str = "text", pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """``id, stays``, an id once: those that ``representatives`` does not keep, and those it keeps that several rows have.

    ``stays`` tells the two apart. Every row of any other id is to be kept, so these alone need to meet the rows.
    """
    rows, nodes, later = _grouped(docs, doc_id, text, pair_limit)
    several = nodes.filter("n > 1").select("digest", "node", F.col("id").alias("first"))
    several = stored(several, "several")
    named = rows.select("id", "digest").join(small_side(several, several.count()), "digest")
    gone = named.filter("id <> first").select("id").distinct().unionByName(nodes.select("node", "id").join(later, "node", "left_semi").select("id"))
    again = named.filter("id = first").join(later, "node", "left_anti").groupBy("id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return gone.select("id", F.lit(False).alias("stays")).unionByName(again.select("id", F.lit(True).alias("stays")))


def _grouped(docs: DataFrame, doc_id: str, text: str, pair_limit: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with the digests of their shingles, one node per digest with its smallest id, and the nodes that do not stay."""
    signature = F.arrow_udf(_signatures, "struct<digest:binary,fingerprint:bigint,keys:array<bigint>>")
    rows = docs.select(F.col(doc_id).alias("id"), signature(F.col(text)).alias("s")).select("id", "s.*")
    # Of equal shingle sets fingerprint and keys are equal too.
    rows = stored(rows, "signatures")
    sets = rows.groupBy("digest").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"), F.first("fingerprint").alias("fingerprint"), F.first("keys").alias("keys"))
    # Sorted, so that nodes are numbered in the order of ids.
    nodes = stored(sets.orderBy("id").withColumn("node", F.monotonically_increasing_id()), "shingle-nodes")

    def sets_of(wanted: DataFrame) -> DataFrame:
        named = stored(nodes.join(wanted, "node", "left_semi").select("node", "id"), "shingle-wanted")
        texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(small_side(named, named.count()), "id")
        return texts.select("node", F.arrow_udf(_sets, "binary")("text").alias("set")).groupBy("node").agg(F.first("set").alias("set"))

    keys = nodes.select("node", F.explode(F.array_distinct("keys")).alias("key"))
    close = stored(close_nodes(nodes.select("node", "fingerprint")), "close-pairs")
    links = similar_nodes(keys, sets_of, pair_limit, close)
    if links is None:
        return rows, nodes, nodes.select("node").limit(0)
    return rows, nodes, stored(components(links).filter("node <> root").select("node"), "near-duplicates")
