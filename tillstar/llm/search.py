"""Ranked lexical search over bit-sliced Bloom signatures.

Every document's terms set bits of a signature as wide as the document needs, a term that occurs twice, four, eight
times also those of its higher levels. A block holds signatures of one width by bit: one bitmap over its documents
for each bit. The bitmaps of a term, taken together, hold every document with the term (and few others), so weighted
sums of them bound every score from above; all documents whose bound reaches the score of the k-th best so far are
scored exactly.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tillstar.llm.common import alphanumeric_words, ship, small_side, stored

ship(__name__)

# Bits a term sets, bits of a signature for each (a power of two between the widths), levels of a term's frequency.
HASHES, BITS_PER_TERM, LEVELS = 4, 12, 5
NARROWEST, WIDEST = 8, 20
# Documents of a block, and bits of its bitmaps together.
BLOCK_DOCUMENTS, BLOCK_BITS = 1024, 1 << 24
# Items whose terms are sent to every task at once; more are searched in turns.
ITEMS_AT_ONCE = 2000
# Candidate pairs that are broadcast to the words, at 8 bytes each; more are joined by shuffling both sides.
PAIRS = 1_000_000

SCALE, DAMP, LENGTH = 1_000_000_000, 12, 25


def weight(n_documents: Column, df: Column) -> Column:
    """Weight of a term that ``df`` of ``n_documents`` hold."""
    share = (F.lit(2) * n_documents + 2).cast("double") / (F.lit(2) * df + 1).cast("double")
    return F.floor(F.lit(1000.0) * F.log(share)).cast("long")


def length_factor(n: Column, documents: int, terms: int) -> Column:
    """m of a document with ``n`` of all ``terms`` in ``documents``."""
    return F.lit(100 - LENGTH).cast("long") + F.call_function("div", F.lit(LENGTH).cast("long") * n * F.lit(documents).cast("long"), F.lit(max(1, terms)).cast("long"))


def _bits(hashes: np.ndarray, level: int, width: int) -> np.ndarray:
    """The signature bits of a term's level: one row per hash, one column per bit it sets."""
    with np.errstate(over="ignore"):
        x = (hashes.view(np.uint64) + np.uint64(level)) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        step = (x >> np.uint64(32)) | np.uint64(1)
        at = x[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)
        at = (at ^ (at >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
    return (at >> np.uint64(64 - width)).astype(np.int32)


class _Block:
    """Signatures of one width, by document until the block is written by bit."""

    def __init__(self, width: int):
        self.width = width
        self.room = max(8, min(BLOCK_DOCUMENTS, BLOCK_BITS >> width))
        self.rows, self.m, self.bits = [], [], []

    def add(self, row: int, m: int, bits: np.ndarray) -> bool:
        self.rows.append(row)
        self.m.append(m)
        self.bits.append(bits)
        return len(self.rows) >= self.room

    def record(self) -> dict:
        n = -(-len(self.rows) // 8) * 8
        slices = np.zeros((1 << self.width, n // 8), dtype=np.uint8)
        at = np.concatenate(self.bits)
        of = np.repeat(np.arange(len(self.bits)), [len(b) for b in self.bits])
        np.bitwise_or.at(slices, (at, of >> 3), (128 >> (of & 7)).astype(np.uint8))
        return {"width": self.width, "rows": self.rows, "m": self.m, "slices": slices.tobytes()}


_INDEX = pa.schema([("width", pa.int32()), ("rows", pa.list_(pa.int64())), ("m", pa.list_(pa.int64())), ("slices", pa.binary())])
INDEX = "width int, rows array<bigint>, m array<bigint>, slices binary"


def _signatures(batches):
    """Blocks of bit slices from rows of (row, m, hashes of all words)."""
    blocks: dict[int, _Block] = {}
    for batch in batches:
        rows, ms, lists = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)
        for i, (row, m) in enumerate(zip(rows, ms, strict=True)):
            hashes, tf = np.unique(lists[i].values.to_numpy(), return_counts=True)
            levels = [hashes[tf >= 1 << k] for k in range(LEVELS)]
            size = sum(map(len, levels)) * BITS_PER_TERM
            width = min(WIDEST, max(NARROWEST, int(size - 1).bit_length()))
            bits = np.concatenate([_bits(h, k, width).ravel() for k, h in enumerate(levels)])
            block = blocks.setdefault(width, _Block(width))
            if block.add(row, m, bits):
                yield pa.RecordBatch.from_pylist([blocks.pop(width).record()], schema=_INDEX)
    for block in blocks.values():
        yield pa.RecordBatch.from_pylist([block.record()], schema=_INDEX)


def _part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term's occurrences add for each unit of its weight."""
    return SCALE * tf // (1000 * tf + DAMP * m)


def upper_bounds(block: dict, hashes: np.ndarray, items: list[tuple[int, np.ndarray, np.ndarray]]):
    """For every item (number, places of its terms, their weights): its bounds over the documents of a block."""
    m = np.array(block["m"], dtype=np.int64)
    slices = np.frombuffer(block["slices"], dtype=np.uint8).reshape(1 << block["width"], -1)
    # Level by level, whether a document may hold the term so often; a level needs those below it.
    present, levels = None, []
    for level in range(LEVELS):
        bits = _bits(hashes, level, block["width"])
        found = slices[bits[:, 0]]
        for k in range(1, HASHES):
            found = found & slices[bits[:, k]]
        present = found if present is None else present & found
        levels.append(np.unpackbits(present, axis=1, count=len(m)))
    # A term of level k and no higher occurs less than 2 ** (k + 1) times; nothing bounds the highest.
    most = [_part(np.full(len(m), (2 << k) - 1), m) for k in range(LEVELS - 1)] + [np.full(len(m), SCALE // 1000)]
    gain = np.diff(np.vstack([np.zeros(len(m), dtype=np.int64), *most]), axis=0).astype(np.float64)
    any_term = [x.any(axis=1) for x in levels]
    for number, places, weights in items:
        bound = np.zeros(len(m))
        for level in range(LEVELS):
            some = any_term[level][places]
            if not some.any():
                break
            bound += gain[level] * (weights[some] @ levels[level][places[some]].astype(np.float64))
        yield number, bound


def _probe(hashes: np.ndarray, items: list, least: dict[int, float] | None, k: int):
    """Documents by item with their bounds: the ``k`` largest of every block, or all that reach ``least``."""
    schema = pa.schema([("item", pa.int64()), ("row", pa.int64()), ("bound", pa.float64())])

    def run(batches):
        for batch in batches:
            for block in batch.to_pylist():
                rows = np.array(block["rows"], dtype=np.int64)
                for number, bound in upper_bounds(block, hashes, items):
                    if least is None:
                        at = np.argpartition(-bound, min(k, len(bound)) - 1)[:k]
                        at = at[bound[at] > 0]
                    else:
                        at = np.flatnonzero((bound > 0) & (bound >= least.get(number, 0.0)))
                    if len(at):
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), number)), pa.array(rows[at]), pa.array(bound[at])], schema=schema)

    return run


def tokenized(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``row`` (unique), ``doc_id``, number of terms and ``words`` of all documents that have any, in the shared folder."""
    words = docs.select(F.col(doc_id).alias("doc_id"), alphanumeric_words(F.col(text)).alias("words"))
    some = words.select("doc_id", F.size("words").cast("long").alias("n"), "words").filter("n > 0")
    return stored(some.withColumn("row", F.monotonically_increasing_id()), "search-words")


def signatures(words: DataFrame, documents: int, terms: int) -> DataFrame:
    """The index: blocks of bit slices over tokenized documents, in the shared folder."""
    rows = words.select("row", length_factor(F.col("n"), documents, terms).alias("m"), F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    return stored(rows.mapInArrow(_signatures, INDEX), "bit-slices")


def _exact(items: dict[int, list[tuple[str, int]]], documents: int, terms: int):
    """Scores of rows (row, words, items, id) for each of their items, from its terms and their weights."""
    known = {term for asked in items.values() for term, _ in asked}

    def run(batches):
        for batch in batches:
            found, at = [], []
            for place, (row, words, asked) in enumerate(zip(*(batch.column(i) for i in range(3)), strict=True)):
                row, words = row.as_py(), words.as_py()
                m = 100 - LENGTH + LENGTH * len(words) * documents // max(1, terms)
                parts: dict[str, int] = {}
                for term, tf in Counter(filter(known.__contains__, words)).items():
                    parts[term] = SCALE * tf // (1000 * tf + DAMP * m)
                for item in asked.as_py():
                    score = sum(w * parts.get(term, 0) for term, w in items[item])
                    if score > 0:
                        found.append((item, row, score))
                        at.append(place)
            columns = [pa.array([f[i] for f in found], pa.int64()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*columns, batch.column(3).take(pa.array(at, pa.int64()))], names=["item", "row", "score", "doc_id"])

    return run


def _scores(pairs: DataFrame, words: DataFrame, items: dict, documents: int, terms: int) -> DataFrame:
    """Exact scores above 0 of (item, row) pairs: ``item, row, doc_id, score``. Only words of the rows asked for are read."""
    wanted = stored(pairs.groupBy("row").agg(F.collect_list("item").alias("items")), "search-rows")
    read = words.join(small_side(wanted, pairs.count(), PAIRS), "row")
    kind = words.schema["doc_id"].dataType.simpleString()
    return read.select("row", "words", "items", "doc_id").mapInArrow(_exact(items, documents, terms), f"item bigint, row bigint, score bigint, doc_id {kind}")


def _first(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of every item, with their rank; at most ``k`` a task and item reach the window."""
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last(), "row")
    return scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 20, doc_id: str = "doc_id", text: str = "text",
           item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``k`` best documents of every item: ``item_id, rank, doc_id, score``; fewer if fewer score above 0.

    Terms are runs of ASCII digits, letters (A-Z lower-cased) and characters beyond ASCII. Equal scores go by document
    id (a null one last), repeated documents are ranked each. Every row of ``items`` is an item of its own, whatever
    its id; one whose terms no document has, or that has none (a null or empty text), gets no rows. Empty tables give
    an empty result, other columns are not looked at.

    All documents are indexed and none is left out without proof: the k documents with the largest bounds are scored
    first, then all whose bound reaches the k-th of these scores. Words are read from the tokenized table, so texts
    are split once. Items are searched ``ITEMS_AT_ONCE`` together, which bounds what is sent to tasks.
    """
    words = tokenized(docs, doc_id, text)
    size = words.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
    documents, terms = size["documents"], size["terms"]
    numbered = stored(items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("body"), F.monotonically_increasing_id().alias("item")), "search-items")
    asked = numbered.select("item", F.explode(alphanumeric_words(F.col("body"))).alias("term")).groupBy("item", "term").agg(F.count(F.lit(1)).alias("qtf"))
    asked = stored(asked, "search-asked")
    wanted = stored(asked.select("term").distinct(), "search-terms")
    distinct = words.select(F.explode(F.array_distinct("words")).alias("term")).join(small_side(wanted, wanted.count()), "term")
    df = stored(distinct.groupBy("term").agg(F.count(F.lit(1)).alias("df")), "search-df")
    weighted = asked.join(df, "term").select("item", "term", "qtf", weight(F.lit(documents).cast("long"), F.col("df")).alias("w")).filter("w > 0")
    weighted = stored(weighted, "search-weights")
    index = signatures(words, documents, terms)
    turns = max(1, -(-numbered.count() // ITEMS_AT_ONCE))
    best = None
    for turn in range(turns):
        mine = weighted.filter(F.pmod(F.xxhash64("item"), F.lit(turns)) == turn) if turns > 1 else weighted
        found = _search(words, index, mine, k, documents, terms)
        best = found if best is None else best.unionByName(found)
    return numbered.select("item", "item_id").join(best, "item").select("item_id", "rank", "doc_id", "score")


def _search(words: DataFrame, index: DataFrame, weighted: DataFrame, k: int, documents: int, terms: int) -> DataFrame:
    rows = weighted.select("item", "term", F.xxhash64("term").alias("hash"), (F.col("qtf") * F.col("w")).alias("w")).toArrow()
    hashes, places = np.unique(rows.column("hash").to_numpy(), return_inverse=True)
    item, w = rows.column("item").to_numpy(), rows.column("w").to_numpy().astype(np.float64)
    items: dict[int, list[tuple[str, int]]] = {}
    for i, term, n in zip(*(rows.column(c).to_pylist() for c in ("item", "term", "w")), strict=True):
        items.setdefault(i, []).append((term, n))
    order = np.argsort(item, kind="stable")
    numbers, starts = np.unique(item[order], return_index=True)
    asked = [(int(i), places[at], w[at]) for i, at in zip(numbers, np.split(order, starts[1:]), strict=True)] if len(numbers) else []
    schema = "item bigint, row bigint, bound double"
    top = Window.partitionBy("item").orderBy(F.desc("bound"), "row")
    likely = index.mapInArrow(_probe(hashes, asked, None, k), schema).withColumn("place", F.row_number().over(top)).filter(F.col("place") <= k)
    likely = stored(likely.select("item", "row"), "search-likely")
    lowest = _scores(likely, words, items, documents, terms).groupBy("item").agg(F.min("score").alias("score"), F.count(F.lit(1)).alias("n"))
    # A little less, as bounds are sums of doubles.
    least = {r["item"]: r["score"] * (1 - 1e-9) for r in lowest.filter(F.col("n") == k).collect()}
    pairs = stored(index.mapInArrow(_probe(hashes, asked, least, k), schema).select("item", "row"), "search-candidates")
    return stored(_first(_scores(pairs, words, items, documents, terms), k).select("item", "rank", "doc_id", "score"), "search-best")
