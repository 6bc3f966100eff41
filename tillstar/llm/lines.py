"""Line deduplication by a segment-partition edit join, on DataFrame functions only.

Lines within ``EDITS`` edits agree in one of ``EDITS`` + 1 segments: of the shorter line the segments at their
own place, of the longer one the substrings that can be aligned with them. Hashes of (length, segment number,
substring) are the index and the probes; lines that meet in one are verified on what lies outside the segment.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import small_side, stored
from tillstar.llm.components import components

EDITS = 1
# Shorter lines are not joined by edits, only by equality.
MIN_CHARS = 24
# Lines of one key beyond which they are linked by deletion variants instead of pairs.
PAIR_LIMIT = 24
_BLANK = " \t\r\x0b\x0c"


def occurrences(docs: DataFrame, doc_id: str, text: str, min_chars: int) -> DataFrame:
    """Every line long enough, with its place and the 128-bit hash of its body (without outer white space)."""
    base = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(F.col(text)).alias("row"), F.posexplode(F.split(F.col(text), "\n")).alias("no", "line"))
    body = base.select("doc_id", "row", "no", F.btrim("line", F.lit(_BLANK)).alias("body")).filter(F.char_length("body") >= min_chars)
    return body.withColumn("id", F.unhex(F.md5("body")))


def _segment(length: Column, i: int) -> tuple[Column, Column]:
    """0-based start and length of segment ``i``: equal parts, the last takes the rest."""
    part = F.floor(length / (EDITS + 1)).cast("int")
    return part * i, (length - part * i) if i == EDITS else part


def _key(length: Column, i: int, part: Column) -> Column:
    return F.xxhash64(length, F.lit(i), part)


def _keys(body: Column, n: Column) -> Column:
    """Index entries (probe false) and probes of a line: segment, indexed length, key.

    A probe for lines shorter by d shifts segment i by s only if the parts before and after it leave enough
    edits: |s| <= i and |s - d| <= EDITS - i. The unshifted probe for equal length is the index entry itself.
    """
    entries = []
    for d in range(EDITS + 1):
        for i in range(EDITS + 1):
            length = n - d
            start, size = _segment(length, i)
            for s in range(max(-i, d - (EDITS - i)), min(i, d + (EDITS - i)) + 1):
                part = F.substr(body, start + s + 1, size)
                entries.append(F.struct(F.lit(i).alias("segment"), length.alias("length"), F.lit((d, s) != (0, 0)).alias("probe"), _key(length, i, part).alias("key")))
    return F.array(*entries)


def within_edits(a: Column, b: Column) -> Column:
    """Whether two texts are at most ``EDITS`` edits apart, by a banded bit-parallel automaton.

    Bit o of row e says that so much of b is matched by o - EDITS more characters of a with at most e errors.
    One step per character of b updates all rows with a few bit operations; the band is 2 * EDITS + 1 wide.
    """
    band = 2 * EDITS + 1
    full = (1 << band) - 1
    shift = lambda f, v: F.call_function(f, v, F.lit(1))

    def step(at_j: Column, j: Column) -> Column:
        match = F.lit(0)
        for o in range(band):
            at = j + (o - EDITS)
            same = F.when(at >= 0, F.get(at_j["x"], at) == F.get(at_j["y"], j))
            match = match.bitwiseOR(F.when(same, F.lit(1 << o)).otherwise(F.lit(0)))
        new = []
        for e in range(EDITS + 1):
            row = at_j[f"r{e}"].bitwiseAND(match)
            if e:
                old = at_j[f"r{e - 1}"]
                row = row.bitwiseOR(old).bitwiseOR(shift("shiftright", old)).bitwiseOR(shift("shiftleft", new[-1])).bitwiseAND(F.lit(full))
            new.append(row)
        return F.struct(at_j["x"].alias("x"), at_j["y"].alias("y"), *[r.alias(f"r{e}") for e, r in enumerate(new)])

    # The characters travel in the state, so that they are split once. With e errors the first e characters of a
    # may be skipped before b begins.
    rows = [F.lit(sum(1 << (EDITS + k) for k in range(e + 1))).alias(f"r{e}") for e in range(EDITS + 1)]
    start = F.struct(F.split(a, "").alias("x"), F.split(b, "").alias("y"), *rows)
    n, m = F.char_length(b), F.char_length(a)
    last = F.aggregate(F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>")), start, step)
    bit = m - n + EDITS
    return (F.abs(m - n) <= EDITS) & (F.getbit(last[f"r{EDITS}"], F.least(F.greatest(bit, F.lit(0)), F.lit(band - 1))) == 1)


def _half_agrees(a: Column, b: Column) -> Column:
    """A condition for one edit that is quick to check: the first or the last half of the shorter is in place in both."""
    half = F.floor(F.least(F.char_length(a), F.char_length(b)) / 2).cast("int")
    end = lambda c: F.substr(c, F.char_length(c) - half + 1, half)
    return (F.substr(a, F.lit(1), half) == F.substr(b, F.lit(1), half)) | (end(a) == end(b))


def similar_lines(distinct: DataFrame, bodies, pair_limit: int = PAIR_LIMIT) -> DataFrame:
    """Links ``a, b`` between ids of distinct lines, connecting all lines within ``EDITS`` edits of each other.

    ``distinct`` has ``id, keys``; ``bodies(ids, n)`` gives ``id, body`` of the n ids that share a key with another line.
    A key shared by more lines than ``pair_limit`` gives no pairs: every indexed line names its free part
    (outside the segment) with each one character left out, by position. Lines of equal length that name the
    same are one substitution apart and form a star; a longer line meets the shorter one whose whole free part
    it names. That work is linear in the characters of such lines.
    """
    rows = distinct.select("id", F.explode("keys").alias("k")).select("id", "k.*")
    counts = rows.groupBy("key").agg(F.count_if(~F.col("probe")).alias("indexed"), F.count(F.lit(1)).alias("n")).filter("indexed > 0 and n > 1")
    met = stored(rows.join(counts.select("key", "n"), "key"), "line-keys")
    ids = stored(met.select("id").distinct(), "line-ids")
    lines = bodies(ids, ids.count())
    start, size = F.lit(0), F.lit(0)
    for i in range(EDITS + 1):
        s, z = _segment(F.col("length"), i)
        start, size = F.when(F.col("segment") == i, s).otherwise(start), F.when(F.col("segment") == i, z).otherwise(size)
    # With two segments the shared one is a prefix or a suffix of both lines.
    n, prefix = F.char_length("body"), F.col("segment") == 0
    shared = F.when(prefix, F.substr("body", F.lit(1), size)).otherwise(F.substr("body", n - size + 1, size))
    free = F.when(prefix, F.substr("body", size + 1, n - size)).otherwise(F.substr("body", F.lit(1), n - size))
    known = stored(met.join(lines, "id").select("key", "n", "probe", "id", shared.alias("shared"), free.alias("free")), "line-parts")
    # Pairs cost far more than their rows weigh, so these partitions are not to be merged for being small.
    partitions = int(known.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    few = known.filter(F.col("n") <= pair_limit).repartition(partitions, "key", "shared")
    many = known.filter(F.col("n") > pair_limit)
    named = lambda df, c: df.select("key", "shared", F.col("id").alias(c), F.col("probe").alias(f"{c}_probe"), F.col("free").alias(f"{c}_free"))
    pairs = named(few, "a").join(named(few.filter(~F.col("probe")), "b"), ["key", "shared"]) \
        .filter((F.col("a_probe") | (F.col("a") < F.col("b"))) & (F.col("a") != F.col("b"))) \
        .filter(_half_agrees(F.col("a_free"), F.col("b_free"))).filter(within_edits(F.col("a_free"), F.col("b_free"))).select("a", "b")
    cut = lambda at: F.concat(F.substr(F.col("free"), F.lit(1), at), F.substr(F.col("free"), at + 2, F.char_length("free")))
    places = F.when(F.char_length("free") > 0, F.sequence(F.lit(0), F.char_length("free") - 1)).otherwise(F.array().cast("array<int>"))
    variants = many.select("key", "shared", "probe", "id", F.explode(F.transform(places, lambda p: F.struct(p.alias("at"), F.md5(cut(p)).alias("rest")))).alias("v")) \
        .select("key", "shared", "probe", "id", "v.*")
    same = variants.filter(~F.col("probe")).groupBy("key", "shared", "at", "rest").agg(F.min("id").alias("a"), F.count(F.lit(1)).alias("n")).filter("n > 1").drop("n")
    stars = variants.filter(~F.col("probe")).join(same, ["key", "shared", "at", "rest"]).filter("id <> a").select("a", F.col("id").alias("b"))
    whole = many.filter(~F.col("probe")).select("key", "shared", F.md5("free").alias("rest"), F.col("id").alias("a"))
    longer = variants.filter("probe").join(whole, ["key", "shared", "rest"]).select("a", F.col("id").alias("b"))
    return pairs.unionByName(stars).unionByName(longer).distinct()


def repeated_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int | None = None) -> DataFrame:
    """Lines to remove, per document row: ``doc_id, row`` (hash of the text), ``removed`` (line numbers from 0).

    Lines are equal when at most ``EDITS`` edits apart, directly or through other lines, those of under ``MIN_CHARS``
    code points only when they are the same; the first of them, by id (a null id last), text hash and line number,
    stays. With ``min_chars`` that length replaces ``MIN_CHARS`` and shorter lines stay. Blank lines stay. Null and
    empty texts have no lines to remove. Rows that repeat id and text lose the same lines.
    """
    seen = occurrences(docs, doc_id, text, 1 if min_chars is None else min_chars)
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row", "no")
    n = F.char_length("body")
    keys = F.when(n >= (MIN_CHARS if min_chars is None else min_chars), _keys(F.col("body"), n))
    distinct = stored(seen.select("id", place.alias("place"), keys.alias("keys")).groupBy("id").agg(
        F.min("place").alias("place"), F.count(F.lit(1)).alias("n"), F.first("keys").alias("keys")), "lines")

    def bodies(ids: DataFrame, rows: int) -> DataFrame:
        return seen.select("id", "body").join(small_side(ids, rows), "id", "left_semi").groupBy("id").agg(F.first("body").alias("body"))

    roots = stored(components(similar_lines(distinct.select("id", "keys"), bodies)), "line-roots")
    linked = distinct.select("id", "place", "n").join(roots, distinct["id"] == roots["node"], "left")
    firsts = linked.filter("root is not null").groupBy("root").agg(F.min("place").alias("first"))
    repeated = stored(
        linked.filter("root is null and n > 1").select("id", F.col("place").alias("first")).unionByName(
            linked.filter("root is not null").join(firsts, "root").select("id", "first")), "repeated-lines")
    later = seen.select("id", "doc_id", "row", "no", place.alias("place")).join(small_side(repeated, repeated.count()), "id") \
        .filter("place <> first")
    return later.groupBy("doc_id", "row").agg(F.sort_array(F.collect_set("no")).alias("removed"))


def dedup_lines(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_chars: int | None = None) -> DataFrame:
    """``doc`` (the row as it was), ``text`` without repeated lines, ``n_lines`` and ``removed``; see ``repeated_lines``.

    Every row is returned, in whole; a text that loses all lines becomes empty, a null text stays null. An empty
    table gives an empty result. Columns of any name travel inside ``doc``.
    """
    removed = stored(repeated_lines(docs, doc_id, text, min_chars), "removed-lines")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    side = small_side(removed.select(F.col("doc_id").alias("k"), F.col("row").alias("r"), "removed"), removed.count())
    joined = rows.join(side, F.col(f"doc.{doc_id}").eqNullSafe(F.col("k")) & (F.xxhash64(F.col(f"doc.{text}")) == F.col("r")), "left")
    parts = F.split(F.col(f"doc.{text}"), "\n")
    kept = F.filter(parts, lambda line, i: ~F.array_contains("removed", i))
    return joined.select(
        "doc", F.when(F.col("removed").isNull(), F.col(f"doc.{text}")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.coalesce(F.size(parts), F.lit(0)).alias("n_lines"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))
