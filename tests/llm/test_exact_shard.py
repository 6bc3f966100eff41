"""Exact duplicates and shards against plain Python."""

import re
import zlib
from collections import Counter, defaultdict

from brute import SPACE, sha
from tillstar.llm import exact, shard

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, body int"


def frame(spark, rows):
    """Documents with columns that the operators use as names of their own."""
    return spark.createDataFrame([(i, t, "en", "s", 1, "x", 7) for i, t in rows], SCHEMA)


def test_exact_duplicates(spark):
    rows = [(5, "a b"), (2, "ab"), (9, "a  b"), (3, None), (4, " \n"), (7, "ab "), (None, "a  b"), (1, "Ab"), (8, "é" * 50_000), (8, "é" * 50_000)]
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(SPACE + "+", "", t or "")].append((i, len(t or "")))
    want = []
    for body, members in groups.items():
        keep = min(members, key=lambda m: (-m[1], m[0] is None, m[0] or 0))
        stays = members.index(keep)
        want += [(i, keep[0], len(members), k == stays, sha(body)) for k, (i, n) in enumerate(members)]
    got = [tuple(r) for r in exact.exact_duplicates(frame(spark, rows)).collect()]
    assert Counter(got) == Counter(want)
    assert exact.exact_duplicates(frame(spark, [])).count() == 0


def test_one_of_many_equal_rows_stays(spark):
    """More copies than one block holds, with null ids among them, next to rows that differ in white space only."""
    rows = [(3, "a b")] * 9000 + [(3, "ab ")] * 5 + [(4, "a b")] + [(None, None)] * 4100 + [(6, "x")]
    got = Counter(tuple(r)[:4] for r in exact.exact_duplicates(frame(spark, rows)).collect())
    assert got == {(3, 3, 9006, True): 1, (3, 3, 9006, False): 9004, (4, 3, 9006, False): 1,
                   (None, None, 4100, True): 1, (None, None, 4100, False): 4099, (6, 6, 1, True): 1}


def test_collision_fails_loudly(spark):
    import pytest
    from pyspark.sql import functions as F

    rows = exact.content(frame(spark, [(1, "a"), (2, "b")])).withColumn("hash", F.lit(b"x")).withColumn("text_sha256", F.lit("y"))
    with pytest.raises(Exception, match="equal MD5"):
        exact.duplicate_classes(rows).collect()


def test_shards_are_even_and_numbered(spark):
    rows = [(i, "w" * (i * 37 % 90) if i % 7 else None) for i in range(3000)] + [(10_000 + i, "same text") for i in range(1500)]
    df = frame(spark, rows)
    got = shard.document_shards(df, shards=24).collect()
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows)
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert set(sizes) == set(range(24)) and max(sizes.values()) < 1.05 * min(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_by_target_bytes_and_edge_cases(spark):
    rows = [(i, "x" * 92) for i in range(100)]
    got = shard.document_shards(frame(spark, rows), target_bytes=2500).collect()
    assert Counter(r.shard for r in got) == {k: 25 for k in range(4)} or max(Counter(r.shard for r in got).values()) <= 28
    assert shard.document_shards(frame(spark, []), shards=3).count() == 0
    one = shard.document_shards(frame(spark, [(None, None)] * 3), shards=2).collect()
    assert sorted(Counter(r.shard for r in one).values()) in ([1, 2], [3])
    assert all(sorted(r.slot for r in one if r.shard == k) == list(range(n)) for k, n in Counter(r.shard for r in one).items())


def test_equal_rows_part(spark):
    """One row repeated is a third of all bytes and more than any shard may hold."""
    rows = [(i, "w" * (i % 50)) for i in range(4000)] + [(77, "the same row again")] * 3000
    got = shard.document_shards(frame(spark, rows), shards=24).collect()
    sizes, slots = Counter(), defaultdict(list)
    for r in got:
        sizes[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(got) == len(rows) and max(sizes.values()) < 1.1 * min(sizes.values())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_every_cut_lies_at_the_weighted_median(spark):
    """The leaves against plain Python: each node is cut along its widest dimension where the exact quantile lies."""
    import random

    rng = random.Random(4)
    points = [(i, rng.choice([0.0, 5.0, 5.0, 5.0, 40.0, None]), rng.gauss(0, 3), rng.randrange(1, 200)) for i in range(3000)]
    df = spark.createDataFrame(points, "i long, x double, y double, size long")
    shards, columns = 7, (1, 2)
    leaf = {r.i: r.shard for r in shard.kd_tree_shards(df, "size", ["x", "y"], ["i"], shards=shards).collect()}
    spans = []
    for c in columns:
        known = [p[c] for p in points if p[c] is not None]
        spans.append((min(known), max(known) - min(known)))
    at = lambda p, d: 0.0 if p[columns[d]] is None else (p[columns[d]] - spans[d][0]) / spans[d][1]

    def check(node, first, leaves):
        if leaves == 1:
            assert node and all(leaf[p[0]] == first for p in node)
            return
        widths = [max(at(p, d) for p in node) - min(at(p, d) for p in node) for d in (0, 1)]
        d = 0 if widths[0] >= widths[1] else 1
        left = [p for p in node if leaf[p[0]] < first + leaves // 2]
        right = [p for p in node if leaf[p[0]] >= first + leaves // 2]
        goal = sum(p[3] for p in node) * (leaves // 2) / leaves
        assert abs(sum(p[3] for p in left) - goal) <= 2 * max(p[3] for p in node)
        step = widths[d] / shard.BUCKETS
        assert max(at(p, d) for p in left) <= min(at(p, d) for p in right) + step * 1.001
        check(left, first, leaves // 2)
        check(right, first + leaves // 2, leaves - leaves // 2)

    check(points, 0, shards)
