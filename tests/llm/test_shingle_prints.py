"""The near-duplicate stage links SimHash fingerprints by the pigeonring before its bands propose pairs."""

import random

import brute
import corpus_pipeline
import numpy as np
import pytest
from tillstar.llm import shingles, simhash


def bits(a, b):
    return (a ^ b).bit_count()


def mark(text):
    return simhash.hash_fingerprint(shingles.shingle_set(text))


def near_copies(seed, words, changed, groups=12):
    rng = random.Random(seed)
    out = []
    for g in range(groups):
        base = [f"w{rng.randrange(5000)}" for _ in range(words)]
        copy = list(base)
        for at in range(changed):
            copy[(at + 1) * words // (changed + 1)] = "changed"
        out += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(copy))]
    return out


def test_fingerprint_of_hashes():
    h = np.array([0b011, 0b001, 0b101], dtype=np.uint64)
    assert simhash.hash_fingerprint(h) == 0b001
    assert simhash.hash_fingerprint(h[:0]) == 0
    many = np.arange(simhash.HASH_CHUNK + 3, dtype=np.uint64)
    assert simhash.hash_fingerprint(many) == sum(1 << b for b in range(64) if 2 * sum(int(v) >> b & 1 for v in many) > len(many))


def test_close_nodes_name_the_smallest_neighbour(spark):
    """Pairs of up to two bits, no more than nodes: every node with a smaller close one is named once."""
    rng = random.Random(12)
    prints = [rng.getrandbits(64) for _ in range(30)]
    for base in prints[:6]:
        prints += [base, base ^ 1 << rng.randrange(64), base ^ 1 << rng.randrange(64) ^ 1 << rng.randrange(64)]
    # One large group, beyond the limit for pairs.
    prints += [prints[7] ^ 1 << i for i in range(60)]
    rows = [(n, p - (1 << 64) if p >= 1 << 63 else p) for n, p in enumerate(prints)]
    got = [(r.b, r.a) for r in shingles.close_nodes(spark.createDataFrame(rows, "node long, fingerprint long")).collect()]
    assert all(a < b and bits(prints[a], prints[b]) <= 2 for b, a in got)
    want = {b for b in range(len(prints)) if any(bits(prints[a], prints[b]) <= 2 for a in range(b))}
    assert sorted(b for b, _ in got) == sorted(want) and len(want) > 70
    assert shingles.close_nodes(spark.createDataFrame([], "node long, fingerprint long")).count() == 0


def test_stage_links_fingerprints_without_bands(spark, monkeypatch):
    monkeypatch.setattr(shingles, "band_keys", lambda hashes: [])
    rows = near_copies(5, 3000, 1)
    close = {b for (_, x), (b, y) in zip(rows[::2], rows[1::2], strict=True) if bits(mark(x), mark(y)) <= 2}
    assert len(close) > 3
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = {r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()}
    assert kept == {i for i, _ in rows} - close


@pytest.mark.parametrize("pair_limit", [1, 1000])
def test_close_pairs_change_no_group(spark, pair_limit):
    """Close fingerprints are only proposed: what their sets do not confirm, and what they leave apart, the bands decide."""
    rows = near_copies(6, 400, 1, 6) + [(100 + i, t) for i, t in near_copies(7, 150, 2, 6)]
    sets = {i: shingles.shingle_set(t) for i, t in rows}
    frame = spark.createDataFrame([(i, bytearray(s.tobytes())) for i, s in sets.items()], "node long, set binary")
    keys = spark.createDataFrame([(k, i) for i, s in sets.items() for k in set(shingles.band_keys(s))], "key long, node long")
    # Links that are right, links of different texts, and none.
    close = spark.createDataFrame([(0, 1), (0, 2), (1, 102), (100, 101)], "a long, b long")
    want = brute.near_groups(rows)
    for some in (close, close.limit(0), None):
        groups = brute.Groups()
        for r in shingles.similar_nodes(keys, lambda nodes: frame.join(nodes, "node"), pair_limit, some).collect():
            groups.join(r.a, r.b)
        assert {i: groups.find(i) for i, _ in rows} == want


def test_sets_are_measured_once(spark, monkeypatch):
    """No stored frame runs Python twice in a task, as a filter moved below what it filters would."""
    plans, kept = [], shingles.stored

    def seen(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython ["))
        return kept(df, name)

    monkeypatch.setattr(shingles, "stored", seen)
    docs = spark.createDataFrame(near_copies(8, 200, 1, 4), "id long, text string")
    assert shingles.representatives(docs, "id", pair_limit=1).count() == 4
    assert max(plans) == 1
