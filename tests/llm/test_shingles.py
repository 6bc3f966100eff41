"""Shingle similarity against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

import brute
import corpus_pipeline
from tillstar.llm import shingles


def shingle_set(text):
    words = text.lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def jaccard(a, b):
    a, b = shingle_set(a), shingle_set(b)
    return len(a & b) / len(a | b) if a | b else 1.0


def texts():
    rng = random.Random(3)
    out = []
    for g in range(25):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice((4, 30, 120, 400)))]
        out.append(" ".join(base))
        for _ in range(6):
            copy = list(base)
            for _ in range(rng.randrange(1, 1 + max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = f"x{rng.randrange(5000)}"
            out.append(" ".join(copy))
    # One large group of near copies, and one of texts that share a half.
    base = [f"h{i}" for i in range(200)]
    out += [" ".join([*base, f"end{i}"]) for i in range(60)]
    out += [" ".join(base[:100] + [f"z{i}.{j}" for j in range(100)]) for i in range(40)]
    return [*out, "", " \n"]


@pytest.mark.parametrize("pair_limit", [2, 1000])
def test_kept_texts_against_all_pairs(spark, pair_limit):
    rows = list(enumerate(texts()))
    kept = {r.keep for r in shingles.representatives(spark.createDataFrame(rows, "id long, text string"), "id", pair_limit=pair_limit).collect()}
    groups = brute.Groups()
    near = [(i, j) for i, a in rows for j, b in rows[:i] if jaccard(a, b) >= 0.8]
    for i, j in near:
        groups.join(i, j)
    assert kept == {groups.find(i) for i, _ in rows}


@pytest.mark.parametrize("pair_limit", [1, 3, 1000])
def test_chains_in_a_full_key(spark, pair_limit):
    """Near each other are neighbours only; the chain is found whole whether or not its key is full."""
    ids = range(12)
    sets = {i: np.arange(100 * 8 * i // 100, 100 * 8 * i // 100 + 100, dtype=np.uint64) + np.uint64(0) for i in ids}
    near = {(i, j) for i in ids for j in ids if i < j and len(np.intersect1d(sets[i], sets[j])) * 5 >= 4 * len(np.union1d(sets[i], sets[j]))}
    assert near == {(i, i + 1) for i in ids[:-1]}
    order = random.Random(2).sample(list(ids), len(ids))
    keys = spark.createDataFrame([(7, order[i]) for i in ids], "key long, node long")
    frame = spark.createDataFrame([(order[i], bytearray(sets[i].tobytes())) for i in ids], "node long, set binary")
    links = shingles.similar_nodes(keys, lambda nodes: frame.join(nodes, "node"), pair_limit)
    groups = brute.Groups()
    for r in links.collect():
        groups.join(r.a, r.b)
    assert len({groups.find(i) for i in ids}) == 1


def test_stage_finds_near_copies_that_simhash_misses(spark):
    rng = random.Random(4)
    rows = []
    for g in range(20):
        base = [f"w{rng.randrange(5000)}" for _ in range(150)]
        copy = list(base)
        copy[40] = copy[110] = "changed"
        rows += [(2 * g, " ".join(base), 1), (2 * g + 1, " ".join(copy), 2)]
        assert 0.8 <= jaccard(rows[-1][1], rows[-2][1]) < 1
    docs = spark.createDataFrame(rows, "doc_id long, text string, no int")
    assert sorted(r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()) == list(range(0, 40, 2))
    assert corpus_pipeline.drop_near_duplicates(spark, docs.limit(0), "").count() == 0


def near_cloud(seed, size):
    """Copies of one text with one to eight words changed: some are near it, most are only close to being near."""
    rng = random.Random(seed)
    base = [f"c{i}" for i in range(150)]
    out = []
    for i in range(size):
        copy = list(base)
        for at in rng.sample(range(150), rng.randrange(1, 9)):
            copy[at] = f"y{i}.{at}"
        out.append(" ".join(copy))
    return out


def test_marks_rule_out_no_near_pair(spark):
    rng = np.random.default_rng(9)
    whole = [rng.integers(0, 1 << 63, size=n, dtype=np.uint64) for n in (1, 5, 100, 150, 3000)]
    sets = {i: np.unique(w) for i, w in enumerate([*whole, *[w[:-len(w) // 9 or None] for w in whole], *[shingles.shingle_set(t) for t in near_cloud(1, 30)], whole[0][:0]])}
    marked = shingles._marks(pa.array([s.tobytes() for s in sets.values()], pa.binary())).to_pylist()
    rows = [(i, j, tuple(marked[i].values()), tuple(marked[j].values())) for i in sets for j in sets if i < j]
    kind = f"struct<{','.join(f'{f.name}:bigint' for f in shingles._MARKED)}>"
    met = spark.createDataFrame(rows, f"a long, b long, x {kind}, y {kind}")
    possible = {(r.a, r.b) for r in met.filter(shingles._may_be_near("x", "y")).collect()}
    near = {(i, j) for i, j, *_ in rows if 5 * len(np.intersect1d(sets[i], sets[j])) >= 4 * len(np.union1d(sets[i], sets[j]))}
    assert near <= possible and len(near) > 10 and len(possible) < len(rows) / 2


def test_texts_not_quite_near_are_not_measured(spark, monkeypatch):
    """A large group that shares its bands costs few comparisons of sets, and loses no link."""
    measured, kept = [], shingles.stored

    def seen(df, name):
        out = kept(df, name)
        if name == "shingle-links":
            measured.append(out.count())
        return out

    monkeypatch.setattr(shingles, "stored", seen)
    rows = list(enumerate(near_cloud(2, 300)))
    sets = {i: shingle_set(t) for i, t in rows}
    groups = brute.Groups()
    for i, _ in rows:
        for j in range(i):
            if len(sets[i] & sets[j]) * 5 >= 4 * len(sets[i] | sets[j]):
                groups.join(i, j)
    want = {groups.find(i) for i, _ in rows}
    got = {r.keep for r in shingles.representatives(spark.createDataFrame(rows, "id long, text string"), "id").collect()}
    assert got == want and len(want) > 100
    assert sum(measured) < 5 * len(rows)


def test_repeats_are_what_is_not_kept(spark):
    a, b = " ".join(f"a{i}" for i in range(40)), " ".join(f"b{i}" for i in range(60))
    # Equal rows; the same shingles by another id; a near copy; a text of its own; equal rows that a smaller id stands for.
    rows = [(1, a), (1, a), (2, a.upper()), (3, b), (4, b + " end"), (5, "alone"), (6, b), (6, b)]
    got = {(r.id, r.stays) for r in shingles.repeats(spark.createDataFrame(rows, "id long, text string"), "id").collect()}
    assert got == {(1, True), (2, False), (4, False), (6, False)}
