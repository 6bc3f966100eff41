"""SimHash components and line deduplication against all pairs."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from tillstar.llm import lines, simhash
from tillstar.llm.components import components

SCHEMA = "doc_id long, text string, fingerprint string, no int, row string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "y") for i, t in rows], SCHEMA)


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


@pytest.mark.parametrize("pair_limit", [1, 6, 1000])
def test_links_connect_what_all_pairs_connect(spark, pair_limit):
    rng = random.Random(7)
    prints = [rng.getrandbits(64) for _ in range(40)]
    # Chains and clouds around some of them, and all values near zero and all ones.
    for base in [*prints[:6], 0, (1 << 64) - 1]:
        at = base
        for _ in range(40):
            step = at if rng.random() < 0.5 else base
            for _ in range(rng.choice((1, 2, 2, 3))):
                step ^= 1 << rng.randrange(64)
            prints.append(step)
            at = step
    want = brute.hamming_components(prints)
    df = spark.createDataFrame([(signed(p),) for p in set(prints)], "fingerprint long")
    links = simhash.similar_fingerprints(df, pair_limit=pair_limit)
    got = brute.Groups()
    for r in links.collect():
        a, b = (v % (1 << 64) for v in (r.a, r.b))
        assert (a ^ b).bit_count() <= 2
        got.join(a, b)
    assert {p: got.find(p) for p in set(prints)} == want


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(0, 60)] + [(200, 100 + i) for i in range(50)] + [(300, 301), (301, 302), (302, 300), (5, 5)]
    links += [(rng.randrange(1000, 1100), rng.randrange(1000, 1100)) for _ in range(70)]
    groups = brute.Groups()
    for a, b in links:
        if a != b:
            groups.join(a, b)
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: groups.find(n) for n in list(groups.up)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates(spark):
    rng = random.Random(9)
    base = [" ".join(rng.choice("The OF and xyz É the of a b c".split()) for _ in range(400)) for _ in range(12)]
    rows = [(100 - i, t) for i, t in enumerate(base)]
    rows += [(200 + i, t + " end") for i, t in enumerate(base)] + [(300 + i, t.upper() if i % 2 else t) for i, t in enumerate(base)]
    rows += [(1000, None), (999, ""), (998, " \n\t"), (997, "one two"), (996, "ONE  two"), (None, "one two"), (995, "one\xa0two"), (995, "one\xa0two"), (994, "long " * 100_000)]
    prints = {i: brute.simhash(t) for i, t in rows}
    roots = brute.hamming_components(prints.values())
    smallest = {}
    for i, f in prints.items():
        if i is not None:
            smallest[roots[f]] = min(i, smallest.get(roots[f], i))
    want = sorted(((i, f"{prints[i]:016x}", smallest[roots[prints[i]]]) for i, _ in rows), key=repr)
    got = simhash.near_duplicates(frame(spark, rows))
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want
    assert simhash.near_duplicates(frame(spark, [])).count() == 0


def test_automaton_against_edit_distance(spark):
    rng = random.Random(10)
    pairs = [("", ""), ("a", ""), ("", "b"), ("ab", ""), ("é🙂", "🙂é")]
    for _ in range(1500):
        a = "".join(rng.choice("abé") for _ in range(rng.randrange(9)))
        b = list(a)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(b) + 1)
            b[at:at + rng.randrange(2)] = rng.choice(["", "a", "b", "é"])
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", lines.within_edits(F.col("a"), F.col("b")).alias("near"))
    for r in df.collect():
        assert r.near == (brute.edits(r.a, r.b) <= 1), (r.a, r.b)


def line_documents():
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdef ") for _ in range(rng.randrange(5, 40))).strip() or "x" for _ in range(25)]
    rows = []
    for d in range(60):
        body = []
        for _ in range(rng.randrange(0, 7)):
            line = rng.choice(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2))):
                at = rng.randrange(len(line) + 1)
                line = line[:at] + rng.choice(["", "q", "z"]) + line[at + rng.randrange(2):]
            body.append(rng.choice(["", " ", "\t"]) + line)
        rows.append((d, "\n".join(body)))
    # One shared half, very many other halves: both ends.
    rows += [(500 + i, "the same beginning of it " + "".join(rng.choice("ab") for _ in range(25))) for i in range(60)]
    rows += [(600 + i, "".join(rng.choice("ab") for _ in range(25)) + " the same ending of it all") for i in range(60)]
    return [*rows, (900, None), (901, ""), (None, base[0] + " and a null id that is long enough"), (902, base[0] + " and a null id that is long enough"),
            (903, "twice the same row\ntwice the same row"), (903, "twice the same row\ntwice the same row")]


@pytest.mark.parametrize("pair_limit", [2, 1000])
def test_removed_lines(spark, monkeypatch, pair_limit):
    monkeypatch.setattr(lines.similar_lines, "__defaults__", (pair_limit,))
    rows = line_documents()
    want = brute.removed_lines(rows[:-1], 12)
    got = lines.dedup_lines(frame(spark, rows), min_chars=12).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.removed == want[r.doc.doc_id], r
        text = dict(rows)[r.doc.doc_id]
        kept = None if text is None else "\n".join(x for n, x in enumerate(text.split("\n")) if n not in r.removed)
        assert r.text == kept and r.doc.text == text and (r.doc.row, r.doc.no) == ("y", 1)
    assert sum(map(len, want.values())) > 30
    assert lines.dedup_lines(frame(spark, [])).count() == 0
