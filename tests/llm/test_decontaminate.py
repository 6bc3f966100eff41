"""Winnowing against all windows."""

import random
from collections import Counter

from pyspark.sql import functions as F

import brute
from tillstar.llm import decontaminate

DOCS, ITEMS = "doc_id long, text string, words int, items string", "item_id long, text string, window string"


def run(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], DOCS)
    b = spark.createDataFrame([(i, t, "x") for i, t in items], ITEMS)
    found = decontaminate.contamination(d, b).withColumn("n_hit", F.size(decontaminate.hit_positions(F.col("hit_starts"))))
    return Counter((r.doc_id, r.n_words, r.n_hit, tuple(r["items"])) for r in found.collect())


def want(docs, items):
    return Counter((d, n, h, tuple(i)) for d, n, h, i in brute.contamination(docs, items))


def test_random_texts_with_shared_passages(spark):
    rng = random.Random(5)
    word = lambda: rng.choice("ab cd É x1 Zz the of to".split()) if rng.random() < 0.5 else str(rng.randrange(60))
    items = [(i, " ".join(word() for _ in range(rng.choice((10, 11, 14, 30))))) for i in range(12)]
    docs = []
    for d in range(60):
        words = [word() for _ in range(rng.randrange(0, 80))]
        if d % 2:
            passage = rng.choice(items)[1].split()
            a = rng.randrange(len(passage))
            at = rng.randrange(len(words) + 1)
            words[at:at] = passage[a:a + rng.choice((8, 9, 10, 11, 20))]
        docs.append((d, ", ".join(words).upper() if d % 3 else " ".join(words)))
    # Every word the same, so that all hashes tie.
    docs += [(100, "tie " * 25), (101, "tie " * 9)]
    items += [(50, "tie " * 12)]
    assert run(spark, docs, items) == want(docs, items)
    assert any(h for _, _, h, _ in run(spark, docs, items))


def test_short_items_nulls_and_repeated_rows(spark):
    items = [(1, "Alpha beta"), (2, "one two three four five six seven"), (3, None), (4, "?!"), (5, "solo"), (None, "null id item here"), (1, "Alpha beta")]
    docs = [(1, "x ALPHA, beta y solo"), (1, "x ALPHA, beta y solo"), (2, None), (3, ""), (None, "one two three four five six seven eight"), (4, "Éalpha beta")]
    got = run(spark, docs, items)
    named = [(i, t) for i, t in items if i is not None]
    assert got == want(docs, named)
    assert run(spark, docs, []) == want(docs, [])
    assert not run(spark, [], items)


def test_shuffled_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr("tillstar.llm.common.BROADCAST_ROWS", 0)
    monkeypatch.setattr(decontaminate, "small_side", lambda df, rows: df)
    items = [(i, " ".join(f"w{i}{j}" for j in range(15))) for i in range(3)]
    docs = [(d, f"pad {items[d % 3][1]} pad") for d in range(9)] + [(20, "clean text")]
    assert run(spark, docs, items) == want(docs, items)
