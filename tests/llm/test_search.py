"""The k best documents of every item against scores of all pairs, at any size of signatures and blocks."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from brute import LOWER, WORD

from tillstar.llm import search

DOCS = "doc_id long, text string, item long, row string, score int"
ITEMS = "item_id long, text string, rank int, doc_id string"


def terms(text):
    return WORD.findall((text or "").translate(LOWER))


def ranked(docs, items, k):
    """Sorted (item id, [(score, id) ...]) by scoring every pair; equal scores by id, a null one last."""
    bags = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n_docs, n_terms = len(bags), sum(b.total() for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    out = []
    for item, text in items:
        scored = []
        for i, bag in bags:
            n = bag.total()
            m = 75 + 25 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (1_000_000_000 * bag[w] // (1000 * bag[w] + 12 * m))
                    for w in terms(text) if bag[w])
            if s > 0:
                scored.append((-s, i is None, i or 0))
        if scored:
            out.append((item, [(-s, None if none else i) for s, none, i in sorted(scored)[:k]]))
    return sorted(out, key=repr)


def found(spark, docs, items, k):
    d = spark.createDataFrame([(*r, 1, "x", 2) for r in docs], DOCS).repartition(3)
    b = spark.createDataFrame([(*r, 1, "x") for r in items], ITEMS)
    by_item = defaultdict(list)
    rows = search.search(d, b, k).collect()
    for r in rows:
        by_item[r.item_id].append((r.rank, r.score, r.doc_id))
    for got in by_item.values():
        assert sorted(r for r, *_ in got) == list(range(1, len(got) + 1))
    return sorted(((i, [(s, d) for _, s, d in sorted(got, key=lambda r: r[0])]) for i, got in by_item.items()), key=repr)


def corpus():
    rng = random.Random(8)
    common = ["the", "of", "and"]
    docs = []
    for i in range(160):
        words = [rng.choice(common) if rng.random() < 0.4 else f"w{int(rng.paretovariate(0.6)) % 3000}" for _ in range(rng.choice((1, 8, 60, 300)))]
        docs.append((i, " ".join(words)))
    docs += [(1000 + i, "same passage The OF w1 w2 w3") for i in range(40)] + [(7, docs[7][1]), (None, "w1 w1 w1 w2"), (None, "w1 w1 w1 w2"), (300, None), (301, ""), (302, " .,")]
    docs += [(400, "w2 " * 40_000 + "Übér w1"), (401, "once")]
    items = [(i, " ".join(rng.choice([*common, *(f"w{int(rng.paretovariate(0.6))}" for _ in range(4))]) for _ in range(rng.randrange(1, 40)))) for i in range(25)]
    items += [(50, "same passage w1 w2"), (51, None), (52, ""), (53, "nowhere-to-be-found"), (54, "the"), (55, "übér ÜBÉR Übér"), (56, "w2 w2 w1 once")]
    return docs, items


@pytest.mark.parametrize(("documents", "widest", "at_once", "k"), [(4096, 20, 2000, 20), (16, 20, 9, 3), (4096, 8, 2000, 7)])
def test_against_all_pairs(spark, monkeypatch, documents, widest, at_once, k):
    """Also with blocks of few documents, with items in turns, and with signatures so narrow that every bit is set."""
    monkeypatch.setattr(search, "BLOCK_DOCUMENTS", documents)
    monkeypatch.setattr(search, "WIDEST", widest)
    monkeypatch.setattr(search, "ITEMS_AT_ONCE", at_once)
    docs, items = corpus()
    assert found(spark, docs, items, k) == ranked(docs, items, k)


def test_rows_of_one_id_are_items_of_their_own(spark):
    docs = [(1, "a b"), (2, "b c"), (3, "c d"), (4, "e")]
    assert search.search(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(1, "a"), (1, "d"), (None, "e")], "item_id long, text string")).count() == 3


def test_bounds_hold_and_leave_documents_out():
    """No bound is below its score, and a block of documents without a term is excluded."""
    rng = np.random.default_rng(2)
    hashes = rng.integers(-(1 << 62), 1 << 62, 400)
    block = search._Block(12)
    bags = []
    for row in range(200):
        some, tf = rng.choice(400, 20, replace=False), rng.integers(1, 40, 20)
        bags.append(dict(zip(some.tolist(), tf.tolist(), strict=True)))
        levels = [hashes[some[tf >= 1 << k]] for k in range(search.LEVELS)]
        block.add(row, 90, np.concatenate([search._bits(h, k, 12).ravel() for k, h in enumerate(levels)]))
    asked = [(n, rng.choice(400, 5, replace=False), rng.integers(1, 9000, 5).astype(float)) for n in range(30)]
    tight = []
    for (_, places, w), (_, bound) in zip(asked, search.upper_bounds(block.record(), hashes, asked), strict=True):
        for row, bag in enumerate(bags):
            score = sum(int(x) * (search.SCALE * bag[p] // (1000 * bag[p] + search.DAMP * 90)) for p, x in zip(places.tolist(), w, strict=True) if p in bag)
            assert bound[row] >= score
            tight.append((bound[row], score))
    assert np.mean([b == 0 for b, s in tight if s == 0]) > 0.95 and np.mean([b <= 1.5 * s for b, s in tight if s]) > 0.9


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert search.search(docs.limit(0), items).count() == search.search(docs, items.limit(0)).count() == 0
    assert search.search(docs.filter("doc_id = 2"), items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
