"""Languages by held-out accuracy, by a plain count of n-grams, and on odd rows."""

import zlib

import numpy as np
import pytest

from tillstar.llm import language
from tillstar.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, lang string, score string, ambiguous int"


@pytest.mark.parametrize("n", [2, 3, 4, 6, 7, 20, 100])
def test_codewords_are_apart(n):
    code = language.codewords(n)
    assert code.shape[0] == n and code.any(axis=0).all() and not code.all(axis=0).any()
    apart = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
    assert apart >= (1 if n == 2 else 2 ** (n - 2) if n <= 6 else 3)


def plain_grams(text):
    """N-grams as strings, by the letter they end at; words are cut at what is no letter, borders are spaces."""
    out, line = [], "".join(c if c.isalpha() else " " for c in text.lower())
    for word in line.split():
        word = " " + word
        for i in range(1, len(word)):
            out += [word[i], word[i - 1:i + 1]] + ([word[i - 2:i + 1]] if i >= 2 else [])
    return out


def test_grams_against_plain_ones():
    texts = ["", "Hello, wörld!", "a", "12 34", "x" * 700, "日本語 テキスト 🙂 ok", "don't--stop  now\n", "ÀB"]
    found, counts = language.grams([t.lower() for t in texts])
    want = [plain_grams(t) for t in texts]
    assert counts.tolist() == [len(w) for w in want]
    # Every n-gram has one number, wherever it is, and few share theirs.
    numbers = dict(zip(sum(want, []), found.tolist(), strict=True))
    assert [numbers[g] for w in want for g in w] == found.tolist() and len(set(numbers.values())) >= len(numbers) - 2


def test_margins_do_not_depend_on_the_batch():
    rng = np.random.default_rng(1)
    weights = rng.normal(size=(language.FEATURES, 7)).astype(np.float32)
    texts = ["one two", "", None, "word " * 120_000, "drei vier", "9"]
    together, n = language.margins(weights, texts)
    for i, t in enumerate(texts):
        alone, m = language.margins(weights, [t])
        assert np.allclose(together[i], alone[0], atol=1e-5) and n[i] == m[0]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = {r.doc_id: r for r in QUERIES["op12_language_codes"](spark, "/root/testdata/sf0.01").collect()}
    langs = {r.doc_id: r.lang for r in docs.collect()}
    assert set(rows) == set(langs)
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r.score <= 1 for i, r in rows.items())
    judged = [(r.lang_pred == langs[i], r.ambiguous) for i, r in rows.items() if r.held_out]
    assert len(judged) > 150 and np.mean([ok for ok, _ in judged]) > 0.97
    assert np.mean([ok for ok, unsure in judged if not unsure]) >= np.mean([ok for ok, _ in judged])


def test_learns_from_nothing_else(spark):
    """Marks of held-out documents and other columns change nothing."""
    rng = np.random.default_rng(3)
    words = {"aa": ["kala", "talo", "vene"], "bb": ["stern", "haus", "weg"], "cc": ["perro", "casa", "gato"]}
    rows = [(i, " ".join(rng.choice(words[x], 30)), x, "s", 1) for i, x in enumerate(list(words) * 40)]
    out = lambda r: zlib.crc32(str(r[0]).encode()) % 5 == 0
    wrong = [(r[0], r[1], "zz", "t", 2) if out(r) else r for r in rows]

    def answer(some):
        docs = spark.createDataFrame(some, SCHEMA)
        return {r.doc_id: (r.lang_pred, r.score) for r in language.identify(docs, language.train(docs.filter(~language.held_out(docs.doc_id)))).collect()}

    right = answer(rows)
    assert right == answer(wrong) and all(right[r[0]][0] == r[2] for r in rows)


def test_odd_rows(spark):
    rows = [(1, "kala talo", "aa", "x", 1), (2, "stern haus", "bb", "x", 1), (3, None, "bb", "x", 1), (4, "", None, "x", 1), (None, "123 !?", "aa", "x", 1),
            (None, "kala", None, "x", 1), (2, "stern haus", "bb", "x", 1), (6, "талант", None, "x", 1), (7, "", "cc", "x", 1)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = language.identify(docs, language.train(docs)).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: r.lang_pred for r in got if r.doc_id is not None} | {} == {1: "aa", 2: "bb", 3: "und", 4: "und", 6: got[7].lang_pred, 7: "und"}
    assert got[7].lang_pred in ("aa", "bb") and got[4].lang_pred == "und" and got[5].lang_pred == "aa"
    one = language.train(docs.filter("lang = 'aa'"))
    assert {(r.lang_pred, r.score) for r in language.identify(docs, one).collect()} == {("aa", 1.0), ("und", 0.0)}
    none = language.train(docs.limit(0))
    assert {(r.lang_pred, r.score) for r in language.identify(docs, none).collect()} == {("und", 0.0)}
    assert language.identify(docs.limit(0), one).count() == 0
