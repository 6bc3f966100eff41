"""Packing as an exact round trip; the line field by its own sums and by held-out accuracy."""

import itertools
import random
import struct
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillstar.llm import pack, quality

SCHEMA = "doc_id long, text string, start string, score int"
WORDS = "the The don't it's we'll naïve Ünïcödé 123 4½ --- ,. ... straße ß Σίσυφος ΟΔΟΣ 日本 🙂 é \xa0   \x1c x­x <|endoftext|> <|startoftext|> İstanbul ' \"q\" ﬁn ª²".split(" ")


def whole_tokenizer(name="word_bpe_49k.json"):
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(name))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_word_tokenizer_equals_the_whole_one(name):
    import public_tokenizers

    whole, ours = whole_tokenizer(name), pack.WordTokenizer(public_tokenizers.path(name))
    assert ours.by_word == (name == "word_bpe_49k.json")
    rng = random.Random(2)
    plain = [chr(c) for c in (*range(9, 14), *range(32, 127), *range(0xA1, 0x180), *range(0x2010, 0x2028), 0x20AC)]
    texts = ["", " ", *plain, *WORDS]
    texts += ["".join(rng.choice(plain) for _ in range(rng.randrange(60))) for _ in range(3000)]
    texts += [rng.choice(["", " "]).join(rng.choice(WORDS) for _ in range(rng.randrange(12))) for _ in range(1000)]
    for t in texts:
        assert ours.ids(t) == struct.pack(f"<{len(i := whole.encode(t, add_special_tokens=False).ids)}I", *i), repr(t)


def test_caches_and_batches_are_bounded_in_bytes():
    import public_tokenizers

    ours = pack.WordTokenizer(public_tokenizers.path("word_bpe_49k.json"))
    ours.words.room = ours.chunks.room = 10_000
    text = " ".join(f"word{i}" for i in range(500))
    whole = whole_tokenizer().encode(text, add_special_tokens=False).ids
    assert ours.ids(text) == struct.pack(f"<{len(whole)}I", *whole)
    assert 0 < len(ours.chunks) < 50 and ours.chunks.room >= 0 and ours.words.room >= 0
    packer = pack.Packer(0)
    packer.add(1, bytes(pack.BYTES_OUT + 4 * pack.SEQUENCE))
    assert packer.full() and len(packer.out) < pack.ROWS_OUT


def test_closest_multiset_against_all_subsets():
    rng = random.Random(4)
    for _ in range(300):
        counts = Counter(rng.choice((3, 5, 8, 13, 21)) for _ in range(rng.randrange(9)))
        capacity = rng.randrange(60)
        chosen = pack.closest_multiset(dict(counts), capacity)
        assert all(n <= counts[k] for k, n in chosen.items())
        items = list(counts.elements())
        best = max(s for r in range(len(items) + 1) for s in map(sum, itertools.combinations(items, r)) if s <= capacity)
        assert sum(k * n for k, n in chosen.items()) == best


def test_packing_round_trip(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choice(["alpha", "beta", "x", "thering"]) for _ in range(rng.choice((0, 1, 30, 700, 5000)))) for _ in range(120)]
    rows = [*enumerate(texts), (500, None), (501, ""), (None, "a null id"), (7, texts[7])]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA).coalesce(1)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in pack.packed(df, with_ids=True).collect():
        assert zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length > 0
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
    whole = whole_tokenizer()
    for i, t in rows:
        ids = whole.encode(t or "", add_special_tokens=False).ids + [1]
        got = sorted(pieces[i], key=lambda r: r.start)
        got = got[::2] if i == 7 else got
        assert b"".join(bytes(r.ids) for r in got) == struct.pack(f"<{len(ids)}I", *ids)
        assert [r.start for r in got] == list(np.cumsum([0, *[r.length for r in got]])[:-1]) and {r.doc_tokens for r in got} == {len(ids)}
    short = 0
    for s in sequences.values():
        at = 0
        for r in sorted(s, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        short += at < pack.SEQUENCE
        assert at <= pack.SEQUENCE
    assert short <= 1
    assert pack.packed(df.limit(0)).count() == 0


def test_packer_repeats_and_cuts():
    for size in (10, 64):
        rng = random.Random(size)
        packer = pack.Packer(0, size)
        lengths = [rng.randrange(1, 3 * size) for _ in range(400)]
        for d, n in enumerate(lengths):
            packer.add(d, bytes(4 * n))
            if packer.waiting > 50:
                packer.pack(10)
        packer.pack(0)
        used = Counter()
        for _, _, ids, *_, sequence, _ in packer.out:
            used[sequence] += len(ids) // 4
        assert sum(used.values()) == sum(lengths) and sum(n < size for n in used.values()) <= 1


def test_field_sums_against_all_labelings():
    rng = np.random.default_rng(0)
    field = quality.Field(rng.normal(size=quality.FEATURES), rng.normal(size=(2, 2)))
    per_line = np.array([3, 1, 4])
    x = rng.normal(size=(8, quality.FEATURES)) / 4
    p, expected, log_z = quality.marginals(field, x, per_line)
    want_p, want_moves, want_z, at = [], np.zeros((2, 2)), 0.0, 0
    for n in per_line:
        e = x[at:at + n] @ field.emit
        weights = {y: np.exp(sum(e[i] * v for i, v in enumerate(y)) + sum(field.move[a, b] for a, b in itertools.pairwise(y))) for y in itertools.product((0, 1), repeat=int(n))}
        z = sum(weights.values())
        want_z += np.log(z)
        want_p += [sum(w for y, w in weights.items() if y[i]) / z for i in range(n)]
        for y, w in weights.items():
            for a, b in itertools.pairwise(y):
                want_moves[a, b] += w / z
        at += n
    assert np.allclose(p, want_p) and np.allclose(expected, want_moves) and np.isclose(log_z, want_z)


def test_features_do_not_depend_on_the_batch():
    texts = ["one line", "", "AB!! CD!!\n\nsame\nsame\nä ö", "x" * 3_000_000 + "\n" + "| a | b" * 10]
    alone = np.vstack([quality.features([t])[0] for t in texts])
    x, weight, per_line = quality.features(texts)
    assert np.allclose(alone, x) and per_line.tolist() == [1, 1, 5, 2] and len(weight) == len(x) == 9
    many = ["a\n" * 3000] * 400
    assert np.allclose(quality.features(many)[0], np.vstack([quality.features(many[:1])[0]] * 400))


def test_very_many_lines(monkeypatch):
    """Block by block gives the same scores, in memory and time that follow the lines."""
    rng = np.random.default_rng(5)
    field = quality.Field(rng.normal(size=quality.FEATURES) / 3, rng.normal(size=(2, 2)), 0.7, -0.2)
    texts = ["\n".join(rng.choice(["Fine line here.", "", "AB!! CD!!", "| a | b |", "x 1 2 3"], n)) for n in (1, 2, 7, 50, 203)] + ["\n" * 120]
    whole = quality.score_texts(field, texts)
    monkeypatch.setattr(quality, "_BLOCK_LINES", 3)
    assert np.allclose(quality.score_texts(field, texts), whole)
    monkeypatch.undo()
    seconds = []
    for n in (60_000, 240_000):
        tracemalloc.start()
        start = time.process_time()
        quality.score_texts(field, ["\n" * n])
        seconds.append(time.process_time() - start)
        assert tracemalloc.get_traced_memory()[1] < 200 * n
        tracemalloc.stop()
    assert seconds[1] < 8 * seconds[0]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scores = quality.quality_scores(docs, labels)
    assert scores.count() == docs.count()
    judged = scores.join(labels, "doc_id").filter(quality.held_out(F.col("doc_id"))).select(((F.col("score") >= quality.PREDICT).cast("int") == F.col("quality")).alias("ok")).collect()
    assert len(judged) > 50 and np.mean([r.ok for r in judged]) > 0.95


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, None, "x", 1), (2, "", "x", 1), (None, "Fine text here.", "x", 1), (2, "", "x", 1)], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = quality.quality_scores(docs, none).collect()
    assert len(got) == 4 and len({r.score for r in got}) == 1 and got[0].score >= quality.PREDICT
    some = spark.createDataFrame([(1, 1), (2, None), (2, 0), (None, 1)], "doc_id long, quality int")
    assert all(0 <= r.score <= 1 for r in quality.quality_scores(docs, some).collect())
    assert quality.quality_scores(docs.limit(0), some).count() == 0
