"""Language identification by error-correcting output codes over character n-grams.

Every language has a codeword. One binary n-gram classifier per bit tells the languages with a 1 from those with a 0;
the loss of a text's margins against each codeword, every bit weighing as much as it is right for that language,
gives the nearest one. Texts between two codewords are flagged as ambiguous.
"""

from __future__ import annotations

import sys
import types
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import ship

ship(__name__)

UNDETERMINED = "und"
# Hashed n-grams of one to three letters, with the border of a word as a letter.
FEATURES = 1 << 14
SMOOTHING = 0.5
MAX_WEIGHT = 6.0
# A margin counts GAIN times, less for texts of few n-grams.
GAIN, FEW = 8.0, 10.0
AMBIGUOUS = 0.75
# Up to so many languages every way to divide them is a bit; beyond, a code of the best least distance is drawn.
EXHAUSTIVE = 6
SEED = 42
# Characters looked at together, and languages counted before a task sends its counts on.
_CHARS = 1 << 18
_LANGUAGES = 256
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D], dtype=np.uint32)


def codewords(n: int) -> np.ndarray:
    """One row of bits per language; no two rows are equal and no column is constant."""
    if n < 2:
        return np.zeros((n, 0), dtype=bool)
    if n <= EXHAUSTIVE:
        return np.array([[bool(i and mask >> (i - 1) & 1) for mask in range(1, 1 << (n - 1))] for i in range(n)])
    rng = np.random.default_rng(SEED)
    bits = 7 + 4 * int(np.ceil(np.log2(n)))
    best, distance = None, 0
    while best is None or distance < 2:
        for _ in range(50):
            code = rng.random((n, bits)) < 0.5
            product = np.where(code, 1, -1) @ np.where(code, 1, -1).T
            apart = (bits - (product - 2 * bits * np.eye(n, dtype=int)).max()) // 2
            if code.any(axis=0).all() and not code.all(axis=0).any() and apart > distance:
                best, distance = code, apart
        bits += 1
    return best


def _letters() -> np.ndarray:
    """Which code points are letters; made once in a worker process."""
    state = sys.modules.setdefault("_language_worker", types.ModuleType("_language_worker"))
    if not hasattr(state, "letters"):
        state.letters = np.fromiter(map(str.isalpha, map(chr, range(sys.maxunicode + 1))), dtype=bool)
    return state.letters


def grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of the n-grams of some texts, in order, and how many each text has."""
    lengths = np.array([len(t) + 1 for t in texts])
    points = np.frombuffer((" ".join(texts) + " ").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    letter = _letters()[points]
    owner = np.repeat(np.arange(len(texts)), lengths)
    # One border stands for all that is between two words.
    kept = letter | np.append(True, letter[:-1])
    code, owner, letter = np.where(letter, points, 0)[kept], owner[kept], letter[kept]
    before = np.append(np.uint32(0), code[:-1])
    second = np.append(np.uint32(0), before[:-1])
    with np.errstate(over="ignore"):
        one = code * _FACTORS[0]
        two = (one ^ (before + np.uint32(1))) * _FACTORS[1]
        three = (two ^ (second + np.uint32(2))) * _FACTORS[2]
    inside = letter & (before != 0)
    shift = np.uint32(32 - FEATURES.bit_length() + 1)
    found = np.stack([one >> shift, two >> shift, three >> shift], axis=1)
    wanted = np.stack([letter, letter, inside], axis=1)
    return found[wanted].astype(np.int64), np.bincount(owner, weights=wanted.sum(axis=1), minlength=len(texts)).astype(np.int64)


def _pieces(texts) -> list[tuple[list[int], list[str]]]:
    """(numbers, texts) of at most about ``_CHARS`` characters together, lower-cased; long texts are cut, in whole."""
    some, numbers, chars = [], [], 0
    for i, text in enumerate(texts):
        text = (text or "").lower()
        for at in range(0, max(1, len(text)), _CHARS):
            part = text[at:at + _CHARS]
            if chars + len(part) > _CHARS and some:
                yield numbers, some
                some, numbers, chars = [], [], 0
            some.append(part)
            numbers.append(i)
            chars += len(part)
    if some:
        yield numbers, some


@dataclass
class Code:
    """Languages, their codewords, the classifiers' weights (features x bits), and how often a bit is right by language."""

    languages: list[str]
    words: np.ndarray
    weights: np.ndarray
    right: np.ndarray


def margins(weights: np.ndarray, texts) -> tuple[np.ndarray, np.ndarray]:
    """Mean weight per bit of every text's n-grams, and their number."""
    texts = list(texts)
    total, n = np.zeros((len(texts), weights.shape[1])), np.zeros(len(texts))
    for numbers, some in _pieces(texts):
        found, counts = grams(some)
        full = np.flatnonzero(counts)
        if len(full):
            sums = np.add.reduceat(weights[found], (np.cumsum(counts) - counts)[full], axis=0, dtype=np.float64)
            np.add.at(total, np.array(numbers)[full], sums)
        np.add.at(n, numbers, counts)
    return total / np.maximum(n, 1)[:, None], n


def decode(code: Code, margin: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Share of every language for every text, from the weighted losses against the codewords."""
    z = GAIN * margin * (n / (n + FEW))[:, None]
    signs = np.where(code.words, 1.0, -1.0)
    loss = np.logaddexp(0, -z[:, None, :] * signs[None]) * code.right[None]
    value = -loss.sum(axis=2)
    value = np.exp(value - value.max(axis=1, keepdims=True))
    return value / value.sum(axis=1, keepdims=True)


def _gram_counts(batches):
    held: dict[str, np.ndarray] = {}

    def batch():
        rows = [(lang, np.flatnonzero(c)) for lang, c in held.items()]
        out = pa.RecordBatch.from_arrays([
            pa.array([lang for lang, at in rows for _ in at], pa.string()),
            pa.array(np.concatenate([at for _, at in rows]) if rows else [], pa.int32()),
            pa.array(np.concatenate([held[lang][at] for lang, at in rows]) if rows else [], pa.int64())], names=["lang", "gram", "n"])
        held.clear()
        return out

    for rows in batches:
        langs = rows.column(0).to_pylist()
        for numbers, some in _pieces(t.as_py() for t in rows.column(1)):
            found, counts = grams(some)
            at = np.concatenate(([0], np.cumsum(counts)))
            for lang in {langs[i] for i in numbers}:
                mine = np.concatenate([found[at[k]:at[k + 1]] for k, i in enumerate(numbers) if langs[i] == lang])
                held[lang] = held.get(lang, 0) + np.bincount(mine, minlength=FEATURES)
            if len(held) > _LANGUAGES:
                yield batch()
    yield batch()


def _bit_counts(code: Code):
    place = {lang: i for i, lang in enumerate(code.languages)}

    def run(batches):
        right, seen = np.zeros(code.words.shape, dtype=np.int64), np.zeros(len(place), dtype=np.int64)
        for rows in batches:
            # A language none of whose texts has a letter was not learned.
            mine = np.array([place.get(x, -1) for x in rows.column(0).to_pylist()], dtype=np.int64)
            margin, n = margins(code.weights, (t.as_py() for t in rows.column(1)))
            some = (n > 0) & (mine >= 0)
            np.add.at(right, mine[some], (margin[some] > 0) == code.words[mine[some]])
            np.add.at(seen, mine[some], 1)
        languages, bits = code.words.shape
        yield pa.RecordBatch.from_arrays([
            pa.array(np.repeat(np.arange(languages), bits), pa.int32()), pa.array(np.tile(np.arange(bits), languages), pa.int32()),
            pa.array(right.ravel(), pa.int64()), pa.array(np.repeat(seen, bits), pa.int64())], names=["language", "bit", "right", "seen"])

    return run


def held_out(doc_id: Column) -> Column:
    """Whether a document's language may not be learned from."""
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(5)) == 0, F.lit(False))


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> Code:
    """The code of all languages that ``docs`` are marked with, from all their whole texts.

    Tasks count n-grams by language; the driver receives a row per language and n-gram that occurs (at most
    ``FEATURES`` a language), then one per language and bit.
    """
    known = docs.select(F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")).filter("lang is not null and text is not null")
    counted = known.mapInArrow(_gram_counts, "lang string, gram int, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    names = counted.column("lang").to_pylist()
    languages = sorted(set(names))
    words = codewords(len(languages))
    place = {x: i for i, x in enumerate(languages)}
    counts = np.zeros((len(languages), FEATURES))
    counts[[place[x] for x in names], counted.column("gram").to_numpy()] = counted.column("n").to_numpy()
    chance = (counts + SMOOTHING) / (counts.sum(axis=1, keepdims=True) + SMOOTHING * FEATURES)
    weights = np.zeros((FEATURES, words.shape[1]), dtype=np.float32)
    for bit in range(words.shape[1]):
        ones = words[:, bit]
        weights[:, bit] = np.clip(np.log(chance[ones].mean(axis=0)) - np.log(chance[~ones].mean(axis=0)), -MAX_WEIGHT, MAX_WEIGHT)
    code = Code(languages, words, weights, np.ones(words.shape))
    if words.size:
        seen = known.mapInArrow(_bit_counts(code), "language int, bit int, right bigint, seen bigint") \
            .groupBy("language", "bit").agg(F.sum("right").alias("right"), F.sum("seen").alias("seen")).collect()
        for r in seen:
            # One more of each, so that no bit is left out.
            code.right[r["language"], r["bit"]] = (r["right"] + 1) / (r["seen"] + 2)
        code.right *= words.shape[1] / code.right.sum(axis=1, keepdims=True)
    return code


_RESULT = pa.struct([("lang", pa.string()), ("score", pa.float64()), ("ambiguous", pa.bool_())])


def identify(docs: DataFrame, code: Code, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, lang_pred, score`` (0 to 1) and ``ambiguous``.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if no language was learned; with
    one language all others have it, with score 1. The score is the share of the nearest codeword; below
    ``AMBIGUOUS`` the text is flagged. Prediction depends on the text alone; whole texts are read, in pieces, so
    memory is bounded by the longest text. Repeated rows are scored each, an empty table gives an empty result, other
    columns are not looked at. No shuffle.
    """

    def found(texts: pa.Array) -> pa.Array:
        margin, n = margins(code.weights, (t.as_py() for t in texts))
        out = [{"lang": UNDETERMINED, "score": 0.0, "ambiguous": True}] * len(texts)
        some = np.flatnonzero(n) if code.languages else []
        if len(some):
            share = decode(code, margin[some], n[some])
            for i, best, row in zip(some, share.argmax(axis=1), share, strict=True):
                score = float(min(1.0, row[best]))
                out[i] = {"lang": code.languages[best], "score": score, "ambiguous": score < AMBIGUOUS}
        return pa.array(out, _RESULT)

    result = F.arrow_udf(found, "struct<lang:string,score:double,ambiguous:boolean>")(F.col(text))
    rows = docs.select(F.col(doc_id).alias("doc_id"), result.alias("r"))
    return rows.select("doc_id", F.col("r.lang").alias("lang_pred"), F.col("r.score").alias("score"), F.col("r.ambiguous").alias("ambiguous"))
