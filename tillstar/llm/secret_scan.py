"""Secrets: fixed forms, and strings that a Markov model of random strings explains better than one of identifiers."""

from __future__ import annotations

import base64
import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import ship

ship(__name__)

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "random")

_ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
# What the Markov models judge: long strings without spaces.
MIN_RANDOM = 20
_STRING = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % MIN_RANDOM)
_IDENTIFIER = re.compile(r"[A-Za-z0-9+/_=-]{4,}")
PREFILTER = r"[A-Za-z0-9+/_=-]{20}|(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]"

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
# About so many documents, chosen by a hash of their id, give the labelled strings.
TRAIN_DOCUMENTS = 4000
# A string counts as random beyond this log-likelihood ratio, per character and in all.
MIN_RATIO, MIN_TOTAL = 2.0, 40.0
# Weight of single characters' frequencies against those of pairs.
BACK_OFF = 50.0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base kinds of one text, by kind."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


def labelled_strings(text: str) -> tuple[list[str], list[str]]:
    """Random strings and ordinary identifiers of one document.

    Random are the base matches' values, and two digests of the text, written as base 64 and in hex.
    Ordinary are all other strings shorter than those that are judged, since a longer one may be a secret nobody labelled.
    """
    spans = base_spans(text)
    digest = hashlib.sha256(text.encode()).digest()
    random = [text[s:e] if kind != "assign" else _ASSIGN.match(text, s).group(2) for kind, s, e in spans]
    random += [base64.b64encode(digest).decode(), digest.hex()]
    covered = bytearray(len(text)) if spans else None
    for _, s, e in spans:
        covered[s:e] = b"\1" * (e - s)
    ordinary = [m.group() for m in _IDENTIFIER.finditer(text) if m.end() - m.start() < MIN_RANDOM and (covered is None or not any(covered[m.start():m.end()]))]
    return random, ordinary


def _bigram_counts(batches):
    counts: dict[tuple[bool, str], int] = {}
    for batch in batches:
        for text in batch.column(0).to_pylist():
            for label, strings in zip((True, False), labelled_strings(text), strict=True):
                for s in strings:
                    for a, b in zip("^" + s, s, strict=False):
                        counts[label, a + b] = counts.get((label, a + b), 0) + 1
    keys = list(counts)
    yield pa.RecordBatch.from_pydict({"random": [k[0] for k in keys], "pair": [k[1] for k in keys], "n": [counts[k] for k in keys]},
                                     schema=pa.schema([("random", pa.bool_()), ("pair", pa.string()), ("n", pa.int64())]))


def train(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", documents: int = TRAIN_DOCUMENTS) -> dict[str, float]:
    """Log-likelihood ratio of every pair of characters, from about ``documents`` sampled texts.

    Tasks count pairs; the driver receives at most a row per pair of the alphabet and label.
    """
    known = docs.filter(F.col(text).isNotNull())
    share = min(1.0, documents / max(1, known.count()))
    chosen = known.filter(F.pmod(F.xxhash64(doc_id), F.lit(1 << 20)) < int(share * (1 << 20)) + 1).select(text)
    counts = chosen.mapInArrow(_bigram_counts, "random boolean, pair string, n bigint")
    table = {(r["random"], r["pair"]): r["n"] for r in counts.groupBy("random", "pair").agg(F.sum("n").alias("n")).collect()
             if r["pair"][-1] in ALPHABET}
    firsts: dict[tuple[bool, str], int] = {}
    seconds: dict[tuple[bool, str], int] = {}
    total = {True: 0, False: 0}
    for (label, pair), n in table.items():
        firsts[label, pair[0]] = firsts.get((label, pair[0]), 0) + n
        seconds[label, pair[1]] = seconds.get((label, pair[1]), 0) + n
        total[label] += n

    def log_p(label: bool, a: str, b: str) -> float:
        # After a rare character the model falls back on how frequent b is at all.
        single = (seconds.get((label, b), 0) + 0.5) / (total[label] + 0.5 * len(ALPHABET))
        return math.log((table.get((label, a + b), 0) + BACK_OFF * single) / (firsts.get((label, a), 0) + BACK_OFF))

    return {a + b: log_p(True, a, b) - log_p(False, a, b) for a in "^" + ALPHABET for b in ALPHABET}


def log_ratio(ratios: dict[str, float], string: str) -> float:
    """How much better the model of random strings explains ``string``."""
    return sum(ratios.get(a + b, 0.0) for a, b in zip("^" + string, string, strict=False))


def _maximal(scores: list[float]) -> list[tuple[int, int]]:
    """All maximal stretches of positive sum (start, end), disjoint and in order, in linear time (Ruzzo and Tompa)."""
    found: list[tuple[float, float, int, int, int]] = []  # sums before and after, start, end, last one with a lower sum before
    after = 0.0
    for i, x in enumerate(scores):
        before, after = after, after + x
        if x <= 0:
            continue
        low, start, j = before, i, len(found) - 1
        while True:
            while j >= 0 and found[j][0] >= low:
                j = found[j][4]
            if j < 0 or found[j][1] >= after:
                break
            low, _, start, _, up = found[j]
            del found[j:]
            j = up
        found.append((low, after, start, i + 1, j))
    return [(f[2], f[3]) for f in found]


_BORDER = frozenset("+/_=-")


def random_stretches(ratios: dict[str, float], string: str) -> list[tuple[int, int, float]]:
    """Disjoint stretches (start, end, log ratio) of one string that pass the limits: the whole, or else its best ones.

    A best stretch is drawn out to the next borders (``+/_=-``) if it still passes, so that no end of a secret is left.
    """
    n = len(string)
    by_char = [ratios.get(a + b, 0.0) for a, b in zip("^" + string, string, strict=False)]
    total = sum(by_char)
    if total >= MIN_TOTAL and total >= MIN_RATIO * n:
        return [(0, n, total)]
    out: list[tuple[int, int, float]] = []
    done = 0
    best = _maximal([x - MIN_RATIO for x in by_char])
    for k, (start, end) in enumerate(best):
        if start < done:
            continue
        low, high = start, end
        limit = best[k + 1][0] if k + 1 < len(best) and best[k + 1][1] - best[k + 1][0] >= MIN_RANDOM else n
        while low > done and string[low - 1] not in _BORDER:
            low -= 1
        while high < limit and string[high] not in _BORDER:
            high += 1
        for s, e in ((low, high), (start, high), (low, end), (start, end)):
            score = sum(by_char[s:e])
            if e - s >= MIN_RANDOM and score >= MIN_TOTAL and score >= MIN_RATIO * (e - s):
                out.append((s, e, score))
                done = e
                break
    return out


def _outside(start: int, end: int, taken: list[tuple[int, int]], at: int) -> tuple[list[tuple[int, int]], int]:
    """The parts of a stretch outside ``taken`` (sorted), and the first of these that can meet a later stretch."""
    parts = []
    while at < len(taken) and taken[at][1] <= start:
        at += 1
    here = at
    while here < len(taken) and taken[here][0] < end:
        if taken[here][0] > start:
            parts.append((start, taken[here][0]))
        start = max(start, taken[here][1])
        here += 1
    return parts + ([(start, end)] if start < end else []), at


def scanned(text: str, ratios: dict[str, float]) -> list[tuple[str, int, int, float | None, bool]]:
    """All spans by start and kind; random strings only where no base span is. Both lists are walked once."""
    base = base_spans(text)
    out = [(kind, s, e, None, True) for kind, s, e in base]
    taken: list[tuple[int, int]] = []
    for s, e in sorted((s, e) for _, s, e in base):
        if taken and s <= taken[-1][1]:
            taken[-1] = (taken[-1][0], max(e, taken[-1][1]))
        else:
            taken.append((s, e))
    at = 0
    for m in _STRING.finditer(text):
        parts, at = _outside(m.start(), m.end(), taken, at)
        for low, high in parts:
            if high - low >= MIN_RANDOM:
                out += [("random", low + s, low + e, score, False) for s, e, score in random_stretches(ratios, text[low:high])]
    out.sort(key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
    return out


SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("base", pa.bool_())])


def secrets(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", train_documents: int = TRAIN_DOCUMENTS) -> DataFrame:
    """One row per document: ``doc_id, spans`` (kind, start, end exclusive in code points, score, base).

    Base forms are always reported; a string of at least ``MIN_RANDOM`` characters outside them, or a stretch of
    it that long, is reported as ``random`` when the Markov models say so. A null or empty text has no spans, repeated rows are reported
    each, an empty table gives an empty result. No shuffle but the training counts; texts that can hold
    no span stay in the JVM. Other columns are not looked at.
    """
    ratios = train(docs, doc_id, text, train_documents)

    @F.arrow_udf("array<struct<kind:string,start:bigint,end:bigint,score:double,base:boolean>>")
    def spans(texts: pa.Array) -> pa.Array:
        fields = [f.name for f in SPAN]
        return pa.array([None if t is None else [dict(zip(fields, s, strict=True)) for s in scanned(t, ratios)] for t in texts.to_pylist()], pa.list_(SPAN))

    return docs.select(F.col(doc_id).alias("doc_id"), spans(F.when(F.col(text).rlike(PREFILTER), F.col(text))).alias("spans"))
