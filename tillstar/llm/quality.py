"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad; its features are its own shape and that of its neighbours. Trained on labelled
documents (each line carries its document's label), the field gives every line a probability by forward and
backward sums; their mean, weighted by line length, and a monotone calibration make the document's score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import ship

ship(__name__)

# At most so many labelled documents are fitted, those with the smallest hash of their id; longer ones than
# TRAIN_CHARS are left out of the fit (not of the scoring).
TRAIN_DOCUMENTS = 4000
TRAIN_CHARS = 20_000
ROUNDS = 200
PREDICT = 0.7

# Classes of bytes counted in a line.
_CLASSES = (
    bytes(range(65, 91)), bytes(range(97, 123)), bytes(range(48, 58)), b" \t\r\x0b\x0c", b"*#$%&@^~=<>{}[]\\/_+`", b"|", b"!?", b".,;:",
    bytes(range(128, 256)))
_CLASS_OF = np.full(256, len(_CLASSES), dtype=np.int64)
for _i, _c in enumerate(_CLASSES):
    _CLASS_OF[list(_c)] = _i
OWN = len(_CLASSES) + 10
# The feature of a line that was there before in its text.
_AGAIN = len(_CLASSES) + 1
FEATURES = 3 * OWN + 1
# Bytes whose classes are counted at a time.
_BLOCK = 1 << 20


def _class_counts(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """How many bytes of each class every line has; read block by block."""
    n_classes = len(_CLASSES) + 1
    ends = starts + lengths
    counts = np.zeros((len(starts), n_classes))
    flat = counts.reshape(-1)
    whole = np.frombuffer(data, dtype=np.uint8)
    for low in range(0, len(data), _BLOCK):
        block = whole[low:low + _BLOCK]
        position = np.searchsorted(starts, np.arange(low, low + len(block), dtype=np.int64), side="right") - 1 if len(starts) > len(block) else None
        if position is None:
            first = max(0, int(np.searchsorted(starts, low, side="right")) - 1)
            last = int(np.searchsorted(starts, low + len(block), side="left"))
            bounds = np.clip(starts[first:last] - low, 0, len(block))
            position = first + np.repeat(np.arange(last - first), np.diff(np.append(bounds, len(block))))
        flat += np.bincount(position * n_classes + _CLASS_OF[block], minlength=len(flat))
    # The line feed that ends a line belongs to no class.
    counts[:, -1] -= (ends < len(data))
    return counts


def features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all lines of some texts: features, weights (length), and the number of lines of each text."""
    n_lines, words_of, again, distinct = [], [], [], []
    for text in texts:
        lines = text.split("\n")
        seen: set[str] = set()
        n_lines.append(len(lines))
        for line in lines:
            words = line.split()
            words_of.append(len(words))
            distinct.append(len(set(words)))
            again.append(line in seen)
            seen.add(line)
    data = "\n".join(texts).encode("utf-8", "replace")
    breaks = np.flatnonzero(np.frombuffer(data, dtype=np.uint8) == 10)
    starts = np.concatenate(([0], breaks + 1))
    lengths = np.diff(np.append(starts, len(data) + 1)) - 1
    counts = _class_counts(data, starts, lengths)
    size = np.maximum(lengths, 1)[:, None]
    words, unique = np.array(words_of, dtype=float), np.array(distinct, dtype=float)
    per_line = np.array(n_lines)
    share = counts[:, :len(_CLASSES)] / size
    letters = np.maximum(counts[:, 0] + counts[:, 1], 1)
    own = np.column_stack([
        np.minimum(share * 4, 2.0), counts[:, 0] / letters > 0.5, np.array(again, dtype=float), lengths == 0,
        np.log1p(lengths) / 6, np.minimum(lengths / np.maximum(words, 1) / 8, 3), 1 - unique / np.maximum(words, 1),
        np.minimum(words / 50, 2), share[:, 4] > 0.1, share[:, 5] > 0.02, (words >= 10) & (2 * unique < words)])
    first = np.zeros(len(own), dtype=bool)
    first[np.cumsum(per_line) - per_line] = True
    last = np.zeros(len(own), dtype=bool)
    last[np.cumsum(per_line) - 1] = True
    before, after = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[first], after[last] = 0, 0
    return np.column_stack([np.ones(len(own)), own, before, after]), lengths + 1.0, per_line


@dataclass
class Field:
    """Weights of a two-label chain: label 1 (good) over 0 by features, the four transitions, the calibration."""

    emit: np.ndarray
    move: np.ndarray
    slope: float = 1.0
    shift: float = 0.0


def _chains(per_line: np.ndarray):
    """Documents from the longest to the shortest, the place of each first line, and how many have a line t."""
    order = np.argsort(-per_line, kind="stable")
    starts = (np.cumsum(per_line) - per_line)[order]
    sizes = per_line[order]
    active = np.searchsorted(-sizes, -np.arange(sizes[0] if len(sizes) else 0), side="left")
    return starts, sizes, active


def marginals(field: Field, x: np.ndarray, per_line: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Probability of good for every line, expected transitions, and the log normalizers' sum.

    The chains of a batch advance together, line by line, as long as any has lines left.
    """
    logits = x @ field.emit
    emit = np.column_stack([np.zeros(len(logits)), logits])
    starts, sizes, active = _chains(per_line)
    alpha, beta = np.zeros_like(emit), np.zeros_like(emit)
    for t, n in enumerate(active):
        at = starts[:n] + t
        alpha[at] = emit[at] if t == 0 else emit[at] + np.logaddexp.reduce(alpha[at - 1][:, :, None] + field.move[None], axis=1)
    expected = np.zeros((2, 2))
    ends = starts + sizes - 1
    log_z = np.logaddexp(alpha[ends, 0], alpha[ends, 1])
    for t in range(len(active) - 2, -1, -1):
        n = active[t + 1]
        at = starts[:n] + t
        ahead = field.move[None] + (emit[at + 1] + beta[at + 1])[:, None, :]
        beta[at] = np.logaddexp(ahead[:, :, 0], ahead[:, :, 1])
        expected += np.exp(alpha[at][:, :, None] + ahead - log_z[:n, None, None]).sum(axis=0)
    gap = (alpha[:, 1] + beta[:, 1]) - (alpha[:, 0] + beta[:, 0])
    return 1 / (1 + np.exp(-np.clip(gap, -60, 60))), expected, float(log_z.sum())


def _document_means(p: np.ndarray, weight: np.ndarray, per_line: np.ndarray) -> np.ndarray:
    at = np.cumsum(per_line) - per_line
    return np.add.reduceat(p * weight, at) / np.add.reduceat(weight, at)


def fit(texts: list[str], labels: list[int], rounds: int = ROUNDS, penalty: float = 1e-3) -> Field:
    """The field that maximizes the penalized likelihood of the labels, both labels weighing the same."""
    field = Field(np.zeros(FEATURES), np.zeros((2, 2)))
    if not texts or len(set(labels)) < 2:
        field.shift = -4.0 if labels and not labels[0] else 4.0
        return field
    x, weight, per_line = features(texts)
    y = np.repeat(np.array(labels, dtype=float), per_line)
    # Documents weigh the same however many lines they have: gradients are means over the lines of each label.
    share = np.where(y > 0, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, (1 - y).sum()))
    same = np.zeros((2, 2))
    for label in (0, 1):
        same[label, label] = (per_line[np.array(labels) == label] - 1).sum()
    moves = max(1.0, same.sum())
    m, v = np.zeros(FEATURES + 4), np.zeros(FEATURES + 4)
    for step in range(1, rounds + 1):
        p, expected, _ = marginals(field, x, per_line)
        gradient = np.concatenate([x.T @ ((y - p) * share), ((same - expected) / moves).ravel()])
        gradient -= penalty * np.concatenate([field.emit, field.move.ravel()])
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        change = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        field.emit = field.emit + change[:FEATURES]
        field.move = field.move + change[FEATURES:].reshape(2, 2)
    p, _, _ = marginals(field, x, per_line)
    z = _log_odds(_document_means(p, weight, per_line))
    field.slope, field.shift = _calibrate(z, np.array(labels, dtype=float))
    return field


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _calibrate(z: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic regression of the label on the log odds of the mean, by Newton steps; the slope stays positive."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        w = p * (1 - p) + 1e-9
        g = np.array([((y - p) * z).sum() - 1e-2 * a, (y - p).sum()])
        h = np.array([[(w * z * z).sum() + 1e-2, (w * z).sum()], [(w * z).sum(), w.sum()]])
        da, db = np.linalg.solve(h, g)
        a, b = max(1e-3, a + float(np.clip(da, -1, 1))), b + float(np.clip(db, -1, 1))
        if abs(da) + abs(db) < 1e-8:
            break
    return a, b


def _log_sum(a: float, b: float) -> float:
    return (a if a > b else b) + math.log1p(math.exp(-abs(a - b)))


def _long_mean(field: Field, text: str) -> float:
    """The mean of a text of very many lines: features block by block, then one chain of log ratios of the two labels."""
    lines, seen = text.split("\n"), set()
    own_weights = np.stack([field.emit[1 + k * OWN:1 + (k + 1) * OWN] for k in range(3)], axis=1)
    parts, weights = [], []
    step = min(_BLOCK_LINES, _BLOCK_STEP)
    for at in range(0, len(lines), step):
        block = lines[at:at + step]
        x, weight, _ = features(["\n".join(block)])
        own = x[:, 1:1 + OWN]
        for i, line in enumerate(block):
            own[i, _AGAIN] = line in seen
            seen.add(line)
        parts.append(own @ own_weights)
        weights.append(weight)
    part, weight = np.concatenate(parts), np.concatenate(weights)
    logits = field.emit[0] + part[:, 0]
    logits[1:] += part[:-1, 1]
    logits[:-1] += part[1:, 2]
    (m00, m01), (m10, m11) = field.move.tolist()
    gap, ratio = logits.copy(), 0.0
    for t, logit in enumerate(logits.tolist()):
        ratio = logit + (_log_sum(m01, ratio + m11) - _log_sum(m00, ratio + m10) if t else 0.0)
        gap[t] = ratio
    ahead = 0.0
    for t in range(len(logits) - 2, -1, -1):
        u = float(logits[t + 1]) + ahead
        ahead = _log_sum(m10, m11 + u) - _log_sum(m00, m01 + u)
        gap[t] += ahead
    p = 1 / (1 + np.exp(-np.clip(gap, -60, 60)))
    return float((p * weight).sum() / weight.sum())


def score_texts(field: Field, texts: list[str]) -> np.ndarray:
    """Scores from 0 to 1 of whole texts."""
    if not texts:
        return np.zeros(0)
    long = np.array([t.count("\n") >= _BLOCK_LINES for t in texts])
    means = np.empty(len(texts))
    short = [t for t, many in zip(texts, long, strict=True) if not many]
    if short:
        x, weight, per_line = features(short)
        p, _, _ = marginals(field, x, per_line)
        means[~long] = _document_means(p, weight, per_line)
    for i in np.flatnonzero(long):
        means[i] = _long_mean(field, texts[i])
    z = field.slope * _log_odds(means) + field.shift
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


# Characters and lines scored at a time; a text of very many lines goes in blocks of a step. A line takes about 1.7 KB meanwhile.
_BATCH_CHARS, _BATCH_LINES = 1_000_000, 12_000
_BLOCK_LINES, _BLOCK_STEP = 20_000, 4_000


def held_out(doc_id: Column) -> Column:
    """Whether a document's label may not be learned from."""
    return F.coalesce(F.pmod(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")), F.lit(4)) == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
          documents: int = TRAIN_DOCUMENTS) -> Field:
    """The field fitted on at most ``documents`` labelled documents that are not held out.

    Only their texts and labels reach the driver: at most ``documents`` texts of ``TRAIN_CHARS`` characters.
    """
    known = labels.select(F.col(doc_id).alias("key"), F.col(label).cast("int").alias("label")) \
        .filter(F.col("key").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("key")))
    chosen = known.groupBy("key").agg(F.min("label").alias("label")).orderBy(F.xxhash64("key"), "key").limit(documents)
    rows = docs.select(F.col(doc_id).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("body")) \
        .filter(F.char_length("body") <= TRAIN_CHARS).join(F.broadcast(chosen), "key") \
        .groupBy("key").agg(F.min(F.struct("body", "label")).alias("r")).select("key", "r.*").collect()
    rows.sort(key=lambda r: r["key"])
    return fit([r["body"] for r in rows], [r["label"] for r in rows])


def quality_scores(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality") -> DataFrame:
    """One row per document: ``doc_id, score`` (0 to 1, higher is better).

    The score depends on the text alone. A null text counts as empty; an empty text is one empty line. Without
    labels of both kinds every text gets the same score, a low one only if all labels are bad. Repeated rows are scored each, an empty table gives an
    empty result. No shuffle of documents; memory is bounded by a batch, of characters and lines, and a few
    numbers for each line of the longest text. Other columns
    are not looked at.
    """
    field = train(docs, labels, doc_id, text, label)
    return docs.select(F.col(doc_id).alias("doc_id"), score_column(field, F.col(text)).alias("score"))


def score_column(field: Field, text: Column) -> Column:
    """The score of a text column's values, computed in Arrow batches."""

    def scored(texts: pa.Array) -> pa.Array:
        out, some, chars, lines = [], [], 0, 0
        for t in texts:
            some.append(t.as_py() or "")
            chars += len(some[-1])
            lines += some[-1].count("\n") + 1
            if chars >= _BATCH_CHARS or lines >= _BATCH_LINES:
                out.append(score_texts(field, some))
                some, chars, lines = [], 0, 0
        out.append(score_texts(field, some))
        return pa.array(np.concatenate(out), pa.float64())

    return F.arrow_udf(scored, "double")(text)
