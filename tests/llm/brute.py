"""Plain Python counterparts of the corpus operators, for small inputs."""

from __future__ import annotations

import hashlib
import re

import numpy as np

SPACE = "[\x20\x09-\x0d]"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Groups:
    """Union and find."""

    def __init__(self):
        self.up = {}

    def find(self, x):
        self.up.setdefault(x, x)
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, x, y):
        a, b = sorted((self.find(x), self.find(y)))
        self.up[b] = a


def contamination(docs, items):
    """(words, hit words, sorted item ids) per document."""
    split = lambda t: WORD.findall((t or "").translate(LOWER))
    windows = {}
    for i, t in items:
        w = split(t)
        n = min(10, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[s:s + n]), set()).add(str(i))
    out = []
    for d, t in docs:
        w = split(t)
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for s in range(len(w) - n + 1):
                if ids := windows.get(tuple(w[s:s + n])):
                    hit |= set(range(s, s + n))
                    found |= ids
        out.append((d, len(w), len(hit), sorted(found)))
    return out


def simhash(text):
    import xxhash

    words = [w for w in re.split(SPACE + "+", (text or "").translate(LOWER)) if w]
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i:i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def hamming_components(prints, bits=2):
    """Smallest member of the component of every distinct fingerprint."""
    values = np.array(sorted(set(prints)), dtype=np.uint64)
    groups = Groups()
    for v in values:
        for w in values[np.bitwise_count(values ^ v) <= bits]:
            groups.join(int(v), int(w))
    return {int(v): groups.find(int(v)) for v in values}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def removed_lines(docs, min_chars, shorter=False):
    """Numbers of the lines to remove, per document, in the order of (id, line); ``shorter`` ones only if they are equal."""
    seen = [(d, n, line.strip(" \t\r\x0b\x0c")) for d, t in docs for n, line in enumerate((t or "").split("\n"))]
    seen = sorted((o for o in seen if len(o[2]) >= (1 if shorter else min_chars)), key=lambda o: (o[0] is None, o[0] or 0, o[1]))
    bodies = sorted({o[2] for o in seen})
    groups = Groups()
    long = [b for b in bodies if len(b) >= min_chars]
    for i, a in enumerate(long):
        for b in long[i:]:
            if abs(len(a) - len(b)) <= 1 and edits(a, b) <= 1:
                groups.join(a, b)
    first, out = {}, {d: [] for d, _ in docs}
    for d, n, body in seen:
        root = groups.find(body)
        if first.setdefault(root, (d, n)) != (d, n):
            out[d].append(n)
    return out


def shingles(text, width=5):
    """The set of a text's word shingles; of a shorter text all its words."""
    words = [w for w in re.split(SPACE + "+", (text or "").translate(LOWER)) if w]
    return {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()


def jaccard(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def near_groups(docs, least=0.8):
    """Smallest id of the group of every document; pairs whose shingles are similar enough are linked."""
    sets = sorted((d, shingles(t)) for d, t in docs)
    groups = Groups()
    for i, (a, s) in enumerate(sets):
        for b, t in sets[:i]:
            if jaccard(s, t) >= least:
                groups.join(a, b)
    return {d: groups.find(d) for d, _ in sets}
