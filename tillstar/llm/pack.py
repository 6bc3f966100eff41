"""Packing by minimum bin slack: a subset-sum over the remaining lengths fills every sequence.

Each task tokenizes its part of the documents and packs it, without a shuffle: documents longer than a
sequence give full sequences, their remainders wait in a pool. A sequence takes the longest remainder and the
multiset of others whose lengths add up closest to its capacity, found with a bitset of reachable sums and
followed back through the lengths; the same filling is repeated as long as the counts last. What is still free
is filled by cutting a remainder, so only the last sequence of a task can be short.
"""

from __future__ import annotations

import json
import re
import sys
import types
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import ship

ship(__name__)

SEQUENCE = 2048
END_ID = 1
# Remainders in the pool before packing begins, and those left when it pauses for more.
POOL_HIGH, POOL_LOW = 4096, 1024
# Half the bytes that the words and chunks kept by a Python worker may take; later ones are still tokenized, but not kept.
CACHE_BYTES = 16 << 20
# A batch of pieces is sent on at this many rows or bytes of ids.
ROWS_OUT, BYTES_OUT = 20_000, 4 << 20

SCHEMA = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"

# Characters of texts that are tokenized word by word here; a text with any other goes to the tokenizer as a whole.
# All are unchanged by NFC, and their lower case does not depend on their neighbours.
_PLAIN = "\\t-\\r -~\\xa1-\\xac\\xae-\\u012f\\u0131-\\u017f\\u2010-\\u2027\\u20ac"
_PLAIN_SET = frozenset(re.findall(f"[{_PLAIN}]", "".join(map(chr, range(0x2100)))))
_LETTER = "a-z\\xaa\\xb5\\xba\\xdf-\\xf6\\xf8-\\u017f"
_DIGIT = "0-9\\xb2\\xb3\\xb9\\xbc-\\xbe"
# The splitting rule of the tokenizer file, for these characters.
_PIECE = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTER}]+|[{_DIGIT}]|[^\\s{_LETTER}{_DIGIT}]+")
# How a tokenizer file states that rule. Texts of any other file go to its tokenizer as a whole.
_NORMALIZERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


def _word_by_word(spec: dict) -> bool:
    """Whether a tokenizer file splits and lower-cases by that rule."""
    return (spec["normalizer"] == {"type": "Sequence", "normalizers": _NORMALIZERS} and spec["model"]["type"] == "BPE"
            and spec["pre_tokenizer"] == {"type": "Sequence", "pretokenizers": [_SPLIT, _BYTES]}
            and all("<|" in t["content"] for t in spec["added_tokens"]))


def _byte_letters() -> dict[int, int]:
    """The usual printable stand-ins of byte-level BPE: printable bytes themselves, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table, n = {b: b for b in plain}, 256
    for b in range(256):
        if b not in table:
            table[b] = n
            n += 1
    return table


class Kept(dict):
    """Ids by string, for as many strings as fit in ``limit`` bytes."""

    def __init__(self, make, limit: int):
        self.make, self.room = make, limit

    def __missing__(self, key: str) -> bytes:
        ids = self.make(key)
        if self.room < 190:
            return ids
        # Two objects with their headers (at most 76 and 33 bytes, aligned), and an entry of a table just grown (60).
        cost = 190 + 2 * len(key) + len(ids)
        if cost <= self.room:
            self.room -= cost
            self[key] = ids
        return ids


class WordTokenizer:
    """Ids of a text as little-endian 32-bit bytes, equal to those of the tokenizer on the whole text."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.by_word = _word_by_word(json.loads(self.whole.to_str()))
        self.letters = _byte_letters()
        self.coded = [i.to_bytes(4, "little") for i in range(max(self.whole.get_vocab().values()) + 1)]
        self.words = Kept(self._word, CACHE_BYTES // 2)
        self.chunks = Kept(self._chunk, 2 * CACHE_BYTES - CACHE_BYTES // 2)

    def _word(self, word: str) -> bytes:
        mapped = word if word.isascii() else word.encode().decode("latin-1").translate(self.letters)
        return b"".join([self.coded[t.id] for t in self.model.tokenize(mapped)])

    def _chunk(self, chunk: str) -> bytes:
        # A chunk that is one word is kept as a chunk alone. Letters are the pattern's: a chunk of them is a word, and what follows them is another.
        if chunk.isalpha():
            return self._word(chunk)
        head, last = chunk[:-1], chunk[-1]
        if head.isalpha():
            return (self.chunks.get(head) or self.words[head]) + self.words[last]
        pieces = _PIECE.findall(chunk)
        return self._word(chunk) if pieces == [chunk] else b"".join([self.words[w] for w in pieces])

    def ids(self, text: str) -> bytes:
        if not self.by_word or not _PLAIN_SET.issuperset(text) or "<|" in text:
            return b"".join([i.to_bytes(4, "little") for i in self.whole.encode(text, add_special_tokens=False).ids])
        return b"".join(map(self.chunks.__getitem__, text.lower().split()))


def _tokenizer(path: str) -> WordTokenizer:
    """The worker process's tokenizer; its caches outlive the task."""
    state = sys.modules.setdefault("_pack_worker", types.ModuleType("_pack_worker"))
    if not hasattr(state, "tokenizers"):
        state.tokenizers = {}
    if path not in state.tokenizers:
        state.tokenizers[path] = WordTokenizer(path)
    return state.tokenizers[path]


def closest_multiset(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Lengths and how often each, within ``counts``, whose sum is as close to ``capacity`` as possible, not above."""
    mask = (1 << (capacity + 1)) - 1
    goal = 1 << capacity
    reach, steps = 1, []
    for length in sorted(counts, reverse=True):
        if length > capacity:
            continue
        left, take = min(counts[length], capacity // length), 1
        while left:
            take = min(take, left)
            steps.append((reach, length, take))
            reach |= (reach << (length * take)) & mask
            left -= take
            take *= 2
            if reach & goal:
                break
        if reach & goal:
            break
    at, chosen = reach.bit_length() - 1, {}
    for before, length, take in reversed(steps):
        if not (before >> at) & 1:
            at -= length * take
            chosen[length] = chosen.get(length, 0) + take
    return chosen


class Packer:
    """Packs token strings; ``out`` receives (document, start, ids, document's tokens, sequence, offset)."""

    def __init__(self, first_sequence: int, size: int = SEQUENCE):
        self.size, self.next = size, first_sequence
        self.pool: dict[int, list] = {}
        self.waiting = 0
        self.out: list[tuple] = []
        self.bytes_out = 0

    def full(self) -> bool:
        """Whether the pieces made so far are to be sent on."""
        return len(self.out) >= ROWS_OUT or self.bytes_out >= BYTES_OUT

    def _put(self, *piece) -> None:
        self.out.append(piece)
        self.bytes_out += len(piece[2])

    def add(self, doc, ids: bytes) -> None:
        n = len(ids) // 4
        full = n - n % self.size
        for start in range(0, full, self.size):
            self._put(doc, start, ids[4 * start:4 * (start + self.size)], n, self.next, 0)
            self.next += 1
        if full < n:
            self._keep((doc, full, ids[4 * full:], n))

    def _keep(self, piece: tuple) -> None:
        self.pool.setdefault(len(piece[2]) // 4, []).append(piece)
        self.waiting += 1

    def _take(self, length: int) -> tuple:
        pieces = self.pool[length]
        piece = pieces.pop()
        if not pieces:
            del self.pool[length]
        self.waiting -= 1
        return piece

    def pack(self, until: int) -> None:
        """Fill sequences until at most ``until`` remainders wait; with 0 the last sequence may be short."""
        while self.waiting > until:
            longest = max(self.pool)
            counts = {length: len(p) for length, p in self.pool.items()}
            counts[longest] -= 1
            filling = closest_multiset({k: v for k, v in counts.items() if v}, self.size - longest)
            filling[longest] = filling.get(longest, 0) + 1
            full = sum(length * n for length, n in filling.items()) == self.size
            times = min(len(self.pool[length]) // n for length, n in filling.items()) if full else 1
            for _ in range(times):
                self._sequence([self._take(length) for length in sorted(filling, reverse=True) for _ in range(filling[length])])

    def _sequence(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids, n in pieces:
            self._put(doc, start, ids, n, self.next, offset)
            offset += len(ids) // 4
        if offset < self.size and self.pool:
            # No waiting remainder fits as a whole, so any is longer than what is free.
            doc, start, ids, n = self._take(max(self.pool))
            cut = self.size - offset
            self._put(doc, start, ids[:4 * cut], n, self.next, offset)
            self._keep((doc, start + cut, ids[4 * cut:], n))
        self.next += 1


def packed(docs: DataFrame, tokenizer_path: str | None = None, doc_id: str = "doc_id", text: str = "text", size: int = SEQUENCE,
           with_ids: bool = False) -> DataFrame:
    """Pieces of all documents in sequences of at most ``size`` tokens.

    Columns: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` and, if asked for, ``ids`` (32-bit
    little endian).
    A document is its tokenizer ids (no special tokens added) and then id 1; a null text counts as empty and gives
    that id alone. Repeated rows are packed each, null ids stay null, no rows give no pieces. Sequences are numbered
    within their task, whose number fills the upper bits, so numbers are unique but have gaps. Every sequence is
    full except the last of a task, which is to be padded. Memory is bounded by the pool and the longest text.
    Other columns are not looked at.
    """
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("word_bpe_49k.json")

    def tasks(batches):
        from pyspark import TaskContext

        tokenizer = _tokenizer(tokenizer_path)
        packer = Packer(TaskContext.get().partitionId() << 36, size)
        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            for doc, words in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                packer.add(doc, tokenizer.ids(words.as_py() or "") + end)
                if packer.waiting >= POOL_HIGH:
                    packer.pack(POOL_LOW)
                if packer.full():
                    yield _batch(packer, with_ids)
        packer.pack(0)
        yield _batch(packer, with_ids)

    chosen = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return chosen.mapInArrow(tasks, SCHEMA + (", ids binary" if with_ids else ""))


def _batch(packer: Packer, with_ids: bool) -> pa.RecordBatch:
    rows, packer.out, packer.bytes_out = packer.out, [], 0
    columns = [
        pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64()),
        pa.array([len(r[2]) // 4 for r in rows], pa.int64()), pa.array([zlib.crc32(r[2]) for r in rows], pa.int64()),
        pa.array([r[3] for r in rows], pa.int64()), pa.array([r[4] for r in rows], pa.int64()),
        pa.array([r[5] for r in rows], pa.int64())]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    if with_ids:
        columns, names = [*columns, pa.array([r[2] for r in rows], pa.binary())], [*names, "ids"]
    return pa.RecordBatch.from_arrays(columns, names=names)
