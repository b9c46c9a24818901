"""Byte-level BPE encoding and decoding (operator 8).

Two tiers per pre-token. A minimal perfect hash over the vocabulary tells
whether the whole pre-token is a token; one probe and one comparison settle it.
A pre-token that is none is merged from its bytes: the bytes form a linked
list, a heap holds the adjacent pairs that some token spells, and the pair of
the lowest rank, leftmost first, is merged until none is left. Workers remember
the ids of at most ``2 * REMEMBER`` pre-tokens; those not met for long go first.

The vocabulary is a rank file (base64 bytes and rank per line); its size bounds
what every task is sent. Texts are encoded row by row, so nothing is shuffled.

Defined cases: a null or empty text has no ids and decodes to no bytes; ids
that are null or unknown to the vocabulary decode to no bytes; repeated rows
and equal texts give equal ids; rows of an empty table give none; columns other
than the id are left behind, whatever they are called.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame

from cohortkit.llm.common import column_batches

#: Pre-tokens of each of the two generations that a worker remembers at most.
REMEMBER = 200_000
#: Keys per bucket of the perfect hash, on average.
PER_BUCKET = 2
#: Documents that are encoded at a time.
ROWS = 200


class PerfectHash:
    """A minimal perfect hash: n keys to the slots 0..n-1.

    Keys are hashed to buckets; the buckets, largest first, each look for the
    first displacement that sends their keys to free slots. Buckets of one key
    take the free slots that are left and store the slot itself.
    """

    def __init__(self, keys: list[bytes]):
        n = self.n = len(keys)
        self.m = max(1, n // PER_BUCKET)
        buckets: list[list[int]] = [[] for _ in range(self.m)]
        hashes = [xxhash.xxh64_intdigest(k) for k in keys]
        for i, h in enumerate(hashes):
            buckets[h % self.m].append(i)
        slots: list[int] = [-1] * n
        self.shift = [0] * self.m
        for b in sorted(range(self.m), key=lambda b: -len(buckets[b])):
            own = buckets[b]
            if len(own) < 2:
                break
            d = 0
            while True:
                at = [self.place(hashes[i], d) for i in own]
                if len(set(at)) == len(at) and all(slots[x] < 0 for x in at):
                    break
                d += 1
            self.shift[b] = d
            for i, x in zip(own, at, strict=True):
                slots[x] = i
        free = iter([x for x in range(n) if slots[x] < 0])
        for b, own in enumerate(buckets):
            if len(own) == 1:
                x = next(free)
                slots[x] = own[0]
                self.shift[b] = -x - 1
        self.keys = [keys[i] for i in slots]
        self.order = slots

    def place(self, h: int, d: int) -> int:
        return ((h >> 16) + d * ((h >> 33) | 1)) % self.n

    def slot(self, key: bytes) -> int:
        """The key's slot, or -1."""
        h = xxhash.xxh64_intdigest(key)
        d = self.shift[h % self.m] if self.n else 0
        x = -d - 1 if d < 0 else (self.place(h, d) if self.n else -1)
        return x if x >= 0 and self.keys[x] == key else -1


class Vocabulary:
    """Tokens and ranks of a rank file and the pattern that splits its texts."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.pattern = pattern
        self.index = PerfectHash(list(ranks))
        values = list(ranks.values())
        self.rank_of_slot = [values[i] for i in self.index.order]
        self.first = [ranks.get(bytes([b]), -1) for b in range(256)]
        # rank of what two adjacent tokens spell: by the left one's rank, then the right one's
        self.pairs: list[dict[int, int]] = [{} for _ in range(max(values, default=-1) + 1)]
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    self.pairs[a][b] = rank
        self.tokens = np.full(max(values, default=-1) + 1, b"", dtype=object)
        for token, rank in ranks.items():
            self.tokens[rank] = token

    @classmethod
    def from_file(cls, path: str, pattern: str) -> Vocabulary:
        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines if line.strip())
            return cls({base64.b64decode(a): int(b) for a, b in pairs}, pattern)

    def whole(self, piece: bytes) -> int:
        slot = self.index.slot(piece)
        return -1 if slot < 0 else self.rank_of_slot[slot]

    def merge(self, piece: bytes) -> tuple[int, ...]:
        """The ids of a piece that is no token itself."""
        n, pairs, push, pop = len(piece), self.pairs, heapq.heappush, heapq.heappop
        bits = n.bit_length()
        low = (1 << bits) - 1
        ids = [self.first[b] for b in piece]
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        # rank of the pair that starts at a position, -1 if there is none
        joint = [pairs[a].get(b, -1) for a, b in zip(ids, ids[1:])]
        joint.append(-1)
        heap = [r << bits | i for i, r in enumerate(joint) if r >= 0]
        heapq.heapify(heap)
        while heap:
            top = pop(heap)
            i = top & low
            rank = top >> bits
            if joint[i] != rank:
                continue
            j = after[i]
            k = after[i] = after[j]
            ids[i] = rank
            ids[j] = joint[j] = joint[i] = -1
            if k < n:
                before[k] = i
                r = pairs[rank].get(ids[k], -1)
                if r >= 0:
                    joint[i] = r
                    push(heap, r << bits | i)
            h = before[i]
            if h >= 0:
                r = joint[h] = pairs[ids[h]].get(rank, -1)
                if r >= 0:
                    push(heap, r << bits | h)
        return tuple([x for x in ids if x >= 0])

    def encode_piece(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode("utf-8")
        rank = self.whole(raw)
        return (rank,) if rank >= 0 else self.merge(raw)

    def decode(self, ids: np.ndarray) -> bytes:
        known = ids[(ids >= 0) & (ids < len(self.tokens))] if len(ids) else ids
        return b"".join(self.tokens[known].tolist())


class _Memory(dict):
    """Ids by pre-token, as the bytes of 32-bit integers. When it is full, all become the older generation, from
    which those that are met again come back; the generation before is forgotten."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.older: dict[str, bytes] = {}

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= REMEMBER:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(piece)
        if ids is None:
            ids = array("i", self.vocabulary.encode_piece(piece)).tobytes()
        self[piece] = ids
        return ids


def _encoding(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, memory = regex.compile(vocabulary.pattern).findall, _Memory(vocabulary)
        for batch in column_batches(batches, ROWS):
            lists = [np.frombuffer(b"".join(map(memory.__getitem__, split(t))), dtype=np.int32) if t else _NONE
                     for t in batch.column(1).to_pylist()]
            ends = np.cumsum([0, *map(len, lists)]).astype(np.int32)
            ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([_NONE, *lists])))
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), ids], ["doc_id", "ids"])

    return run


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, ids): the ids of every whole text."""
    return docs.selectExpr(f"`{doc_id}` AS doc_id", f"`{text}` AS text").mapInArrow(
        _encoding(vocabulary), "doc_id long, ids array<int>")


_NONE = np.empty(0, dtype=np.int32)


def _lists(column: pa.ListArray) -> Iterator[np.ndarray]:
    values, ends = column.values, column.offsets.to_numpy()
    values = values.fill_null(-1).to_numpy(zero_copy_only=False)
    for null, a, b in zip(column.is_null().to_pylist(), ends, ends[1:], strict=False):
        yield _NONE if null else values[a:b]


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids) -> (doc_id, decoded): the bytes the ids stand for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in column_batches(batches, ROWS):
            raw = [vocabulary.decode(ids) for ids in _lists(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(raw, pa.binary())], ["doc_id", "decoded"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, decoded binary")


def _digesting(vocabulary: Vocabulary):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = np.array([str(i) for i in range(len(vocabulary.tokens))], dtype=object)
        for batch in column_batches(batches, ROWS):
            rows = [(len(ids), hashlib.sha256(",".join(numbers[ids].tolist()).encode()).hexdigest(),
                     hashlib.sha256(vocabulary.decode(ids)).hexdigest()) for ids in _lists(batch.column(1))]
            n, a, b = zip(*rows, strict=True) if rows else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def digests(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of every text's ids and of what they
    decode to. Ids go from encoder to decoder within a task."""
    encoding, digesting = _encoding(vocabulary), _digesting(vocabulary)
    return docs.selectExpr(f"`{doc_id}` AS doc_id", f"`{text}` AS text").mapInArrow(
        lambda batches: digesting(encoding(batches)), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
