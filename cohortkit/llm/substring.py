"""Substring dedup by recompression (operator 7).

A word goes if a window of ``WINDOW`` consecutive words that covers it also
starts in a document with a smaller id.

Recompression shortens all texts at once, in rounds. A round first joins runs
of equal symbols, then pairs whose left symbol is in one half of the alphabet
and whose right one is in the other; what is joined gets a new symbol. Halves
and new names are hashes of the symbols, so every worker gives equal pairs the
same name without a dictionary being passed around, and whether two symbols are
joined depends on nothing else. After ``ROUNDS`` = 3 rounds a border between
two symbols depends on ``CONTEXT`` = 4 words on either side, so equal windows
have equal borders inside. (A run is named by its symbol, not by its length. A
border near a run, where four words don't suffice, is not used.)

* Reveal: the ``2 * CONTEXT`` words around a border are its anchor. An anchor
  that only one document holds rules out all windows that contain it. Most of
  a corpus is ruled out here, at less than half an anchor per word.
* Verify: the windows that are left, those without an anchor among them, are
  compared by all their words and the smallest id of each is found. A window is
  told by 128 bits, two independent hashes over the identities of its words; a
  word's identity is its bytes, of a word of over 15 bytes a 120-bit digest.

How rows are dealt: a document belongs to a home by the hash of its id and text. For anchors and then for windows, a home sends each
bucket of the key space its distinct keys, packed; the bucket answers with one
bit per key (held by another home; held under a smaller id). A key is sent once
by a home however many of its documents hold it, so a passage in a third of all
documents is no hot key, and no bucket holds a list of documents.

Defined cases: null and empty texts have no words and stay as they are; rows
with a null id lose nothing and make no one else lose; rows of one id don't
count as each other's copies; texts of fewer words than a window are kept; an
empty table gives an empty result; extra columns are kept, whatever their names
(results are ``n_words``, ``n_removed``, ``removed``, ``kept``; of columns that
have these names the new ones count).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortkit.llm.common import bins_for, hashed, mixed, shuffle_partitions, span_hashes, word_bytes, word_ids

WINDOW = 13
ROUNDS = 3
#: Words on either side that a border of the third round depends on.
CONTEXT = 4
#: Characters of a home's documents and of the texts whose keys share a bucket, roughly.
HOME_CHARS, BUCKET_CHARS = 4_000_000, 8_000_000
_U = np.uint64
_PAIR = [("key", np.uint64), ("check", np.uint64)]


def borders(w: np.ndarray, first: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Recompression of all texts at once.

    ``w`` are the words' hashes, ``first`` marks the first words of texts.
    Returns the places where a symbol starts after the last round, and for each
    place if a run was joined there.
    """
    symbols, start, edge = w, np.arange(len(w)), first
    runs = np.zeros(len(w), dtype=bool)
    for r in range(rounds):
        a, b, inside = symbols[:-1], symbols[1:], ~edge[1:]
        left = (mixed(symbols + _U(2 * r + 1)) & _U(1)).astype(bool)
        run = (a == b) & inside
        joined = run | (left[:-1] & ~left[1:] & inside)
        runs[start[1:][run]] = True
        heads = np.flatnonzero(np.concatenate([[True], ~joined]))
        tails = np.append(heads[1:], len(symbols)) - 1
        name = mixed(mixed(symbols[heads] + _U(2 * r + 2)) * _U(3) + symbols[tails])
        symbols, start, edge = np.where(heads == tails, symbols[heads], name), start[heads], edge[heads]
    return start, runs


class _Home:
    """The words of a home's documents, one after the other. Documents without
    an id or with fewer words than a window take no part."""

    def __init__(self, table: pa.Table, window: int):
        ids = table.column("_id")
        self.ids = ids.fill_null(0).to_numpy().astype(np.int64)
        self.window = window
        high, low, self.sizes = word_ids(table.column("text"))
        part = (self.sizes >= window) & ids.is_valid().to_numpy()
        self.used = np.flatnonzero(part)
        taken = np.repeat(part, self.sizes)
        high, low = high[taken], low[taken]
        # two independent hashes of each word: one names symbols and keys, both verify
        self.w, self.w2 = hashed(high, low), hashed(high, low, 1)
        sizes = self.sizes[part]
        self.begin = np.cumsum(sizes) - sizes
        self.end = self.begin + sizes
        self.doc = np.repeat(self.ids[part], sizes)
        self.until = np.repeat(self.end, sizes)
        self.since = np.repeat(self.begin, sizes)

    def anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The distinct anchors, and of each if two documents here hold it;
        the places of the borders that may rule out windows and the numbers of
        their anchors. (A border near a run rules out nothing, but its anchor
        counts for others: their border need not be near a run.)"""
        none = np.empty(0, np.int64)
        if not len(self.w) or 2 * CONTEXT > self.window:
            return np.empty(0, np.uint64), np.empty(0, bool), none, none
        first = np.zeros(len(self.w), dtype=bool)
        first[self.begin] = True
        at, runs = borders(self.w, first)
        near = np.concatenate([[0], np.cumsum(runs)])
        c, n = CONTEXT, len(self.w)
        at = at[(at - c >= self.since[at]) & (at + c <= self.until[at])]
        clear = near[np.minimum(at + c + 2, n)] == near[np.maximum(at - c - 1, 0)]
        keys, number = np.unique(span_hashes(self.w, at - c, 2 * c, 1), return_inverse=True)
        least = np.full(len(keys), np.iinfo(np.int64).max)
        most = np.full(len(keys), np.iinfo(np.int64).min)
        np.minimum.at(least, number, self.doc[at])
        np.maximum.at(most, number, self.doc[at])
        return keys, least < most, at[clear], number[clear]

    def candidates(self, shared: np.ndarray, at: np.ndarray, number: np.ndarray) -> np.ndarray:
        """Places of the windows none of whose anchors is held by one document alone."""
        n, c = len(self.w), CONTEXT
        out = np.zeros(n + 1, dtype=np.int64)
        alone = at[~shared[number]] if len(at) else at
        np.add.at(out, np.maximum(alone + c - self.window, 0), 1)
        np.add.at(out, alone - c + 1, -1)
        places = np.flatnonzero(np.cumsum(out[:n]) == 0)
        return places[places + self.window <= self.until[places]]

    def windows(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The distinct windows (key and check), the smallest id of each here,
        and the number of each place's window."""
        both = np.empty(len(places), dtype=_PAIR)
        both["key"] = span_hashes(self.w, places, self.window, 2)
        both["check"] = span_hashes(self.w2, places, self.window, 3)
        keys, number = _unique_pairs(both)
        least = np.full(len(keys), np.iinfo(np.int64).max)
        np.minimum.at(least, number, self.doc[places])
        return keys, least, number


def _unique_pairs(both: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.unique of (key, check), by two plain sorts."""
    order = np.lexsort((both["check"], both["key"]))
    s = both[order]
    new = np.ones(len(s), dtype=bool)
    new[1:] = (s["key"][1:] != s["key"][:-1]) | (s["check"][1:] != s["check"][:-1])
    number = np.empty(len(s), dtype=np.int64)
    number[order] = np.cumsum(new) - 1
    return s[new], number


def _cuts(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that sorted keys fall into, and where each one's begin; the last
    end follows. The work depends on the keys alone."""
    of_key = ((keys >> _U(32)) * _U(buckets)) >> _U(32)
    starts = np.flatnonzero(np.concatenate([[True], of_key[1:] != of_key[:-1]])) if len(keys) else np.empty(0, np.int64)
    return of_key[starts].astype(np.int64), np.append(starts, len(keys))


_PARTS = "home long, bucket long, keys binary, checks binary, ids binary"
_BITS = "home long, bucket long, kind int, bits binary"


def _parts(home: int, buckets: int, keys: np.ndarray, checks: np.ndarray | None = None, ids: np.ndarray | None = None) -> pa.Table:
    full, cuts = _cuts(keys, buckets)
    # within a bucket the low half of a key is enough to reveal; to verify, all of it is sent
    sent = keys.astype(np.uint32) if checks is None else keys
    pack = lambda x: pa.array([b"" if x is None else x[i:j].tobytes() for i, j in zip(cuts, cuts[1:])], pa.binary())
    return pa.table({"home": pa.array(np.full(len(full), home, np.int64)), "bucket": pa.array(full),
                     "keys": pack(sent), "checks": pack(checks), "ids": pack(ids)})


def _unpack(home_bits: list[tuple[int, bytes]], keys: np.ndarray, buckets: int) -> np.ndarray:
    """The bits that the buckets sent, in order of the keys."""
    (full, cuts), out = _cuts(keys, buckets), np.zeros(len(keys), dtype=bool)
    for b, raw in home_bits:
        i = np.searchsorted(full, b)
        out[cuts[i]:cuts[i + 1]] = np.unpackbits(np.frombuffer(raw, np.uint8), count=cuts[i + 1] - cuts[i])
    return out


def _answers(kind: int):
    """A bucket's answer to every home: kind 0, which keys other homes hold
    too; kind 1, which windows occur under a smaller id."""

    def run(table: pa.Table) -> pa.Table:
        homes, bucket = table.column("home").to_pylist(), table.column("bucket").to_pylist()
        raw = table.column("keys").to_pylist()
        dtype = np.uint32 if kind == 0 else np.uint64
        keys = [np.frombuffer(x, dtype) for x in raw]
        ends = np.cumsum([0, *map(len, keys)])
        every = np.concatenate(keys)
        if kind == 0:
            _, number, count = np.unique(every, return_inverse=True, return_counts=True)
            yes = count[number] > 1
        else:
            both = np.empty(len(every), dtype=_PAIR)
            both["key"] = every
            both["check"] = np.concatenate([np.frombuffer(x, np.uint64) for x in table.column("checks").to_pylist()])
            ids = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("ids").to_pylist()])
            distinct, number = _unique_pairs(both)
            least = np.full(len(distinct), np.iinfo(np.int64).max)
            np.minimum.at(least, number, ids)
            yes = least[number] < ids
        bits = [np.packbits(yes[a:b]).tobytes() for a, b in zip(ends, ends[1:])]
        return pa.table({"home": pa.array(homes, pa.int64()), "bucket": pa.array(bucket, pa.int64()),
                         "kind": pa.array([kind] * len(homes), pa.int32()), "bits": pa.array(bits, pa.binary())})

    return run


def _bits(table: pa.Table, kind: int) -> list[tuple[int, bytes]]:
    rows = zip(table.column("bucket").to_pylist(), table.column("kind").to_pylist(), table.column("bits").to_pylist())
    return [(b, raw) for b, k, raw in rows if k == kind]


def deduped_documents(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` with all their columns, whatever their names, and with the texts
    that lost words replaced by the words they keep (and ``n_chars``, if there is
    one, by their length)."""
    rest = F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")])
    found = dedup(docs.select("doc_id", "text", rest.alias("rest")), window)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    new = {"doc_id": F.col("doc_id"), "text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("rest.n_chars")).cast("long")
           if "n_chars" in docs.columns else None}
    return found.select(*[(new[c] if c in new else F.col("rest").getField(c)).alias(c) for c in docs.columns])


def dedup(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """All columns of ``docs`` and n_words, n_removed, removed (the word ranges
    that go, ends excluded) and kept (the words that stay, joined by a space)."""
    spark = docs.sparkSession
    chars = docs.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    homes = max(shuffle_partitions(spark), bins_for(chars, HOME_CHARS))
    buckets = max(1, shuffle_partitions(spark) // 2, bins_for(chars, BUCKET_CHARS))
    own = [c for c in docs.columns if c.lower() not in ("n_words", "n_removed", "removed", "kept", "_id", "_home")]
    # by id and text: rows that share an id, or have none, are dealt like others
    home = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), "text"), F.lit(homes))
    dealt = docs.select(*own, F.col("doc_id").cast("long").alias("_id"), home.cast("long").alias("_home"))
    by_home = lambda: dealt.groupBy("_home")

    def send_anchors(table: pa.Table) -> pa.Table:
        keys = _Home(table, window).anchors()[0]
        return _parts(table.column("_home")[0].as_py(), buckets, keys)

    def left(texts: _Home, bits: pa.Table):
        keys, here, at, number = texts.anchors()
        return texts.candidates(here | _unpack(_bits(bits, 0), keys, buckets), at, number)

    def send_windows(table: pa.Table, bits: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _parts(0, 1, np.empty(0, np.uint64))
        texts = _Home(table, window)
        keys, least, _ = texts.windows(left(texts, bits))
        return _parts(table.column("_home")[0].as_py(), buckets, keys["key"], keys["check"], least)

    def remove(table: pa.Table, bits: pa.Table) -> pa.Table:
        texts = _Home(table, window)
        places = left(texts, bits)
        keys, least, number = texts.windows(places)
        earlier = _unpack(_bits(bits, 1), keys["key"], buckets)
        goes = earlier[number] | (texts.doc[places] > least[number])
        cover = np.zeros(len(texts.w) + 1, dtype=np.int64)
        cover[places[goes]] += 1
        np.add.at(cover, places[goes] + window, -1)
        gone = np.cumsum(cover[:-1]) > 0
        column = table.column("text")
        kept: dict[int, str] = {}
        removed: list[list[dict]] = [[] for _ in range(len(texts.sizes))]
        n_removed = np.zeros(len(texts.sizes), dtype=np.int64)
        for i, a, b in zip(texts.used.tolist(), texts.begin, texts.end):
            mask = gone[a:b]
            if mask.any():
                words = word_bytes(column[i].as_py())
                kept[i] = b" ".join([words[j] for j in np.flatnonzero(~mask)]).decode()
                turns = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
                removed[i] = [{"start": int(x), "end": int(y)} for x, y in zip(turns[::2], turns[1::2])]
                n_removed[i] = mask.sum()
        whole = [kept[i] if i in kept else b" ".join(word_bytes(t)).decode() for i, t in enumerate(column.to_pylist())]
        out = table.drop_columns(["_id", "_home"])
        span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return (out.append_column("n_words", pa.array(texts.sizes))
                .append_column("n_removed", pa.array(n_removed)).append_column("removed", pa.array(removed, span))
                .append_column("kept", pa.array(whole, pa.string())))

    anchors = by_home().applyInArrow(send_anchors, _PARTS)
    shared = anchors.groupBy("bucket").applyInArrow(_answers(0), _BITS)
    windows = by_home().cogroup(shared.groupBy("home")).applyInArrow(send_windows, _PARTS)
    earlier = windows.groupBy("bucket").applyInArrow(_answers(1), _BITS)
    schema = docs.select(
        *own, F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(None).cast("array<struct<start:int,end:int>>").alias("removed"), F.lit("").alias("kept")).schema
    return by_home().cogroup(shared.unionByName(earlier).groupBy("home")).applyInArrow(remove, schema)
