"""Helpers shared by the operators of this folder."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.session import materialize

#: A word: a maximal run of anything but ASCII white space. ``bytes.split()``
#: without arguments cuts UTF-8 text into exactly these words.
WORD = r"[^\x20\x09-\x0D]+"

#: Stands for a null id where rows are matched on it.
NO_ID = -(2 ** 63)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared checkpoint folder and read again."""
    return materialize(df, f"llm-{name}")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def id_or_none(name: str = "doc_id") -> Column:
    """The id as a long that can be joined on; null becomes ``NO_ID``."""
    return F.coalesce(F.col(name).cast("long"), F.lit(NO_ID))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bins_for(rows: int, per_bin: int, least: int = 1) -> int:
    return max(least, -(-rows // per_bin))


def word_bytes(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def column_batches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


# Identities of words, straight from the bytes of an Arrow column: 128 bits in two
# numbers. A word of up to 15 bytes is its own identity (its bytes and its length);
# a longer one has 120 bits of a cryptographic digest, under a length no short word has.
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_SHORT = 15
_MASKS = np.array([(1 << 8 * n) - 1 for n in range(8)] + [2 ** 64 - 1], dtype=np.uint64)
#: Bytes that are taken at a time, roughly.
_CHUNK = 1_000_000


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_hashes(words: np.ndarray, at: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Hashes of the n words that start at each place."""
    total = np.zeros(len(at), dtype=np.uint64)
    for i in range(n):
        f = mixed(np.array([seed * 1000 + i + 1], dtype=np.uint64))[0] | np.uint64(1)
        total += mixed(words[at + i] + f) * f
    return mixed(total)


def _identities(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The identities of the words from ``starts`` to ``stops``. ``data`` has 16
    more bytes behind the last word."""
    size = stops - starts
    at = np.ndarray((max(0, len(data) - 8),), dtype="<u8", buffer=data, strides=(1,))  # eight bytes from every place
    low = at[starts] & _MASKS[np.minimum(size, 8)]
    high = at[starts + 8] & _MASKS[np.clip(size - 8, 0, 7)] | np.minimum(size, 255).astype(np.uint64) << np.uint64(56)
    long = np.flatnonzero(size > _SHORT)
    if len(long):
        raw = data.tobytes()
        digests = b"".join(b"\xff" + hashlib.blake2b(raw[i:j], digest_size=15).digest() for i, j in zip(starts[long].tolist(), stops[long].tolist()))
        both = np.frombuffer(digests, ">u8").astype(np.uint64).reshape(-1, 2)
        high[long], low[long] = both.T
    return high, low


def word_ids(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The identities (two numbers each) of all words of a text column, one text
    after the other, and the number of words of each text (null: none)."""
    if isinstance(texts, pa.ChunkedArray):
        texts = pa.concat_arrays(texts.chunks) if texts.num_chunks else pa.array([], pa.string())
    texts = texts.cast(pa.large_binary()).fill_null(b"")
    none = np.empty(0, np.uint64)
    if not len(texts):
        return none, none, np.empty(0, np.int64)
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    high, low, counts, i = [none], [none], np.zeros(len(texts), dtype=np.int64), 0
    while i < len(texts):
        j = max(i + 1, int(np.searchsorted(ends, ends[i] + _CHUNK, side="right")) - 1)
        own, cuts = data[ends[i]:ends[j]], ends[i:j + 1] - ends[i]
        space = _IS_SPACE[own]
        fresh = np.ones(len(own) + 1, dtype=bool)  # a white space or a text's end lies before
        fresh[1:] = np.append(space, True)[:len(own)] if len(own) else True
        fresh[cuts] = True
        starts = np.flatnonzero(fresh[:-1] & ~space)
        last = np.flatnonzero(fresh[1:] | np.append(space[1:], True)) if len(own) else np.empty(0, np.int64)
        stops = last[~space[last]] + 1
        one, two = _identities(np.concatenate([own, np.zeros(16, np.uint8)]), starts, stops)
        high.append(one), low.append(two)
        counts[i:j] = np.diff(np.searchsorted(starts, cuts))
        i = j
    return np.concatenate(high), np.concatenate(low), counts


def hashed(high: np.ndarray, low: np.ndarray, seed: int = 0) -> np.ndarray:
    """64 bits of a word's identity, mixed; hashes of other seeds are independent."""
    f = mixed(np.array([seed * 2 + 1], dtype=np.uint64))[0]
    return mixed(low ^ mixed(high + f))


def words_key(text: str | None) -> bytes:
    """16 bytes that stand for the sequence of a text's words (a cryptographic digest)."""
    return hashlib.blake2b(b" ".join(word_bytes(text)), digest_size=16).digest()


def word_hashes(texts: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of a text column and the number of words of
    each text, for where equal hashes need not mean equal words."""
    high, low, counts = word_ids(texts)
    return hashed(high, low), counts
