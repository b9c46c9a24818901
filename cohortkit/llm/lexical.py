"""Ranked lexical search with Block-Max MaxScore (operator 11).

Scores are integers. With N documents that have a term, L terms in all (repeats
count), a document's n terms, a term's tf in it and df documents that hold it:

    weight = floor(1000 * ln((2N + 2) / (2df + 1)))
    m      = 100 - 25 + (25 n N) div L
    score  = sum over the query's terms (repeats count) of
             weight * ((10^9 tf) div (1000 tf + 12 m))

Index. Documents are cut, where they are read, into shards of ``SHARD_CHARS``
characters. A shard has one row of its documents (ids and n) and one row per term:
the posting list in blocks of ``BLOCK`` documents, and in front of it, for each
block, its last document, its greatest tf and its smallest n. A document's part
of a score grows with tf and falls with n, so these two bound it for any N and L.
The index covers all terms of all documents and knows nothing of the queries; it
is written to the shared checkpoint folder.

Search. Every query meets every shard once:

* Terms are ordered by their greatest possible part of a score, from the greatest
  tf and smallest n over all shards. Of the terms with the smallest such bounds, as
  many as together can't reach the least score of the ``k`` best known are not
  essential: a document that only they bring can't enter.
* The essential lists are decompressed and summed. Its documents are the
  candidates.
* Each other list, largest bound first, is asked about the candidates left. The
  maximum of the block that would hold a candidate tells, before the block is
  decompressed, whether the candidate can still enter; only blocks that are still
  asked for are decompressed.

A task searches several shards for a block of queries; the least score of the best
so far goes on from shard to shard. The lists of a query are merged in a tree,
``MERGE`` groups of shards at a time.

How rows are dealt: documents aren't shuffled, however often a text or a term
repeats: a term in every document is one short list per shard. Only lists that
some query asks for are sent to the tasks that search. Queries come in blocks of
``QUERY_BLOCK``; a list goes once to every block that asks for it.

Defined cases: null and empty texts have no terms and are in no result; a
query without terms has no rows; rows of one id are documents of their own, also
where all of the row repeats; a null id ranks after others of the same score;
queries with the same id and text are one, with the same id and other texts are
searched apart; terms that no document holds count nothing; fewer than ``k``
documents above zero are all returned; an empty table on either side gives an empty
result; extra columns are left behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import NO_ID, bins_for, column_batches, cut

TOP = 20
#: Characters of a shard's documents, roughly (a longer document is a shard by itself).
SHARD_CHARS = 8_000_000
#: Documents of a block of a posting list.
BLOCK = 64
#: Shards that a task searches, one after the other, and queries it searches them for.
SHARDS, QUERY_BLOCK = 6, 256
MERGE = 16

# What is no part of a term becomes a space, A-Z become a-z; bytes of other characters stay.
_FOLD = bytes(b if b > 0x7F or chr(b).isalnum() else 0x20 for b in bytes(range(256)).lower())


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_FOLD).split() if text else []


def part(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to a score, but for its weight."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def length_norm(n: np.ndarray, documents: int, total: int) -> np.ndarray:
    """m of documents with n terms."""
    if int(n.max(initial=0)) * documents < 2 ** 58:
        return 75 + (25 * n * documents) // max(1, total)
    return np.array([75 + (25 * int(x) * documents) // max(1, total) for x in n], dtype=np.int64)


# Posting lists. Head: per block the last document, the greatest tf, the smallest n
# and where the block ends in the body. Body: per block the gaps between documents,
# then the tfs less one, each as varints.

def _varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all values one after the other, and how many each takes."""
    values = values.astype(np.uint64)
    size = np.ones(len(values), dtype=np.int64)
    for bits in range(7, 64, 7):
        size += values >> np.uint64(bits) > 0
    end = np.cumsum(size)
    out = np.zeros(int(end[-1]) if len(end) else 0, dtype=np.uint8)
    for i in range(int(size.max(initial=0))):
        some = size > i
        more = (size[some] > i + 1).astype(np.uint8) << 7
        out[end[some] - size[some] + i] = (values[some] >> np.uint64(7 * i)).astype(np.uint8) & 0x7F | more
    return out, size


def _read_varints(raw: np.ndarray) -> np.ndarray:
    last = np.flatnonzero(raw < 0x80)
    first = np.concatenate([[0], last[:-1] + 1]) if len(last) else last
    place = np.arange(len(raw)) - np.repeat(first, last - first + 1)
    shifted = (raw & 0x7F).astype(np.int64) << (7 * place)
    return np.add.reduceat(shifted, first) if len(first) else np.empty(0, np.int64)


def _lists(term: np.ndarray, doc: np.ndarray, tf: np.ndarray, n: np.ndarray, size: int) -> tuple[pa.Array, pa.Array]:
    """Heads and bodies of the lists of all terms. Postings come by term, then document."""
    begin = np.searchsorted(term, np.arange(size))
    place = np.arange(len(term)) - begin[term]
    first = place % BLOCK == 0
    block = np.cumsum(first) - 1
    starts = np.flatnonzero(first)
    gap = doc - np.concatenate([[0], doc[:-1]])
    gap[place == 0] = doc[place == 0]
    # in a block the gaps come first, then the tfs
    rank = np.arange(len(term)) - starts[block]
    length = np.diff(np.append(starts, len(term)))
    order = np.empty(2 * len(term), dtype=np.int64)
    order[2 * starts[block] + rank] = np.arange(len(term))
    order[2 * starts[block] + length[block] + rank] = len(term) + np.arange(len(term))
    both = np.concatenate([gap, tf - 1])[order]
    raw, sizes = _varints(both)
    ends = np.cumsum(sizes)
    block_end = ends[2 * (starts + length) - 1]
    list_of = term[starts]
    last_of_list = np.append(list_of[1:] != list_of[:-1], True)
    list_end = block_end[last_of_list]
    list_start = np.concatenate([[0], list_end[:-1]])
    head = np.stack([doc[starts + length - 1], np.maximum.reduceat(tf, starts), np.minimum.reduceat(n[doc], starts),
                     block_end - list_start[list_of]], axis=1).astype("<i4")
    per_list = np.bincount(list_of, minlength=size)
    wrap = lambda offsets, data: pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), size, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(np.ascontiguousarray(data).tobytes())]).cast(pa.binary())
    return wrap(np.concatenate([[0], np.cumsum(per_list)]) * 16, head), wrap(np.concatenate([[0], list_end]), raw)


class Postings:
    """One list of a shard: its blocks are decompressed when asked for; a list
    that was asked for whole stays so for the other queries."""

    def __init__(self, head: bytes, body: bytes):
        h = np.frombuffer(head, "<i4").reshape(-1, 4).astype(np.int64)
        self.last, self.tf, self.n, self.end = h.T
        self.body = np.frombuffer(body, np.uint8)
        self.opened, self.known = 0, None

    def block(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        if self.known is not None:
            return tuple(c[i * BLOCK:(i + 1) * BLOCK] for c in self.known)
        values = _read_varints(self.body[self.end[i - 1] if i else 0:self.end[i]])
        half = len(values) // 2
        self.opened += 1
        return np.cumsum(values[:half]) + (self.last[i - 1] if i else 0), values[half:] + 1

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if self.known is None:
            values = _read_varints(self.body)
            full = (len(self.last) - 1) * 2 * BLOCK  # every block but the last is full
            blocks, rest = values[:full].reshape(-1, 2, BLOCK), values[full:]
            half = len(rest) // 2
            gaps = np.concatenate([blocks[:, 0].ravel(), rest[:half]])
            self.known = np.cumsum(gaps), np.concatenate([blocks[:, 1].ravel(), rest[half:]]) + 1
            self.opened += len(self.last)
        return self.known


_INDEX = "shard long, term binary, documents long, total long, tf long, n long, head binary, body binary"


def index(docs: DataFrame, shard_chars: int = SHARD_CHARS) -> DataFrame:
    """The index of all texts: for each shard a row without a term (documents
    and their terms in all; head: ids, body: n) and a row for each term
    (documents: df; tf: the greatest; n: the smallest)."""

    def shard_rows(shard: int, ids: list, split: list[list[bytes]]) -> pa.RecordBatch:
        # by id, nulls last: the document with the smaller number wins ties
        order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0))
        n = np.array([len(split[i]) for i in order], dtype=np.int64)
        every = [t for i in order for t in split[i]]
        names = {t: i for i, t in enumerate(dict.fromkeys(every))}
        number = np.fromiter(map(names.__getitem__, every), np.int64, len(every))
        pair, tf = np.unique(number * len(n) + np.repeat(np.arange(len(n)), n), return_counts=True)
        term, doc = np.divmod(pair, max(1, len(n)))
        size = len(names)
        heads, bodies = _lists(term, doc, tf, n, size) if size else (pa.array([], pa.binary()), pa.array([], pa.binary()))
        starts = np.searchsorted(term, np.arange(size))
        none = np.array([], dtype=np.int64)
        df = np.diff(np.append(starts, len(term))) if size else none
        known = np.array([NO_ID if ids[i] is None else ids[i] for i in order], dtype="<i8")
        nulls = np.array([ids[i] is None for i in order], dtype=np.uint8)
        own = pa.array([known.tobytes() + nulls.tobytes()], pa.binary()), pa.array([n.astype("<i4").tobytes()], pa.binary())
        plus = lambda first, rest: pa.array(np.concatenate([[first], rest]).astype(np.int64))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(size + 1, shard, np.int64)), pa.array([None, *names], pa.binary()), plus(np.count_nonzero(n), df),
             plus(n.sum(), np.add.reduceat(tf, starts) if size else none), plus(0, np.maximum.reduceat(tf, starts) if size else none),
             plus(0, np.minimum.reduceat(n[doc], starts) if size else none),
             pa.concat_arrays([own[0], heads]), pa.concat_arrays([own[1], bodies])],
            ["shard", "term", "documents", "total", "tf", "n", "head", "body"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        shard = (context.partitionId() if context else 0) << 32
        ids, split, chars = [], [], 0
        for batch in column_batches(batches, 500):
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = terms(text)
                if not found:
                    continue
                if ids and chars + len(text) > shard_chars:
                    yield shard_rows(shard, ids, split)
                    shard, ids, split, chars = shard + 1, [], [], 0
                ids.append(i), split.append(found)
                chars += len(text)
        if ids:
            yield shard_rows(shard, ids, split)

    return cut(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _INDEX), "lexical-index")


def query_terms(items: DataFrame, query_block: int = QUERY_BLOCK) -> tuple[DataFrame, int]:
    """item_id, item (a number of its own), block, term, times of every query,
    and the number of blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for item, i, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found, times = np.unique(np.array(terms(text), dtype=object), return_counts=True)
                out += [(item, i, t, int(c)) for t, c in zip(found, times, strict=True)]
            columns = list(zip(*out, strict=True)) if out else [(), (), (), ()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.binary(), pa.int64()), strict=True)],
                ["item", "item_id", "term", "times"])

    distinct = cut(items.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct().select(
        F.monotonically_increasing_id().alias("item"), "item_id", "text"), "lexical-items")
    blocks = bins_for(distinct.count(), query_block)
    found = distinct.mapInArrow(run, "item long, item_id long, term binary, times long")
    return cut(found.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks))), "lexical-queries"), blocks


def weight(df: Column, documents: int) -> Column:
    return F.floor(1000 * F.log(F.lit(float(2 * documents + 2)) / (2 * df + 1).cast("double"))).cast("long")


def _best(scores: np.ndarray, k: int) -> int:
    """The k-th greatest score, 0 if there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def search_shard(asked: list[tuple[int, int, Postings]], m: np.ndarray, norm, floor: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents (numbers) and scores that may be among the k best of a query.

    ``asked`` has factor (weight times repeats), global bound and list of every
    term that the shard holds, ``m`` of all documents of the shard, ``norm`` gives m of
    an n, ``floor`` is the least score of the best known (0: not k yet)."""
    asked = sorted(asked, key=lambda a: -a[1])
    rest = np.cumsum([b for _, b, _ in asked][::-1])[::-1].tolist() + [0]  # what lists from i on add at most
    # a document equal to the floor may enter by its id, one below can't
    essential = next((i for i, r in enumerate(rest) if r < floor or r == 0), len(asked))
    total = np.zeros(len(m), dtype=np.int64)
    for factor, _, postings in asked[:essential]:
        doc, tf = postings.all()
        total[doc] += factor * part(tf, m[doc])
    doc = np.flatnonzero(total)
    score = total[doc]
    for i in range(essential, len(asked)):
        floor = max(floor, _best(score, k))
        some = score + rest[i] >= floor
        doc, score = doc[some], score[some]
        if not len(doc):
            break
        factor, _, postings = asked[i]
        at = np.searchsorted(postings.last, doc)
        held = at < len(postings.last)
        limit = np.append(factor * part(postings.tf, norm(postings.n)), 0)[np.minimum(at, len(postings.last))]
        some = score + limit + rest[i + 1] >= floor
        doc, score, at, held = doc[some], score[some], at[some], held[some]
        for b in np.unique(at[held]):
            members, tf = postings.block(int(b))
            x, y = np.searchsorted(at, [b, b + 1])
            where = np.minimum(np.searchsorted(members, doc[x:y]), len(members) - 1)
            hit = members[where] == doc[x:y]
            score[x:y][hit] += factor * part(tf[where[hit]], m[doc[x:y][hit]])
    return doc, score


def _search(documents: int, total: int, k: int):
    """Searches a group of shards for a block of queries."""
    norm = lambda n: length_norm(n, documents, total)

    def run(lists: pa.Table, queries: pa.Table) -> pa.Table:
        shards: dict[int, dict[bytes | None, tuple[bytes, bytes]]] = {}
        for s, t, head, body in zip(*(lists.column(c).to_pylist() for c in ("shard", "term", "head", "body")), strict=True):
            shards.setdefault(s, {})[t] = (head, body)
        items: dict[tuple, list[tuple[bytes, int, int]]] = {}
        for item, i, t, factor, bound in zip(*(queries.column(c).to_pylist() for c in ("item", "item_id", "term", "factor", "bound")), strict=True):
            items.setdefault((item, i), []).append((t, factor, bound))
        best: dict[tuple, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for _, own in sorted(shards.items()):
            head, body = own.pop(None, (b"", b""))
            n = np.frombuffer(body, "<i4").astype(np.int64)
            ids = np.frombuffer(head[:8 * len(n)], "<i8").astype(np.int64)
            nulls = np.frombuffer(head[8 * len(n):], np.uint8).astype(bool)
            m = norm(n)
            opened = {t: Postings(*raw) for t, raw in own.items()}
            for item, wanted in items.items():
                s0, i0, z0 = best.get(item, (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)))
                asked = [(factor, bound, opened[t]) for t, factor, bound in wanted if t in opened and factor]
                if not asked:
                    continue
                doc, score = search_shard(asked, m, norm, _best(s0, k), k)
                s, i, z = np.concatenate([s0, score]), np.concatenate([i0, ids[doc]]), np.concatenate([z0, nulls[doc]])
                first = np.lexsort((i, z, -s))[:k]
                first = first[s[first] > 0]
                best[item] = s[first], i[first], z[first]
        cat = lambda parts, kind: np.concatenate([np.empty(0, kind), *parts])
        size = [len(s) for s, _, _ in best.values()]
        repeat = lambda values: pa.array([v for v, c in zip(values, size, strict=True) for _ in range(c)], pa.int64())
        none = cat((z for _, _, z in best.values()), bool)
        group = lists.column("group")[0].as_py() if lists.num_rows else 0
        return pa.table({"item": repeat(i for i, _ in best), "item_id": repeat(i for _, i in best),
                         "doc_id": pa.array(cat((i for _, i, _ in best.values()), np.int64), mask=none),
                         "score": pa.array(cat((s for s, _, _ in best.values()), np.int64)), "group": pa.array([group] * int(sum(size)), pa.int64())})

    return run


def search(lists: DataFrame, items: DataFrame, k: int = TOP, shards: int = SHARDS, query_block: int = QUERY_BLOCK) -> DataFrame:
    """item_id, rank, doc_id, score of the k best documents of an ``index`` for each of ``items`` (item_id, text)."""
    asked, n_blocks = query_terms(items, query_block)
    own = lists.filter(F.col("term").isNull())
    size = own.agg(F.sum("documents").alias("documents"), F.sum("total").alias("total"), F.count("*").alias("shards")).first()
    documents, total = size["documents"] or 0, size["total"] or 0

    # the lists that are asked for, and their terms' weights and bounds over all shards
    wanted = cut(lists.join(asked.select("term").distinct(), "term"), "lexical-lists")
    known = wanted.groupBy("term").agg(F.sum("documents").alias("df"), F.max("tf").alias("tf"), F.min("n").alias("n"))
    queries = asked.join(known, "term").withColumn("factor", weight(F.col("df"), documents) * F.col("times"))
    m = F.expr(f"75 + cast((cast(25 as decimal(38,0)) * n * {documents}) div {max(1, total)} as long)")
    queries = queries.withColumn("m", m).withColumn("bound", F.col("factor") * F.expr("(1000000000L * tf) div (1000 * tf + 12 * m)"))
    queries = cut(queries.select("item", "item_id", "block", "term", "factor", "bound"), "lexical-weights")

    groups = bins_for(size["shards"], shards)
    group = F.pmod(F.xxhash64("shard"), F.lit(groups)).cast("long").alias("group")
    blocks = queries.select("block", "term").distinct()
    sent = wanted.join(blocks, "term").select("block", group, "shard", "term", "head", "body")
    every = own.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1)).cast("array<long>")))
    sent = sent.unionByName(every.select("block", group, "shard", "term", "head", "body"))
    copies = queries.withColumnRenamed("block", "q_block").withColumn(
        "q_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)).cast("array<long>")))
    found = sent.groupBy("block", "group").cogroup(copies.groupBy("q_block", "q_group")).applyInArrow(
        _search(documents, total, k), "item long, item_id long, doc_id long, score long, group long")
    while groups > 1:
        groups = -(-groups // MERGE)
        found = _merge(found.withColumn("group", F.floor(F.col("group") / MERGE)), ["item", "group"], k).drop("rank")
    return _merge(found, ["item"], k).select("item_id", "rank", "doc_id", "score")


def _merge(lists: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


#: Texts are cut into terms by the same pattern; integer division is DuckDB's //.
SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(lower_ascii, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_ascii FROM documents WHERE text IS NOT NULL)),
b AS (SELECT r, doc_id, len(t)::BIGINT AS n FROM d WHERE len(t) > 0),
g AS (SELECT count(*)::BIGINT AS N, sum(n)::BIGINT AS L FROM b),
p AS (SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY r, term),
f AS (SELECT term, count(*)::BIGINT AS df FROM p GROUP BY term),
i AS (SELECT item, item_id, term, count(*)::BIGINT AS times FROM (
    SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
w AS (SELECT i.*, floor(1000 * ln((2 * g.N + 2)::DOUBLE / (2 * f.df + 1)::DOUBLE))::BIGINT AS weight FROM i JOIN f USING (term), g),
s AS (SELECT w.item, w.item_id, b.r, b.doc_id,
    sum(w.times * w.weight * ((1000000000 * p.tf) // (1000 * p.tf + 12 * (75 + (25 * b.n * g.N) // g.L))))::BIGINT AS score
  FROM w JOIN p USING (term) JOIN b USING (r), g GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT item_id, doc_id, score, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST))::INT AS rank FROM s WHERE score > 0)
WHERE rank <= 20
"""
