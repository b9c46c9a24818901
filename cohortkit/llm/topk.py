"""Exact top-k search by inner product (operator 3).

Vectors are turned into integers, so scores are exact. Queries come in blocks
of ``QUERY_BLOCK`` rows and candidates in shards of ``SHARD`` rows; a tile is
one block against one shard. Rows are dealt to their tiles by one key, every
tile is one matrix product, and of each query only its best ``k`` of the tile
go on. The lists of a query are merged in a tree, ``MERGE`` shards at a time,
so that no task ever gathers the lists of all shards.

Work grows with queries times candidates, as exact search does; the memory of a
task is bounded by one tile, and the shuffle by ``QUERY_BLOCK`` and ``SHARD``.

Defined cases: vectors that are null, or that hold a null or a non-finite
component, take no part; every other row is a candidate, whatever its id: rows
that share an id, with equal vectors or not, find each other, and each of them
that is a query has a list of its own; null ids are candidates, but no queries;
ties go to the smaller id, nulls last; vectors of
unequal length are never compared; a vector of no components scores 0; scores
beyond 64 bits are cut to the nearest long; a query with fewer than ``k``
partners gets them all; extra columns are left behind.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import bins_for, cut

QUERY_BLOCK = 2048
SHARD = 8192
MERGE = 16
SCALE = 1024
TOP = 10


def integers(vectors: DataFrame, scale: float = SCALE) -> DataFrame:
    """(vec_id, q): floor(scale * x) of every component, as doubles, of every row
    that takes part."""
    x = F.col("embedding").cast("array<double>")
    fine = F.col("embedding").isNotNull() & F.forall(
        x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) != float("inf")), F.lit(False)))
    return vectors.filter(fine).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda v: F.floor(v * float(scale)).cast("double")).alias("q"))


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best of one row; earlier places win ties."""
    if len(scores) <= k:
        return np.argsort(-scores, kind="stable")
    least = np.partition(scores, len(scores) - k)[len(scores) - k]
    over = np.flatnonzero(scores > least)
    level = np.flatnonzero(scores == least)[:k - len(over)]
    found = np.concatenate([over, level])
    return found[np.lexsort((found, -scores[found]))]


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integral doubles, as longs."""
    most = (np.abs(a).max(initial=0) * np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    whole = lambda m: np.array([[int(v) for v in row] for row in m], dtype=object).reshape(m.shape)
    exact = whole(a) @ whole(b).T
    return np.clip(exact, -(2 ** 63), 2 ** 63 - 1).astype(np.int64)


def _tile(table: pa.Table, k: int) -> pa.Table:
    kinds = table.column("query").to_numpy().astype(bool)
    own = table.column("row").to_numpy()
    none = table.column("vec_id").is_null().to_numpy()
    ids = table.column("vec_id").fill_null(0).to_numpy()
    dim = table.column("dim")[0].as_py()
    flat = table.column("q").combine_chunks()
    flat = flat.values if not isinstance(flat, pa.ChunkedArray) else pa.concat_arrays([c.values for c in flat.chunks])
    rows = flat.to_numpy(zero_copy_only=False).reshape(len(ids), dim)
    order = np.lexsort((own, ids, none))  # by id, nulls last
    ids, rows, kinds, own, none = ids[order], rows[order], kinds[order], own[order], none[order]
    c_ids, c_own, c_none = ids[~kinds], own[~kinds], none[~kinds]
    scores = _product(rows[kinds], rows[~kinds])
    out_q, out_r, out_v, out_n, out_s = [], [], [], [], []
    for row, query, number in zip(scores, ids[kinds], own[kinds]):
        others = np.flatnonzero(c_own != number)
        best = others[_best(row[others], k)]
        out_q.append(np.full(len(best), query)), out_r.append(np.full(len(best), number))
        out_v.append(c_ids[best]), out_n.append(c_none[best]), out_s.append(row[best])
    shard = table.column("shard")[0].as_py()
    cat = lambda parts: np.concatenate([np.empty(0, np.int64), *parts]).astype(np.int64)
    q = cat(out_q)
    return pa.table({"query": cat(out_r), "query_id": q, "vec_id": pa.array(cat(out_v), mask=cat(out_n).astype(bool)),
                     "score": cat(out_s), "shard": np.full(len(q), shard, np.int64)})


def top_k(vectors: DataFrame, is_query: Column, k: int = TOP, scale: float = SCALE,
          query_block: int = QUERY_BLOCK, shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score of the k best partners of every query row.

    ``is_query`` is a condition on ``vec_id``.
    """
    rows = integers(vectors, scale).withColumn("dim", F.size("q")).withColumn("query", F.coalesce(is_query, F.lit(False)))
    # once written, a row keeps its number
    rows = cut(rows.withColumn("row", F.monotonically_increasing_id()), "topk-vectors")
    n = rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("query"), 1)).alias("q")).first()
    blocks, shards = bins_for(n["q"], query_block), bins_for(n["n"], shard)
    deal = lambda parts, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(parts))
    every = lambda parts: F.explode(F.sequence(F.lit(0), F.lit(parts - 1)).cast("array<long>"))
    queries = rows.filter("query").select("*", deal(blocks, 1).alias("block"), every(shards).alias("shard"))
    others = rows.withColumn("query", F.lit(False)).select("*", every(blocks).alias("block"), deal(shards, 2).alias("shard"))
    tiles = queries.unionByName(others).groupBy("dim", "block", "shard").applyInArrow(
        lambda table: _tile(table, k), "query long, query_id long, vec_id long, score long, shard long")
    lists = tiles
    while shards > 1:
        shards = -(-shards // MERGE)
        lists = _merge(lists.withColumn("shard", F.floor(F.col("shard") / MERGE)), ["query", "shard"], k).drop("rank")
    return _merge(lists, ["query"], k).select("query_id", "rank", "vec_id", "score")


def _merge(lists: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col("score").desc(), F.col("vec_id").asc_nulls_last())
    return lists.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


SQL = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL
             AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
w AS (SELECT r, vec_id, len(e) AS dim, list_transform(e, lambda x: floor(1024 * x)::BIGINT) AS q FROM v),
s AS (SELECT a.r, a.vec_id AS query_id, b.vec_id,
        coalesce(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])), 0)::BIGINT AS score
      FROM w a JOIN w b ON a.vec_id % 100 = 0 AND a.r <> b.r AND a.dim = b.dim)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, (row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id ASC NULLS LAST))::INT AS rank FROM s) WHERE rank <= 10
"""
