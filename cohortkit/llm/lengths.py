"""Exact length histogram (operator 4).

Documents are encoded once and only their token counts go on, summed per
length. Suffix sums over the distinct lengths then answer, for every context
limit at once, how many documents are longer, how many tokens they hold, what
truncation to the limit leaves and which quantile the limit is. Lengths are cut
into ranges of ``RANGE``: sums per range, prefix sums over the ranges, and one
window inside each, so that no task holds all lengths.

Defined cases: a null or empty text has length 0 and counts as a document; rows
are counted one by one, repeated ids included; an empty table gives an empty
histogram; limits between two lengths are answered by ``at_limits``; extra
columns are left behind.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortkit.llm.common import column_batches, cut

RANGE = 1024
ROWS = 500


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


def token_counts(docs: DataFrame, ranks: dict[bytes, int], pattern: str, text: str = "text") -> DataFrame:
    """(n_tokens): the encoded length of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        for batch in column_batches(batches, ROWS):
            yield pa.RecordBatch.from_arrays(
                [pa.array([len(encode(t)) if t else 0 for t in batch.column(0).to_pylist()], pa.int64())], ["n_tokens"])

    return docs.selectExpr(f"`{text}` AS text").mapInArrow(run, "n_tokens long")


def histogram(lengths: DataFrame) -> DataFrame:
    """(n_tokens) -> one row per distinct length, taken as a context limit:
    n_docs of that length, n_longer documents, tokens_longer in them, kept
    tokens after truncation to it, total tokens, quantile of the limit."""
    # written once: two branches read it, and the texts are encoded once
    counts = cut(lengths.groupBy(F.col("n_tokens").alias("context_limit")).agg(F.count("*").alias("n_docs")), "lengths-counts")
    counts = counts.withColumn("_t", F.col("context_limit") * F.col("n_docs")).withColumn("_r", F.floor(F.col("context_limit") / RANGE))
    ranges = counts.groupBy("_r").agg(F.sum("n_docs").alias("_docs"), F.sum("_t").alias("_tokens"))
    later = Window.orderBy("_r").rowsBetween(1, Window.unboundedFollowing)
    every = Window.partitionBy()
    ranges = ranges.select(
        "_r", F.coalesce(F.sum("_docs").over(later), F.lit(0)).alias("_more"), F.coalesce(F.sum("_tokens").over(later), F.lit(0)).alias("_more_t"),
        F.sum("_docs").over(every).alias("_all"), F.sum("_tokens").over(every).alias("_all_t"))
    after = Window.partitionBy("_r").orderBy("context_limit").rowsBetween(1, Window.unboundedFollowing)
    rows = counts.join(ranges, "_r").withColumn("n_longer", F.col("_more") + F.coalesce(F.sum("n_docs").over(after), F.lit(0)))
    rows = rows.withColumn("tokens_longer", F.col("_more_t") + F.coalesce(F.sum("_t").over(after), F.lit(0)))
    return rows.select("context_limit", "n_docs", "n_longer", "tokens_longer",
                       (F.col("_all_t") - F.col("tokens_longer") + F.col("context_limit") * F.col("n_longer")).alias("kept_tokens"),
                       F.col("_all_t").alias("total_tokens"),
                       ((F.col("_all") - F.col("n_longer")).cast("double") / F.col("_all").cast("double")).alias("quantile"))


def at_limits(hist: DataFrame, limits: list[int]) -> DataFrame:
    """n_longer, tokens_longer and kept_tokens of any limits, from a histogram."""
    ask = F.explode(F.array(*[F.lit(x).cast("long") for x in limits]))
    rows = hist.withColumn("limit", ask)
    over = F.col("context_limit") > F.col("limit")
    n, t = F.sum(F.when(over, F.col("n_docs")).otherwise(0)), F.sum(F.when(over, F.col("n_docs") * F.col("context_limit")).otherwise(0))
    return rows.groupBy("limit").agg(n.alias("n_longer"), t.alias("tokens_longer"),
                                     (F.max("total_tokens") - t + F.first("limit") * n).alias("kept_tokens"))


def quantiles(hist: DataFrame, shares: list[float]) -> DataFrame:
    """The smallest length that at least each share of the documents don't exceed."""
    rows = hist.withColumn("share", F.explode(F.array(*[F.lit(float(x)) for x in shares])))
    return rows.filter(F.col("quantile") >= F.col("share")).groupBy("share").agg(F.min("context_limit").alias("length"))
