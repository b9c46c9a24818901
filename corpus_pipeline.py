"""The corpus pipeline: documents in, token ids out.

Each stage takes the documents that the one before has kept and is written as
Parquet before the next one reads it. All but the last return the columns of
``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortkit.llm import bpe, jaccard, mixing, quality, substring
from cohortkit.llm.common import cut, read
from cohortkit.llm.queries import multi_50k


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return quality.keep_good(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that are near copies of each other one stays."""
    return jaccard.keep_one_each(docs)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of passages that an earlier document has go; other texts stay as they are."""
    return substring.deduped_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number, and digests of the ids and of what they decode to."""
    return bpe.digests(docs, multi_50k())


STAGES = [
    ("quality classifier", keep_good),
    ("n-gram Jaccard join", drop_near_copies),
    ("substring dedup", drop_repeats),
    ("mixing sources to target weights", mix_sources),
    ("byte-level BPE encoding and decoding", encode),
]

#: Trained dictionaries, hashed signatures and BPE merges have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
