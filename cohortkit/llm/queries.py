"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortkit.llm import bpe, html, jaccard, lengths, lexical, licenses, mixing, quality, secrets, substring, syncmer, topk, whitening
from cohortkit.llm.common import read

MULTI_50K = "byte_bpe_multi_50k.tiktoken"
PLAIN_50K = "byte_bpe_50k.tiktoken"


def op1_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(read(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, read(spark, sf_dir, "labels")))


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = lengths.read_ranks(public_tokenizers.path(PLAIN_50K))
    return lengths.histogram(lengths.token_counts(read(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN))


def op5_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.classes(read(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.dedup(read(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def multi_50k() -> bpe.Vocabulary:
    return bpe.Vocabulary.from_file(public_tokenizers.path(MULTI_50K), public_tokenizers.PATTERN)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read(spark, sf_dir, "documents"), multi_50k())


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmer.fingerprints(read(spark, sf_dir, "documents"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: source/lang/hundred of the id/id."""
    docs = read(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"), F.col("doc_id").cast("string"))
    return licenses.inherit(licenses.scan(docs.select(path.alias("path"), "text", F.col("doc_id").cast("long").alias("doc_id"))))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(lexical.index(read(spark, sf_dir, "documents")), read(spark, sf_dir, "benchmark"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read(spark, sf_dir, "embeddings"))


def op13_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_source_mix": op1_source_mix,
    "op2_quality": op2_quality,
    "op3_top_k": op3_top_k,
    "op4_token_counts": op4_token_counts,
    "op5_html": op5_html,
    "op6_jaccard_join": op6_jaccard_join,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_bpe": op8_bpe,
    "op9_fingerprints": op9_fingerprints,
    "op10_licenses": op10_licenses,
    "op11_lexical_search": op11_lexical_search,
    "op12_whitening": op12_whitening,
    "op13_secrets": op13_secrets,
}

SQL: dict[str, str] = {
    "op1_source_mix": mixing.SQL,
    "op3_top_k": topk.SQL,
    "op11_lexical_search": lexical.SQL,
}
