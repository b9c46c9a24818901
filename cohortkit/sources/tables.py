"""Scans of named tables (S1) and catalogue jobs.

A dataset is a directory of ``<name>.parquet`` tables. Reads are plain
``spark.read.parquet`` so that Catalyst pushes filters and prunes columns
into the scan; nothing here materialises data.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def path_version(spark: SparkSession, path: str) -> tuple | None:
    """What tells a rewritten file or folder from the one before: times and lengths
    of the path and, in a folder, of its entries (one metadata call each).

    ``None`` where the session has no JVM at hand (Spark Connect).
    """
    try:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    except Exception:
        return None
    where = jvm.org.apache.hadoop.fs.Path(path)
    fs = where.getFileSystem(conf)
    own = fs.getFileStatus(where)
    entries = fs.listStatus(where) if own.isDirectory() else [own]
    return tuple(sorted((s.getPath().getName(), s.getModificationTime(), s.getLen()) for s in entries))


_READS: dict = {}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one named table of the dataset.

    Opening a Parquet table lists its files and reads a footer for the schema,
    which is a small job of its own, so a table is opened once per application and
    every binding starts from the same lazy scan. A table that was rewritten since
    (``path_version``) is opened anew.
    """
    path = table_path(sf_dir, name)
    from ..session import app_key
    key, version = (app_key(spark), path), path_version(spark, path)
    known = _READS.get(key)
    if known is None or known[0] != version:
        known = _READS[key] = (version, spark.read.parquet(path))
    return known[1]


def dataset_version(spark: SparkSession, sf_dir: str, names: tuple[str, ...]) -> tuple:
    """The versions of a dataset's tables, for results kept per dataset."""
    return tuple(path_version(spark, table_path(sf_dir, n)) for n in names)


def list_tables(spark: SparkSession, sf_dir: str) -> list[str]:
    """S2 names: the tables the dataset holds, sorted by name.

    Listed through Spark's file system layer, so any URI it reads will do.
    """
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    root = jvm.org.apache.hadoop.fs.Path(sf_dir)
    found = [s.getPath().getName() for s in root.getFileSystem(conf).listStatus(root)]
    return sorted(n[:-len(".parquet")] for n in found if n.endswith(".parquet"))


def dataset_profile(spark: SparkSession, sf_dir: str,
                    names: tuple[str, ...] | None = None) -> DataFrame:
    """S2 + C17 as one job: every table with its row count and empty flag.

    Row counts come from a global ``count`` per table; Spark answers them
    from Parquet footers' row-group metadata without reading column data.
    """
    names = sorted(names) if names else list_tables(spark, sf_dir)
    parts = [
        read_table(spark, sf_dir, n).agg(F.count(F.lit(1)).alias("row_count"))
        .select(F.lit(n).alias("table_name"), "row_count")
        for n in names
    ]
    df = reduce(DataFrame.unionByName, parts)
    return (df.withColumn("is_empty", (F.col("row_count") == 0).cast("long"))
              .orderBy("table_name"))


_NUMERIC_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
                  T.DoubleType, T.DecimalType)


def schema_frame(spark: SparkSession, df: DataFrame, numeric_only: bool = False) -> DataFrame:
    """``(ordinal_position, column_name, data_type)`` of a frame.

    The schema is driver-side metadata of bounded size (one row per column),
    so building it as a small local frame is the catalogue, not data.
    """
    rows = [(i + 1, f.name, f.dataType.simpleString())
            for i, f in enumerate(df.schema.fields)
            if not numeric_only or isinstance(f.dataType, _NUMERIC_TYPES)]
    return spark.createDataFrame(
        rows, "ordinal_position int, column_name string, data_type string")


def _comparable(field: T.StructField) -> Column:
    """The column as text that is equal where its values are."""
    name = f"`{field.name}`"
    if isinstance(field.dataType, T.BinaryType):
        return F.hex(name)
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return (F.col(name) + F.lit(0.0)).cast("string")   # a negative zero is zero
    return F.col(name).cast("string")


#: Bytes of a value that are compared as they are; of longer ones a digest is.
WHOLE_BYTES = 64


def _told_apart(text: Column) -> Column:
    """What stands for a text where only equality counts: itself or, beyond
    ``WHOLE_BYTES``, its SHA-256 (a mark tells it from a short text of the same look)."""
    return F.when(F.octet_length(text) > WHOLE_BYTES, F.concat(F.lit("#"), F.sha2(text, 256))).otherwise(text)


def column_profile(spark: SparkSession, df: DataFrame) -> DataFrame:
    """S3 re-aimed as a job: per column its type, non-null and distinct count.

    One pass turns rows into (column, value) pairs, which are counted per
    value and then per column; equal values of a task meet before the shuffle,
    a frequent value is one row per task, and of a long text only a digest is
    shuffled. An empty table has zero counts.
    """
    fields = df.schema.fields
    pairs = [x for i, f in enumerate(fields) for x in (F.lit(i + 1), _told_apart(_comparable(f)))]
    values = (df.select(F.stack(F.lit(len(fields)), *pairs).alias("ordinal_position", "_value"))
                .groupBy("ordinal_position", "_value").agg(F.count(F.lit(1)).alias("_n")))
    counts = values.groupBy("ordinal_position").agg(
        F.sum("_n").alias("row_count"),
        F.sum(F.when(F.col("_value").isNotNull(), F.col("_n"))).alias("non_null_count"),
        F.count("_value").alias("distinct_count"))
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return (schema_frame(spark, df).join(counts, "ordinal_position", "left")
            .select("ordinal_position", "column_name", "data_type", count("row_count"),
                    count("non_null_count"), count("distinct_count")))
