"""Column checks of a wide table.

The reference runs one query per checked column (``table_status`` loops
over columns and queries each). Here every check is one aggregate pass
over the table for all columns together, then ``stack`` turns the single
wide row into one row per column. Thresholds are columns, not Python.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.numeric import NUMERIC, fixed, numeric, percent

_NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
            T.DecimalType)


def _where(df: DataFrame, where: str | Column | None) -> DataFrame:
    if where is None:
        return df
    return df.filter(F.expr(where) if isinstance(where, str) else where)


def check_ranges(df: DataFrame, rules: Mapping[str, tuple[float, float]],
                 where: str | Column | None = "cohort_criteria = 1") -> DataFrame:
    """NULL share, mean (3 digits), min and max of each ruled column vs.
    its expected range -> ``PASS`` / ``FAIL``; an all-NULL column fails.

    One row per rule: ``column_name, pct_null, mean_val, min_val, max_val,
    expected_min, expected_max, status``.
    """
    d = _where(df, where)
    names = list(rules)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for i, c in enumerate(names):
        x = numeric(c)
        aggs += [F.count_if(F.col(c).isNull()).alias(f"_z{i}"),
                 fixed(F.avg(x), 3).alias(f"_a{i}"),
                 F.min(x).alias(f"_lo{i}"), F.max(x).alias(f"_hi{i}")]
    wide = d.agg(*aggs)
    parts = ", ".join(
        f"'{c}', _z{i}, _a{i}, _lo{i}, _hi{i}, "
        f"CAST({float(rules[c][0])!r} AS DECIMAL(38,9)), "
        f"CAST({float(rules[c][1])!r} AS DECIMAL(38,9))"
        for i, c in enumerate(names))
    long = wide.selectExpr(
        "_n", f"stack({len(names)}, {parts}) as (column_name, nulls, mean_val, min_val, "
        "max_val, expected_min, expected_max)")
    ok = (F.col("min_val").isNotNull() & (F.col("min_val") >= F.col("expected_min"))
          & (F.col("max_val") <= F.col("expected_max")))
    return long.select(
        "column_name", percent(F.col("nulls"), F.col("_n"), 1).alias("pct_null"),
        "mean_val", "min_val", "max_val", "expected_min", "expected_max",
        F.when(ok, "PASS").otherwise("FAIL - check units / concept IDs").alias("status"))


def check_column(df: DataFrame, column: str, expected_min: float, expected_max: float,
                 where: str | Column | None = "cohort_criteria = 1") -> DataFrame:
    """``check_ranges`` for one column."""
    return check_ranges(df, {column: (expected_min, expected_max)}, where)


def numeric_columns(df: DataFrame) -> list[str]:
    """Numeric columns in ordinal order."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, _NUMERIC)]


def table_status(df: DataFrame, where: str | Column | None = "cohort_criteria = 1",
                 ok_percent: float = 80) -> DataFrame:
    """Per numeric column the percent populated (0 digits) in the
    filtered rows: ``OK`` at ``ok_percent`` or more, ``partial`` above 0,
    else ``empty`` (R23: rounding happens before the ladder)."""
    d = _where(df, where)
    cols = numeric_columns(df)
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count(c).alias(f"_c{i}")
                                              for i, c in enumerate(cols)]
    wide = d.agg(*aggs)
    parts = ", ".join(f"{i + 1}, '{c}', _c{i}" for i, c in enumerate(cols))
    long = wide.selectExpr("_n", f"stack({len(cols)}, {parts}) as "
                                 "(ordinal_position, column_name, populated)")
    pct = F.coalesce(percent(F.col("populated"), F.col("_n"), 0), F.lit(0).cast(NUMERIC))
    return (long.select("ordinal_position", "column_name", pct.alias("pct_populated"))
                .withColumn("status",
                            F.when(F.col("pct_populated") >= ok_percent, "OK")
                             .when(F.col("pct_populated") > 0, "partial")
                             .otherwise("empty")))
