"""Exact quantiles of groups of any size.

``percentile`` keeps every distinct value of a group in one buffer, a sort of a group
is one task's work, and sketches are approximate. Here a value becomes a 64-bit
number of the same order, and the wanted ranks are found 16 bits at a time: the
rows of the cells that still hold a wanted rank are counted per next cell. A
level is one partial aggregate, and its running counts go over at most 65,536 rows
per group and wanted cell, however many rows the group has. All levels are one lazy
plan of four scans of two or three columns; nothing comes to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEVEL_BITS = 16
_SHIFTS = tuple(range(64 - LEVEL_BITS, -1, -LEVEL_BITS))
_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FRACTION = 2 ** 52   # a double's fraction has 52 bits


def order_number(x: Column) -> Column:
    """A long with the order of the double ``x``, equal only where ``x`` is equal.

    Made from exponent and fraction, each step exact in doubles: exponents of two
    by ``pow``, scaling by them, and a subtraction between 1 and 2. Zeros of both signs
    are equal, infinities lie outside all numbers and NaN above all, as Spark sorts.
    """
    a = F.abs(x)
    guess = F.least(F.greatest(F.floor(F.log2(a)), F.lit(-1022)), F.lit(1024)).cast("int")
    scaled = a / F.pow(F.lit(2.0), guess)
    exponent = F.greatest(guess + F.when(scaled >= 2, 1).when(scaled < 1, -1).otherwise(0),
                          F.lit(-1022))
    normal = ((exponent + 1023).cast("long") * F.lit(_FRACTION)
              + ((a / F.pow(F.lit(2.0), exponent) - 1) * F.lit(float(_FRACTION))).cast("long"))
    tiny = (a * F.lit(2.0 ** 537) * F.lit(2.0 ** 537)).cast("long")
    size = (F.when(a == 0, F.lit(0).cast("long"))
             .when(a == F.lit(float("inf")), F.lit(2047 * _FRACTION))
             .when(a < F.lit(2.0 ** -1022), tiny)
             .otherwise(normal))
    return F.when(F.isnan(x), F.lit(2 ** 63 - 1)).otherwise(F.when(x < 0, -size).otherwise(size))


def _ranks(n: Column, probabilities: Sequence[float], interpolate: bool) -> Column:
    """The wanted ranks (from 1) among ``n`` values, each with its place in the result."""
    wanted = []
    for i, p in enumerate(probabilities):
        if interpolate:
            at = (n - 1) * F.lit(float(p))
            wanted += [(2 * i, F.floor(at) + 1), (2 * i + 1, F.ceil(at) + 1)]
        else:
            wanted.append((2 * i, F.greatest(F.ceil(n * F.lit(float(p))), F.lit(1))))
    return F.array(*[F.struct(F.lit(i).alias("place"), r.cast("long").alias("rank"))
                     for i, r in wanted])


def quantiles(df: DataFrame, by: Sequence[str], value: str, probabilities: Sequence[float],
              names: Sequence[str], interpolate: bool = False) -> DataFrame:
    """Per group of ``by`` the exact quantiles of ``value``, in columns ``names``.

    ``interpolate=False`` gives the value of rank ``ceil(p * n)`` in the column's own
    type (``quantile_disc``), ``True`` a double between the neighbours of
    ``p * (n - 1)`` (``quantile_cont``, and pandas). Decimals and others are taken as
    doubles. Null values do not count; a group of nulls only has no row; a null
    is a group like others. Without ``by`` there is one row, of nulls if there
    are no values.
    """
    by = list(by)
    keys = [f"_g{i}" for i in range(len(by))]
    integral = isinstance(df.schema[value].dataType, _INTEGRAL)
    x = F.col(value).cast("long") if integral else F.col(value).cast("double")
    rows = (df.select(*[F.col(b).alias(k) for b, k in zip(by, keys)], x.alias("_x"))
              .filter(F.col("_x").isNotNull())
              .withColumn("_key", F.col("_x") if integral else order_number(F.col("_x"))))

    wanted = None      # (group, prefix, ranks inside the prefix's cell)
    for shift in _SHIFTS:
        prefix = F.shiftright("_key", shift + LEVEL_BITS) if wanted is not None else F.lit(0)
        level = rows.withColumn("_prefix", prefix.cast("long"))
        if wanted is not None:
            level = level.alias("l").join(wanted.alias("w"), _same(keys + ["_prefix"]), "left_semi")
        # a struct as key: the aggregate has its own exchange, and a split of a hot cell is counted by itself
        cell = F.struct(*keys, "_prefix", F.shiftright("_key", shift).alias("_cell"))
        counts = (level.groupBy(cell.alias("_at"))
                       .agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_x"))
                       .select("_at.*", "_n", "_x"))
        within = Window.partitionBy(*keys, "_prefix")
        counts = counts.withColumn("_upto", F.sum("_n").over(
            within.orderBy("_cell").rowsBetween(Window.unboundedPreceding, 0)))
        if wanted is None:
            counts = counts.withColumn("_size", F.sum("_n").over(within)) \
                           .withColumn("_wanted", _ranks(F.col("_size"), probabilities, interpolate))
        else:
            counts = counts.alias("l").join(wanted.alias("w"), _same(keys + ["_prefix"]), "inner") \
                           .select("l.*", "w._size", "w._wanted")
        before = F.col("_upto") - F.col("_n")
        inside = F.filter("_wanted", lambda r: (r["rank"] > before) & (r["rank"] <= F.col("_upto")))
        here = counts.withColumn("_wanted", inside).filter(F.size("_wanted") > 0)
        wanted = here.select(
            *keys, F.col("_cell").alias("_prefix"), "_x", "_size",
            F.transform("_wanted", lambda r: F.struct(r["place"].alias("place"),
                                                      (r["rank"] - before).alias("rank")))
            .alias("_wanted"))

    places = [i for p in range(len(probabilities)) for i in ([2 * p, 2 * p + 1] if interpolate else [2 * p])]
    found = wanted.select(*keys, "_x", "_size", F.explode("_wanted.place").alias("_place"))
    out = found.groupBy(*keys).agg(
        *[F.max(F.when(F.col("_place") == i, F.col("_x"))).alias(f"_v{i}") for i in places],
        F.max("_size").alias("_size"))
    if interpolate:
        results = [_between(F.col(f"_v{2 * i}"), F.col(f"_v{2 * i + 1}"), F.col("_size"), p)
                   for i, p in enumerate(probabilities)]
    else:
        results = [F.col(f"_v{2 * i}").cast(df.schema[value].dataType)
                   for i in range(len(probabilities))]
    return out.select(*[F.col(k).alias(b) for b, k in zip(by, keys)],
                      *[r.alias(n) for r, n in zip(results, names)])


def side_by_side(*frames: DataFrame) -> DataFrame:
    """The columns of frames of one row each, in one row (no join)."""
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return rows.agg(*[F.max(c).alias(c) for c in rows.columns])


def _same(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b,
                  [F.col(f"l.{k}").eqNullSafe(F.col(f"w.{k}")) for k in keys])


def _between(low: Column, high: Column, n: Column, p: float) -> Column:
    at = (n - 1) * F.lit(float(p))
    weight = at - F.floor(at)
    low, high = low.cast("double"), high.cast("double")
    return F.when(low == high, low).otherwise(low + (high - low) * weight)
