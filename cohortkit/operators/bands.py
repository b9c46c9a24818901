"""Interval and band joins that expand neither intervals nor pairs.

Every range join in the reference also carries the entity equality
(``m.person_id = de.person_id AND t BETWEEN start AND end``). Planned as an
equi join on the entity with a residual range, a sort-merge join compares
each left row with *all* right rows of its entity: quadratic in the size of
the largest entity, and one task for a hot entity.

*Whether* a point lies in some interval (semi and anti joins, ``EXISTS``) needs
no join: in the time order of an entity's points and interval starts, the
greatest end of the intervals begun so far tells it. That is one ordered
scan, sliced as in :mod:`.ordered`, with one row per point and per interval.

*Which* intervals a point lies in is a join on (entity, level, cell). Each
interval has the level whose cells are just as long as it is, or longer (cells of
level k are ``LADDER``^k buckets long), and so at most two cells, however long it
is. A point is looked up once in every level that the intervals have; it
meets an interval in exactly one cell, and the exact range test stays as the
join condition. Intervals with a NULL bound never match, which is the
three-valued ``BETWEEN`` semantics of the reference.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.timecalc import epoch_micros, time_bucket
from .ordered import SLICE, running_max

#: Cells of a level are so many times as long as those of the level below.
LADDER = 8


def _keys(on: str | Sequence[str]) -> list[str]:
    return [on] if isinstance(on, str) else list(on)


def _widths(bucket_hours: float) -> list[int]:
    """The length of each level's cells, in microseconds; the last is longer than
    the years 1 to 9999."""
    out = [min(2 ** 59, max(1, round(bucket_hours * 3_600_000_000)))]
    while out[-1] < 2 ** 59:
        out.append(out[-1] * LADDER)
    return out


def interval_cells(intervals: DataFrame, lo: Column, hi: Column, bucket_hours: float) -> DataFrame:
    """One or two rows per interval: ``_level`` and ``_cell``, with ``_lo``/``_hi`` bounds."""
    iv = intervals.withColumns({"_lo": lo, "_hi": hi}).filter(F.col("_lo") <= F.col("_hi"))
    a, b = epoch_micros("_lo"), epoch_micros("_hi")
    widths = _widths(bucket_hours)
    level = F.coalesce(*[F.when(b - a <= w, F.lit(k)) for k, w in enumerate(widths[:-1])],
                       F.lit(len(widths) - 1))
    cell = lambda t: F.floor(t / F.get(F.lit(widths), F.col("_level"))).cast("long")
    return iv.withColumn("_level", level).withColumn(
        "_cell", F.explode(F.array_distinct(F.array(cell(a), cell(b)))))


def _point_cells(points: DataFrame, point_time: str, levels: DataFrame, bucket_hours: float
                 ) -> DataFrame:
    """Every point once per level of ``levels`` (one row: an array), with its cell."""
    width = F.get(F.lit(_widths(bucket_hours)), F.col("_level"))
    return (points.withColumn("_level", F.explode(levels.scalar()))
                  .withColumn("_cell", F.floor(epoch_micros(point_time) / width).cast("long")))


def covered(points: DataFrame, intervals: DataFrame, on: str | Sequence[str], point_time: str,
            lo: Column, hi: Column, slice_hours: float = 24.0) -> DataFrame:
    """``points`` with ``_covered``: whether some interval of the entity holds the
    point. One sweep over points and interval starts; nothing is expanded."""
    keys = _keys(on)
    end = T.StructField("_end", points.schema[point_time].dataType)
    starts = intervals.select(*keys, lo.alias("_t"), hi.alias("_end")).filter(F.col("_t") <= F.col("_end"))
    whole = T.StructType(points.schema.fields)
    # at one instant the intervals that start there come first
    stream = points.select(*keys, F.col(point_time).alias("_t"), F.lit(1).alias("_tag"),
                           F.lit(None).cast(end.dataType).alias("_end"),
                           F.struct(*[F.col(f"`{c}`") for c in points.columns]).alias("_row"))
    stream = stream.unionByName(starts.select(*keys, "_t", F.lit(0).alias("_tag"), "_end",
                                              F.lit(None).cast(whole).alias("_row")))
    stream = stream.withColumn(SLICE, F.coalesce(time_bucket("_t", slice_hours), F.lit(0).cast("long")))
    stream = running_max(stream, keys, "_t", "_tag", "_end", "_until")
    known = reduce(lambda x, y: x & y, [F.col(k).isNotNull() for k in keys])
    held = F.coalesce(known & (F.col("_until") >= F.col("_t")), F.lit(False))
    return stream.filter(F.col("_tag") == 1).select("_row.*", held.alias("_covered"))


def interval_join(points: DataFrame, intervals: DataFrame, on: str | Sequence[str],
                  point_time: str, lo: Column, hi: Column, how: str = "inner",
                  bucket_hours: float = 24.0) -> DataFrame:
    """Join ``points`` to ``intervals`` where ``lo <= point_time <= hi``.

    ``how`` is ``inner``, ``left`` (points kept), ``left_semi`` or
    ``left_anti`` (points with / without a containing interval). ``lo`` and
    ``hi`` are expressions over interval columns. ``bucket_hours`` is the length of
    the shortest cells and of the sweep's slices.
    """
    keys = _keys(on)
    if how in ("left_semi", "left_anti"):
        told = covered(points, intervals, keys, point_time, lo, hi, bucket_hours)
        return told.filter(F.col("_covered") == (how == "left_semi")).drop("_covered")
    iv = interval_cells(intervals, lo, hi, bucket_hours)
    levels = iv.agg(F.sort_array(F.collect_set("_level")))
    p, i = _point_cells(points, point_time, levels, bucket_hours).alias("p"), iv.alias("i")
    cond = [F.col(f"p.{k}") == F.col(f"i.{k}") for k in [*keys, "_level", "_cell"]]
    cond.append(F.col(f"p.{point_time}").between(F.col("i._lo"), F.col("i._hi")))
    own = [F.col(f"p.{c}") for c in points.columns]
    other = [c for c in intervals.columns if c not in keys]
    out = p.join(i, on=cond, how="inner").select(*own, *[F.col(f"i.{c}") for c in other])
    if how == "left":
        alone = interval_join(points, intervals, on, point_time, lo, hi, "left_anti", bucket_hours)
        types = {f.name: f.dataType for f in intervals.schema.fields}
        out = out.unionByName(alone.select("*", *[F.lit(None).cast(types[c]).alias(c) for c in other]))
    return out


def intervals_with_points(intervals: DataFrame, points: DataFrame, on: str | Sequence[str],
                          interval_id: Sequence[str], point_time: str, lo: Column,
                          hi: Column, bucket_hours: float = 24.0) -> DataFrame:
    """Interval-side semi join: the distinct ``interval_id`` rows that
    contain at least one point (``EXISTS`` from the interval side)."""
    keys = _keys(on)
    iv = interval_cells(intervals, lo, hi, bucket_hours)
    levels = iv.agg(F.sort_array(F.collect_set("_level")))
    p, i = _point_cells(points.select(*keys, point_time), point_time, levels, bucket_hours).alias("p"), iv.alias("i")
    cond = [F.col(f"i.{k}") == F.col(f"p.{k}") for k in [*keys, "_level", "_cell"]]
    cond.append(F.col(f"p.{point_time}").between(F.col("i._lo"), F.col("i._hi")))
    hit = i.join(p, on=cond, how="left_semi")
    return hit.select(*dict.fromkeys(keys + list(interval_id))).distinct()


def band_join(left: DataFrame, right: DataFrame, on: str | Sequence[str],
              left_time: str, right_time: str, before_hours: float, after_hours: float,
              how: str = "inner", bucket_hours: float | None = None) -> DataFrame:
    """Pairs with ``right_time - before <= left_time <= right_time + after``.

    The band around each right row is an interval, so this is an interval
    join with the right side as intervals. Output has left columns plus the
    right columns (right names must not clash with left names).
    """
    from ..functions.timecalc import shift
    width = bucket_hours or max(before_hours + after_hours, 1.0)
    return interval_join(left, right, on, left_time,
                         shift(right_time, -before_hours), shift(right_time, after_hours),
                         how=how, bucket_hours=width)


def cohort_window_join(facts: DataFrame, cohort: DataFrame, entity: str, time: str,
                       windows: Sequence[tuple[Column, Column | None]],
                       bucket_hours: float = 24.0, keep_bucket_as: str | None = None
                       ) -> DataFrame:
    """Join fact rows to the cohort row of their entity (one per entity).

    One join on the entity for cohorts of every size, without a hint and
    without a job of its own: adaptive execution measures the cohort and
    broadcasts it where it is small. Where it is not, it splits the partitions of
    entities with very many facts, but only if nothing above needs the rows of
    an entity together: aggregate the result with :func:`aggregate_split`, or
    window it through :mod:`.ordered`. Callers apply the exact test of
    ``windows`` (expressions ``[lo, hi]`` over cohort columns, ``hi=None`` for
    open ends); rows that no window's start lets through are dropped here, so
    nothing is ever expanded by the length of a window.

    ``keep_bucket_as`` adds the facts' time bucket under that name.
    """
    f = facts.withColumn(keep_bucket_as, time_bucket(time, bucket_hours)) if keep_bucket_as else facts
    started = reduce(lambda a, b: a | b, [F.col(time) >= lo for lo, _ in windows])
    return f.join(cohort, entity, "inner").filter(started)


def aggregate_split(rows: DataFrame, entity: str | Sequence[str], *aggs: Column) -> DataFrame:
    """``rows.groupBy(entity).agg(*aggs)`` on top of a join by the entity.

    The plain form reuses the join's partitioning, and then adaptive execution
    may not split the partition of a hot entity: one task would read all its
    facts. Grouped by a struct of the entity, the aggregate has an exchange of its
    own. Each split of a skewed partition is joined and partially aggregated by
    itself, and only the partial rows, one per entity and task, are shuffled.
    """
    keys = _keys(entity)
    g = rows.groupBy(F.struct(*[F.col(k).alias(f"_{i}") for i, k in enumerate(keys)])
                      .alias("_entity")).agg(*aggs)
    return g.select(*[F.col(f"_entity._{i}").alias(k) for i, k in enumerate(keys)],
                    *[c for c in g.columns if c != "_entity"])
