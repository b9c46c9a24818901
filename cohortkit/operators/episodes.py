"""Episodes, segments and running totals over a long event table.

C10 ``cumulative_to_incremental``, C11 ``cumulative_total_check``,
C13 ``link_by_interval``, C15 ``gap_episodes``, C25 ``first_event_after``,
C26 ``first_segment``. Per-entity ordered logic goes through
:mod:`.ordered`, so no window is ever partitioned by the entity alone.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.timecalc import epoch_micros, whole_hours
from .bands import aggregate_split, cohort_window_join, interval_join
from .ordered import SLICE, segment_numbers, with_neighbors

E, T, C, V = "person_id", "measurement_datetime", "measurement_concept_id", "value_as_number"


def _codes(df: DataFrame, code: str, codes: Sequence | None) -> DataFrame:
    return df if codes is None else df.filter(F.col(code).isin(list(codes)))


def _gap_test(gap: Column, gap_hours: float, strict: bool) -> Column:
    return gap > gap_hours if strict else gap >= gap_hours


def gap_episodes(fact: DataFrame, codes: Sequence | None = None, *, gap_hours: float = 24,
                 min_hours: float = 48, strict: bool = True, entity: str = E,
                 time: str = T, code: str = C, tiebreak: str | Sequence[str] | None = None,
                 slice_hours: float | str = "auto") -> DataFrame:
    """A new episode starts at an entity's first event or after a gap of
    more than ``gap_hours`` whole hours (``>=`` when ``strict=False``).

    Returns one row per episode lasting at least ``min_hours`` whole hours:
    ``entity, episode_number, episode_start, episode_end, episode_hours,
    measurement_count``.
    """
    order = [tiebreak] if isinstance(tiebreak, str) else list(tiebreak or [])
    ev = _codes(fact, code, codes).select(entity, time, *order)
    ev = segment_numbers(ev, entity, time, tiebreak,
                         lambda prev, cur: _gap_test(whole_hours(prev, cur), gap_hours, strict),
                         "episode_number", slice_hours=slice_hours)
    ep = ev.groupBy(entity, "episode_number").agg(
        F.min(time).alias("episode_start"),
        F.max(time).alias("episode_end"),
        F.count(F.lit(1)).alias("measurement_count"),
    )
    ep = ep.withColumn("episode_hours", whole_hours("episode_start", "episode_end"))
    return (ep.filter(F.col("episode_hours") >= min_hours)
              .select(entity, "episode_number", "episode_start", "episode_end",
                      "episode_hours", "measurement_count"))


def cumulative_to_incremental(df: DataFrame, *, entity: str, order: Sequence[str],
                              value: str, out: str = "incremental",
                              slice_hours: float | str = "auto") -> DataFrame:
    """Running totals to increments, per entity in ``order``.

    increment = value - previous value; where that is negative (a reset) or
    missing (first row), the raw value is the increment. ``order[0]`` must be
    a timestamp (it defines the slices); the rest break ties.
    """
    order = list(order)
    d = with_neighbors(df, entity, order[0], order[1:] or None, [value], prev=True,
                       slice_hours=slice_hours)
    diff = F.col(value) - F.col(f"prev_{value}")
    return (d.withColumn(out, F.when(diff.isNull() | (diff < 0), F.col(value)).otherwise(diff))
              .drop(f"prev_{value}"))


def cumulative_total_check(increments: DataFrame, *, entity: str, order: Sequence[str],
                           value: str, incremental: str = "incremental") -> DataFrame:
    """C11: per entity the last running total vs. the sum of increments.

    They agree only when the series never resets (R9), so both are reported
    with a 0/1 ``totals_match``. All are partial aggregates (map-side
    combine), so a hot entity is merged from per-partition partials.
    """
    last = F.max_by(F.col(value), F.struct(*[F.col(c) for c in order]))
    agg = increments.groupBy(entity).agg(
        last.alias("last_cumulative"),
        F.sum(incremental).alias("incremental_total"),
        F.count(F.lit(1)).alias("row_count"))
    return agg.withColumn(
        "totals_match",
        (F.col("last_cumulative") == F.col("incremental_total")).cast("long"))


def link_by_interval(fact: DataFrame, visit: DataFrame, *, entity: str = E, time: str = T,
                     start: str = "visit_start_datetime", end: str = "visit_end_datetime",
                     bucket_hours: float = 24.0) -> DataFrame:
    """Attach the visit whose ``[start, end]`` contains the event.

    An inner join on entity and time bucket with the exact range as join
    condition (see :mod:`.bands`); visits with a NULL end match nothing.
    """
    return interval_join(fact, visit, entity, time, F.col(start), F.col(end),
                         how="inner", bucket_hours=bucket_hours)


def first_event_after(cohort: DataFrame, fact: DataFrame, codes: Sequence, anchor: str, *,
                      entity: str = E, time: str = T, code: str = C,
                      out: str = "first_ts") -> DataFrame:
    """Per entity the first event of ``codes`` at or after ``anchor``.

    The cohort has one row per entity; facts meet it through
    ``cohort_window_join``, and the minimum is a partial aggregate before its
    shuffle (``aggregate_split``).
    """
    ev = _codes(fact, code, codes).select(entity, time)
    anchors = cohort.select(entity, anchor).filter(F.col(anchor).isNotNull())
    j = cohort_window_join(ev, anchors, entity, time, [(F.col(anchor), None)]) \
        .filter(F.col(time) >= F.col(anchor))
    return aggregate_split(j, entity, F.min(time).alias(out))


def first_segment(cohort: DataFrame, fact: DataFrame, codes: Sequence, start: str, *,
                  gap_hours: float = 6, strict: bool = False, entity: str = E,
                  time: str = T, code: str = C, tiebreak: str | None = None,
                  end_out: str = "segment_end_ts", next_out: str = "next_segment_ts",
                  first_out: str | None = None, slice_hours: float | str = 24.0,
                  until: str | None = None) -> DataFrame:
    """From ``start`` on, the first event followed by a gap of at least
    ``gap_hours`` whole hours (``>`` when ``strict``), or the last event;
    also the time of the event after the gap (the next segment's start).

    With ``first_out`` the first event at or after ``start`` is returned too
    (C25 on the same rows): the segment search from the admission start and
    from the first event give the same segment, so one scan yields both.

    The reference searches without an upper bound (R13); ``until`` names a
    cohort column (e.g. the admission end) that bounds the search.
    """
    order = [tiebreak] if tiebreak else []
    ev = _codes(fact, code, codes).select(entity, time, *order)
    cols = [entity, start] + ([until] if until else [])
    starts = cohort.select(*cols).filter(F.col(start).isNotNull())
    hi = F.col(until) if until else None
    bucket = 24.0 if slice_hours == "auto" else slice_hours
    # a fixed slice is known here; "auto" is left to the window, which looks at the rows
    ev = cohort_window_join(ev, starts, entity, time, [(F.col(start), hi)], bucket,
                            keep_bucket_as=None if slice_hours == "auto" else SLICE).filter(F.col(time) >= F.col(start))
    if until:
        ev = ev.filter(F.col(time) <= F.col(until)).drop(until)
    ev = ev.drop(start)
    ev = with_neighbors(ev, entity, time, tiebreak, [time], prev=False, next=True,
                        slice_hours=slice_hours)
    nxt = F.col(f"next_{time}")
    is_end = nxt.isNull() | _gap_test(whole_hours(time, nxt), gap_hours, strict)
    extra = [F.min(time).alias(first_out)] if first_out else []
    if tiebreak:
        # (time, tiebreak) packed exactly into one decimal(38,0): min_by keeps
        # fixed-width buffers, so the aggregate is a hash aggregate (no sort)
        key = (epoch_micros(time).cast("decimal(38,0)")
               * F.lit(Decimal(10 ** 20)).cast("decimal(38,0)")
               + F.col(tiebreak).cast("decimal(20,0)")
               + F.lit(Decimal(2 ** 63)).cast("decimal(20,0)")).cast("decimal(38,0)")
        key = F.when(is_end, key)
        out = aggregate_split(ev, entity, F.min_by(F.col(time), key).alias("_end"),
                              F.min_by(nxt, key).alias("_next"), *extra)
        end_c, next_c = F.col("_end"), F.col("_next")
    else:
        first_end = F.min(F.when(is_end, F.struct(F.col(time), nxt.alias("_next"))))
        out = aggregate_split(ev, entity, first_end.alias("_s"), *extra)
        end_c, next_c = F.col(f"_s.{time}"), F.col("_s._next")
    return out.select(entity, *([first_out] if first_out else []),
                      end_c.alias(end_out), next_c.alias(next_out))
