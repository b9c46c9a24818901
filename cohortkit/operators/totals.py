"""Windowed sums, code-set audit, balances, rate slopes, histogram.

C32 ``window_sum`` / ``window_sums`` (fused), C33 zero-filled sums,
C34 ``code_set_audit``, C35 ``balance``, C36 ``rate_slopes``,
C37 ``summary``, C38 ``histogram``.

The reference runs one UPDATE per (period, intake/output): six scans of
the measurement table. ``window_sums`` joins the cohort's period bounds to
the facts once and computes every period as a conditional ``sum`` in one
aggregate. Sums are taken over NUMERIC (exact), then rounded to 2 digits.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.numeric import NUMERIC, fixed, numeric, safe_ratio
from .bands import aggregate_split, cohort_window_join

E, T, C, V = "person_id", "measurement_datetime", "measurement_concept_id", "value_as_number"


@dataclass(frozen=True)
class WindowSpec:
    """A named sum: values of ``codes`` with ``lo <= time <= hi``.

    ``closed='left'`` makes it ``lo <= time < hi`` so that adjacent periods
    sharing a boundary do not both count an event on it (R14); the default
    keeps the reference's closed ``BETWEEN``.
    """
    name: str
    codes: tuple
    lo: Column
    hi: Column
    closed: str = "both"

    def contains(self, time: Column, lo: Column, hi: Column) -> Column:
        if self.closed == "left":
            return (time >= lo) & (time < hi)
        return time.between(lo, hi)


def bound_columns(specs: Sequence[WindowSpec]) -> list[Column]:
    """The periods' bounds as named cohort columns ``_lo_i`` / ``_hi_i``."""
    return ([s.lo.alias(f"_lo_{i}") for i, s in enumerate(specs)]
            + [s.hi.alias(f"_hi_{i}") for i, s in enumerate(specs)])


def sum_aggregates(specs: Sequence[WindowSpec], *, time: str = T, code: str = C,
                   value: str = V, digits: int = 2) -> tuple[list[Column], list[Column]]:
    """Per period: exact ``sum`` of the values inside it (rounded) and its row
    condition, over rows carrying ``bound_columns``."""
    conds = [F.col(code).isin(list(s.codes))
             & s.contains(F.col(time), F.col(f"_lo_{i}"), F.col(f"_hi_{i}"))
             for i, s in enumerate(specs)]
    aggs = [fixed(F.sum(F.when(c, numeric(value))), digits).alias(s.name)
            for c, s in zip(conds, specs)]
    return aggs, conds


def window_sums(cohort: DataFrame, fact: DataFrame, specs: Sequence[WindowSpec], *,
                entity: str = E, time: str = T, code: str = C, value: str = V,
                digits: int = 2, cohort_filter: Column | None = None,
                bucket_hours: float = 24.0) -> DataFrame:
    """C32 fused: one row per cohort entity with any qualifying event; one
    column per spec, NULL when no event of that spec qualified.

    ``lo``/``hi`` are expressions over cohort columns. The cohort has one row
    per entity; facts meet it through ``cohort_window_join``, each at most once,
    and are partially summed before they are shuffled (``aggregate_split``).
    """
    coh = cohort if cohort_filter is None else cohort.filter(cohort_filter)
    bounds = coh.select(entity, *bound_columns(specs))
    codes = sorted({c for s in specs for c in s.codes}, key=str)
    facts = fact.filter(F.col(code).isin(codes)).select(entity, time, code, value)
    wins = [(F.col(f"_lo_{i}"), F.col(f"_hi_{i}")) for i in range(len(specs))]
    rows = cohort_window_join(facts, bounds, entity, time, wins, bucket_hours)
    aggs, conds = sum_aggregates(specs, time=time, code=code, value=value, digits=digits)
    rows = rows.filter(reduce(lambda a, b: a | b, conds))
    return aggregate_split(rows, entity, *aggs)


def window_sum(cohort: DataFrame, fact: DataFrame, codes: Sequence, lo: Column, hi: Column,
               out: str = "value", **kw) -> DataFrame:
    """Sum of ``codes`` values inside ``[lo, hi]`` per entity."""
    return window_sums(cohort, fact, [WindowSpec(out, tuple(codes), lo, hi)], **kw)


def code_set_frame(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """A code set: ``(code, role, status, reason)`` rows, e.g. intake/use."""
    return spark.createDataFrame(list(rows), "code string, role string, status string, "
                                             "reason string")


def codes_of(code_set: Sequence[tuple], role: str, status: str = "use") -> tuple:
    return tuple(c for c, r, s, _ in code_set if r == role and s == status)


def code_set_audit(fact: DataFrame, code_set: DataFrame, *, entity: str = E, code: str = C,
                   value: str = V, codes: Sequence | None = None) -> DataFrame:
    """Rows, entities and summed value each listed code contributes,
    with its role, status and reason.

    The code set is a list of codes (bounded by its length), broadcast into
    the join; the fact is aggregated by code. ``codes`` are the listed codes,
    if the caller has them at hand: the filter then reaches the fact's scan.
    """
    cs = F.broadcast(code_set)
    if codes is not None:
        fact = fact.filter(F.col(code).isin(list(dict.fromkeys(codes))))
    j = fact.select(entity, code, value).join(cs, fact[code] == cs["code"], "inner")
    return (j.groupBy("code", "role", "status", "reason")
             .agg(F.count(F.lit(1)).alias("row_count"),
                  F.count_distinct(entity).alias("patient_count"),
                  fixed(F.sum(numeric(value)), 2).alias("total_value"))
             .orderBy("role", "status", "code"))


def balance(df: DataFrame, periods: Sequence[str], *, intake: str = "fluid_intake_{}",
            output: str = "fluid_output_{}", out: str = "fluid_balance_{}",
            where: Column | None = None) -> DataFrame:
    """Intake - output per period (NULL if either is NULL)."""
    cols = {}
    for p in periods:
        v = (numeric(intake.format(p)) - numeric(output.format(p))).cast(NUMERIC)
        cols[out.format(p)] = v if where is None else F.when(where, v)
    return df.withColumns(cols)


def rate_slopes(df: DataFrame, items: Sequence[tuple[str, str]], digits: int = 4,
                where: Column | None = None) -> DataFrame:
    """``ROUND(total / NULLIF(hours, 0), digits)`` for (total, hours)
    pairs, written as ``<total>_slope``; NULL where ``where`` fails."""
    cols = {}
    for total, hrs in items:
        v = safe_ratio(total, hrs, digits)
        cols[f"{total}_slope"] = v if where is None else F.when(where, v)
    return df.withColumns(cols)


def summary(df: DataFrame, exprs: dict[str, Column], where: Column | None = None) -> DataFrame:
    """One-row sanity summary of named aggregate expressions."""
    d = df if where is None else df.filter(where)
    return d.agg(*[e.alias(n) for n, e in exprs.items()])


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Counts of non-NULL values in ``[lo, hi]`` over ``bins`` equal
    bins (the top edge belongs to the last bin, like numpy), plus the mean
    of the plotted values on every row.

    The mean comes from per-bin exact sums through a window over the grouped
    result (at most ``bins`` rows).
    """
    x = F.col(col)
    d = df.filter(x.isNotNull() & x.between(lo, hi))
    width = (hi - lo) / bins
    b = F.least(F.floor((x.cast("double") - F.lit(lo)) / F.lit(width)), F.lit(bins - 1))
    counts = d.groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"),
                                                     F.sum(numeric(col)).alias("_s"))
    every = Window.partitionBy()
    mean = safe_ratio(F.sum("_s").over(every), F.sum("n").over(every), 6)
    return (counts.select("bin",
                          (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
                          (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
                          "n", mean.alias("mean_value"))
                  .orderBy("bin"))
