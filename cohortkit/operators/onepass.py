"""Several passes over one fact table as one scan, one join and one aggregate."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bands import aggregate_split
from .features import C, E, T, U, V, FeatureSpec, feature_aggregates, feature_columns
from .totals import WindowSpec, bound_columns, sum_aggregates


def fact_pass(cohort: DataFrame, fact: DataFrame, *, features: Sequence[FeatureSpec] = (),
              landmarks: dict[str, str] | None = None, sums: Sequence[WindowSpec] = (),
              latest: str | None = None, feature_gate: Column | None = None,
              sum_gate: Column | None = None, entity: str = E, time: str = T, code: str = C,
              value: str = V, unit: str = U, tiebreak: str | None = None) -> DataFrame:
    """C20/C22, C32 and C49 together: nearest values at landmarks, windowed sums and,
    in column ``latest``, the time of an entity's last row of any code.

    ``cohort`` has one row per entity. ``feature_gate`` and ``sum_gate`` are conditions over
    its columns; where one fails, those columns are null. The result has one row per
    cohort entity that the join leaves rows of: any fact at all with
    ``latest``, else any of the codes asked for. Columns without a qualifying row are null.

    A fact meets its cohort row in one join on the entity; the aggregate has an exchange
    of its own (:func:`aggregate_split`), so a hot entity's facts are partially
    aggregated by as many tasks as adaptive execution cuts them into.
    """
    landmarks = landmarks or {}
    if sum_gate is not None:
        sums = [replace(s, lo=F.when(sum_gate, s.lo), hi=F.when(sum_gate, s.hi)) for s in sums]
    gate = F.lit(True) if feature_gate is None else F.coalesce(feature_gate, F.lit(False))
    coh = cohort.select(entity, gate.alias("_gate"), *dict.fromkeys(landmarks.values()),
                        *bound_columns(sums))
    keep = [entity, time, code, value] + ([unit] if unit in fact.columns else []) \
        + ([tiebreak] if tiebreak else [])
    if latest is None:
        codes = sorted({c for s in (*features, *sums) for c in s.codes}, key=str)
        fact = fact.filter(F.col(code).isin(codes))
    rows = fact.select(*dict.fromkeys(keep)).join(coh, entity, "inner")
    aggs = []
    if features:
        aggs += feature_aggregates(features, landmarks, time=time, code=code, value=value, unit=unit,
                                   tiebreak=tiebreak, gate=F.col("_gate"))[0]
    aggs += sum_aggregates(sums, time=time, code=code, value=value)[0]
    if latest is not None:
        aggs.append(F.max(time).alias(latest))
    out = aggregate_split(rows, entity, *aggs)
    return out.select(entity, *feature_columns(features, landmarks, tiebreak),
                      *[s.name for s in sums], *([latest] if latest is not None else []))
