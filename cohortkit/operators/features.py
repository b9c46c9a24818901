"""Nearest-measurement features at landmarks, unit repair and slopes.

C20 ``nearest_at_landmark``, C21 unit rules (``FeatureSpec``),
C22 ``extract_features`` (fused), C23 ``landmark_slope``.

The reference picks the nearest row with ``QUALIFY ROW_NUMBER() OVER
(PARTITION BY person ORDER BY ABS(hours)) = 1``, one UPDATE per feature and
landmark (28 passes). Here the nearest row is a ``min`` over a struct whose
leading fields are the distance (whole hours, then seconds, then time and
event id as deterministic tie-breaks, R12): an aggregate with map-side
partials instead of a per-entity window, so a hot entity is reduced before
the shuffle. ``extract_features`` computes every (feature, landmark) pair
in one scan and one aggregation.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import DIVIDEND, exact_div, fixed
from ..functions.timecalc import seconds_between, shift, whole_hours, whole_minutes
from .bands import aggregate_split, cohort_window_join

E, T, C, V = "person_id", "measurement_datetime", "measurement_concept_id", "value_as_number"
U = "unit_source_value"


@dataclass(frozen=True)
class FeatureSpec:
    """One variable: codes, window around the landmark, value and unit rules.

    ``value_range`` filters the raw value; ``fraction_to_percent`` maps raw
    values in [0.1, 1] to percent; ``unit_equals`` / ``unit_not`` keep or
    drop a unit (a NULL unit fails both, as in SQL).
    """
    name: str
    codes: tuple
    before_hours: float
    after_hours: float = 0.0
    value_range: tuple | None = None
    fraction_to_percent: bool = False
    unit_equals: str | None = None
    unit_not: str | None = None
    digits: int = 4


def rule_filter(spec: FeatureSpec, value: str = V, unit: str = U) -> Column:
    """The row-level value/unit predicate of a feature."""
    conds = [F.lit(True)]
    if spec.value_range is not None:
        conds.append(F.col(value).between(*spec.value_range))
    if spec.unit_equals is not None:
        conds.append(F.col(unit) == F.lit(spec.unit_equals))
    if spec.unit_not is not None:
        conds.append(F.col(unit) != F.lit(spec.unit_not))
    return reduce(lambda a, b: a & b, conds)


def rule_value(spec: FeatureSpec, value: str = V) -> Column:
    """The repaired value (fraction to percent when asked)."""
    v = F.col(value)
    if spec.fraction_to_percent:
        return F.when(v.between(0.1, 1), v * 100).otherwise(v)
    return v


def unit_normalise(fact: DataFrame, spec: FeatureSpec, *, code: str = C, value: str = V,
                   unit: str = U, out: str = "normalised_value") -> DataFrame:
    """C21 on its own: rows of the feature's codes passing the rules, with
    the repaired value."""
    return (fact.filter(F.col(code).isin(list(spec.codes)) & rule_filter(spec, value, unit))
                .withColumn(out, rule_value(spec, value)))


def _window(spec: FeatureSpec, landmark: str, time: str) -> Column:
    return F.col(time).between(shift(landmark, -spec.before_hours),
                               shift(landmark, spec.after_hours))


def nearest_key(landmark: str, time: str, tiebreak: str | None = None) -> Column:
    """One ``decimal(38,0)`` that orders rows by (whole hours to the landmark,
    whole seconds, time, tiebreak) exactly, so ``min_by(x, key)`` picks the
    nearest row with fixed-width buffers (hash aggregation, no sort).

    Whole hours are a monotone function of whole seconds, so the seconds
    lead. Given the seconds, a row's time is fixed by its side of the
    landmark and its sub-second part: earlier side first, then the
    sub-second part encoded so that a larger key means a later time. The
    (integral) tiebreak fills the last 20 digits.
    """
    d = F.timestamp_diff("MICROSECOND", F.col(landmark), F.col(time))   # time - landmark
    ad = F.abs(d)
    secs = F.floor(ad / F.lit(1_000_000)).cast("long")
    frac = ad % F.lit(1_000_000)
    before = d <= 0
    enc = F.when(before, F.lit(999_999) - frac).otherwise(frac)
    key = (secs * F.lit(2_000_000) + F.when(before, 0).otherwise(1_000_000) + enc)
    key = key.cast("decimal(38,0)")
    if tiebreak:
        shifted = (F.col(tiebreak).cast("decimal(20,0)")
                   + F.lit(Decimal(2 ** 63)).cast("decimal(20,0)"))
        key = (key * F.lit(Decimal(10 ** 20)).cast("decimal(38,0)") + shifted)
        key = key.cast("decimal(38,0)")
    return key


def _nearest_struct(spec: FeatureSpec, landmark: str, time: str, value: str,
                    tiebreak: str | None) -> Column:
    dist_h = F.abs(whole_hours(time, landmark))
    dist_s = F.abs(seconds_between(time, landmark))
    parts = [dist_h.alias("h"), dist_s.alias("s"), F.col(time).alias("t")]
    if tiebreak:
        parts.append(F.col(tiebreak).alias("id"))
    parts.append(rule_value(spec, value).alias("v"))
    return F.struct(*parts)


def nearest_at_landmark(cohort: DataFrame, fact: DataFrame, spec: FeatureSpec,
                        landmark: str, *, suffix: str | None = None, entity: str = E,
                        time: str = T, code: str = C, value: str = V, unit: str = U,
                        tiebreak: str | None = None,
                        cohort_filter: Column | None = None,
                        bucket_hours: float = 24.0) -> DataFrame:
    """C20: per cohort entity the feature's row nearest to ``landmark``.

    Returns ``entity, <f>_at_<s>, <f>_at_<s>_time, <f>_at_<s>_minutes``
    (value rounded to ``spec.digits`` as NUMERIC; minutes from the row to
    the landmark). Entities without a qualifying row are absent, so a keyed
    update leaves them untouched.
    """
    s = suffix or landmark
    cols = [entity, landmark]
    coh = cohort if cohort_filter is None else cohort.filter(cohort_filter)
    coh = coh.select(*cols).filter(F.col(landmark).isNotNull())
    keep = [entity, time, value] + ([unit] if unit in fact.columns else []) \
        + ([tiebreak] if tiebreak else [])
    facts = (fact.filter(F.col(code).isin(list(spec.codes)))
                 .select(*dict.fromkeys(keep))
                 .filter(rule_filter(spec, value, unit)))
    win = (shift(landmark, -spec.before_hours), shift(landmark, spec.after_hours))
    rows = (cohort_window_join(facts, coh, entity, time, [win], bucket_hours)
            .filter(_window(spec, landmark, time)))
    lm = F.max(landmark).alias("_lm")
    if tiebreak:
        key = nearest_key(landmark, time, tiebreak)
        out = aggregate_split(rows, entity, F.min_by(rule_value(spec, value), key).alias("_v"),
                              F.min_by(F.col(time), key).alias("_t"), lm)
        v, t = F.col("_v"), F.col("_t")
    else:
        best = F.min(_nearest_struct(spec, landmark, time, value, tiebreak)).alias("_b")
        out = aggregate_split(rows, entity, best, lm)
        v, t = F.col("_b.v"), F.col("_b.t")
    col = f"{spec.name}_at_{s}"
    return out.select(entity, fixed(v, spec.digits).alias(col), t.alias(f"{col}_time"),
                      whole_minutes(t, F.col("_lm")).alias(f"{col}_minutes"))


def feature_windows(specs: Sequence[FeatureSpec], landmarks: dict[str, str],
                    gate: Column | None = None) -> list[tuple[Column, Column]]:
    """The time windows around each landmark that any feature can use (for
    ``cohort_window_join``); NULL (no window) where ``gate`` fails."""
    before = max(s.before_hours for s in specs)
    after = max(s.after_hours for s in specs)
    wins = []
    for lm in dict.fromkeys(landmarks.values()):
        lo, hi = shift(lm, -before), shift(lm, after)
        if gate is not None:
            lo, hi = F.when(gate, lo), F.when(gate, hi)
        wins.append((lo, hi))
    return wins


def feature_aggregates(specs: Sequence[FeatureSpec], landmarks: dict[str, str], *,
                       time: str = T, code: str = C, value: str = V, unit: str = U,
                       tiebreak: str | None = None, gate: Column | None = None
                       ) -> tuple[list[Column], list[Column]]:
    """Per (feature, landmark): ``min(CASE WHEN cond THEN struct(distance...,
    value) END)`` and its row condition ``cond``."""
    aggs, conds = [], []
    for spec in specs:
        base = F.col(code).isin(list(spec.codes)) & rule_filter(spec, value, unit)
        if gate is not None:
            base = base & gate
        for sfx, lm in landmarks.items():
            cond = base & F.col(lm).isNotNull() & _window(spec, lm, time)
            conds.append(cond)
            a = f"_{spec.name}__{sfx}"
            if tiebreak:
                # hash-aggregatable: min_by over one exact decimal ordering key
                key = F.when(cond, nearest_key(lm, time, tiebreak))
                aggs += [F.min_by(rule_value(spec, value), key).alias(f"{a}_v"),
                         F.min_by(F.col(time), key).alias(f"{a}_t")]
            else:
                st = _nearest_struct(spec, lm, time, value, tiebreak)
                aggs.append(F.min(F.when(cond, st)).alias(a))
    return aggs, conds


def feature_columns(specs: Sequence[FeatureSpec], landmarks: dict[str, str],
                    tiebreak: str | None = None) -> list[Column]:
    """Value (rounded NUMERIC) and time columns from ``feature_aggregates``."""
    out = []
    for spec in specs:
        for sfx in landmarks:
            a = f"_{spec.name}__{sfx}"
            col = f"{spec.name}_at_{sfx}"
            v, t = ((F.col(f"{a}_v"), F.col(f"{a}_t")) if tiebreak
                    else (F.col(f"{a}.v"), F.col(f"{a}.t")))
            out += [fixed(v, spec.digits).alias(col), t.alias(f"{col}_time")]
    return out


def extract_features(cohort: DataFrame, fact: DataFrame, specs: Sequence[FeatureSpec],
                     landmarks: dict[str, str], *, entity: str = E, time: str = T,
                     code: str = C, value: str = V, unit: str = U,
                     tiebreak: str | None = None,
                     cohort_filter: Column | None = None,
                     bucket_hours: float = 24.0) -> DataFrame:
    """Every feature at every landmark in one scan and one aggregate.

    ``landmarks`` maps suffix -> landmark column. For each (feature,
    landmark) the aggregate is ``min(CASE WHEN rule AND window THEN
    struct(distance..., value) END)``. The result has one row per cohort
    entity with at least one qualifying row, and two columns per pair.

    Facts meet the cohort through ``cohort_window_join``, one join on the
    entity. The minima are partially aggregated before they are shuffled
    (``aggregate_split``), also where adaptive execution splits the facts of a hot
    entity over several tasks.
    """
    coh = cohort if cohort_filter is None else cohort.filter(cohort_filter)
    lm_cols = list(dict.fromkeys(landmarks.values()))
    coh = coh.select(entity, *lm_cols)
    codes = sorted({c for s in specs for c in s.codes}, key=str)
    keep = [entity, time, code, value] + ([unit] if unit in fact.columns else []) \
        + ([tiebreak] if tiebreak else [])
    facts = fact.filter(F.col(code).isin(codes)).select(*dict.fromkeys(keep))
    rows = cohort_window_join(facts, coh, entity, time, feature_windows(specs, landmarks),
                              bucket_hours)
    aggs, conds = feature_aggregates(specs, landmarks, time=time, code=code, value=value,
                                     unit=unit, tiebreak=tiebreak)
    rows = rows.filter(reduce(lambda a, b: a | b, conds))
    g = aggregate_split(rows, entity, *aggs)
    return g.select(F.col(entity), *feature_columns(specs, landmarks, tiebreak))


def slope_column(feature: str, a: str, b: str, min_hours: float = 4) -> Column:
    """C23 as a column: ``(value_b - value_a) / whole hours between their
    measurement times`` when those hours exceed ``min_hours`` (R6), else NULL.

    Exact NUMERIC division rounded half-up to 9 decimals, like the
    reference's NUMERIC arithmetic.
    """
    va, vb = f"{feature}_at_{a}", f"{feature}_at_{b}"
    hrs = whole_hours(f"{va}_time", f"{vb}_time")
    slope = exact_div(F.col(vb).cast(DIVIDEND) - F.col(va).cast(DIVIDEND), hrs, 9)
    return F.when(hrs > min_hours, slope)


def landmark_slope(df: DataFrame, feature: str, a: str, b: str, *,
                   min_hours: float = 4, out: str | None = None) -> DataFrame:
    """Add ``<feature>_slope`` (see ``slope_column``)."""
    return df.withColumn(out or f"{feature}_slope", slope_column(feature, a, b, min_hours))


def landmark_slopes(df: DataFrame, features: Sequence[str], a: str, b: str, *,
                    min_hours: float = 4) -> DataFrame:
    """C23 for several features in one projection."""
    return df.withColumns({f"{f}_slope": slope_column(f, a, b, min_hours) for f in features})
