"""Cohort base rows and landmark detection.

C19 ``base_cohort``, C24 ``condition_flag``, C28 ``paired_within``,
C29 ``not_exposed``, C30 ``eligibility_landmark``, C31 ``terminal_landmark``.

All interval logic (event inside an admission, two signals within a
tolerance, event inside an exposure's lead-in/wash-out) runs through
:mod:`.bands`: the reference's correlated ``NOT EXISTS`` becomes one ordered
sweep, its self-join an ordered sweep that counts, or one band join.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import fixed
from ..functions.text import like_any
from ..functions.timecalc import shift, whole_hours
from .bands import aggregate_split, band_join, cohort_window_join, covered, interval_join
from .ordered import running_sums

E, T, C, V = "person_id", "measurement_datetime", "measurement_concept_id", "value_as_number"
U = "unit_source_value"


def base_cohort(visit: DataFrame, starts: Sequence[str] | None = None, *, entity: str = E,
                start: str = "visit_start_datetime", end: str = "visit_end_datetime"
                ) -> DataFrame:
    """Distinct ``(entity, admission_start, admission_end)``
    for visits with an end, optionally only those starting at ``starts``."""
    v = visit.filter(F.col(end).isNotNull())
    if starts:
        v = v.filter(F.col(start).isin([F.lit(s).cast("timestamp_ntz") for s in starts]))
    return v.select(F.col(entity), F.col(start).alias("admission_start"),
                    F.col(end).alias("admission_end")).distinct()


def condition_flag(cohort: DataFrame, condition: DataFrame, patterns: Sequence[str], *,
                   entity: str = E, start: str = "admission_start",
                   end: str = "admission_end", time: str = "condition_start_datetime",
                   text: str = "condition_source_value", out: str = "admission_has_neuro",
                   bucket_hours: float = 24.0) -> DataFrame:
    """``(entity, out=1)`` for entities with a condition inside the
    admission whose text matches any LIKE pattern (case-sensitive)."""
    hits = condition.filter(like_any(text, patterns)).select(entity, time)
    inside = interval_join(hits, cohort.select(entity, start, end), entity, time,
                           F.col(start), F.col(end), how="left_semi", bucket_hours=bucket_hours)
    return inside.select(entity).distinct().withColumn(out, F.lit(1).cast("long"))


def paired_within(a: DataFrame, b: DataFrame, *, entity: str = E, a_time: str = "a_time",
                  b_time: str = "b_time", tolerance_minutes: float = 30) -> DataFrame:
    """All pairs of an ``a`` and a ``b`` row of one entity with
    ``b_time - tol <= a_time <= b_time + tol``. Column names of ``a`` and
    ``b`` other than the entity must differ. Cells are ``band_hours(tol)`` long."""
    tol = tolerance_minutes / 60.0
    return band_join(a, b, entity, a_time, b_time, tol, tol,
                     bucket_hours=band_hours(tolerance_minutes))


def band_hours(tolerance_minutes: float) -> float:
    """Bucket width for a ±tolerance band: the band's width, at least 1 h."""
    return max(2 * tolerance_minutes / 60.0, 1.0)


def not_exposed(events: DataFrame, exposure: DataFrame, codes: Sequence, *,
                lead_in_hours: float = 6, washout_hours: float = 3, entity: str = E,
                time: str = T, code: str = "drug_concept_id",
                start: str = "drug_exposure_start_datetime",
                end: str = "drug_exposure_end_datetime",
                slice_hours: float = 24.0, open_ended: bool = False) -> DataFrame:
    """Keep events with no exposure of ``codes`` active in
    ``[start - lead_in, end + washout]``. An exposure with a NULL end never
    excludes, as in the reference (R22); with ``open_ended`` it is active
    from its start on.

    ``codes`` may map each code to its own ``(lead_in, washout)`` hours
    (R8). All codes are one sweep over events and exposures (see :mod:`.bands`).
    """
    ex, lo, hi = _exposure_intervals(exposure, codes, lead_in_hours, washout_hours, entity, code,
                                     start, end, open_ended)
    return interval_join(events, ex, entity, time, lo, hi, how="left_anti", bucket_hours=slice_hours)


def _exposure_intervals(exposure: DataFrame, codes: Sequence, lead_in_hours: float, washout_hours: float,
                        entity: str = E, code: str = "drug_concept_id",
                        start: str = "drug_exposure_start_datetime",
                        end: str = "drug_exposure_end_datetime", open_ended: bool = False):
    """The exposures of ``codes``, and the bounds within which each excludes."""
    hours = {c: tuple(v) for c, v in codes.items()} if isinstance(codes, dict) else {
        c: (lead_in_hours, washout_hours) for c in codes}
    ex = exposure.filter(F.col(code).isin(list(hours))).select(entity, code, start, end)
    if len(set(hours.values())) == 1:
        (lead, wash), = set(hours.values())
        lo, hi = shift(start, -lead), shift(end, wash)
    else:
        lo = F.coalesce(*[F.when(F.col(code) == F.lit(c), shift(start, -lead)) for c, (lead, _) in hours.items()])
        hi = F.coalesce(*[F.when(F.col(code) == F.lit(c), shift(end, wash)) for c, (_, wash) in hours.items()])
    if open_ended:
        hi = F.coalesce(hi, F.lit("9999-12-31 23:59:59").cast(exposure.schema[end].dataType))
    return ex, lo, hi


@dataclass(frozen=True)
class EligibilityRule:
    """Criteria of the eligibility landmark (module 2's weaning readiness)."""
    first_code: object = "2000000204"          # FiO2 in the reference
    first_ranges: tuple = ((1, 50), (0, 0.5))  # percent or fraction
    first_unit_not: str | None = "%"
    second_code: object = "3022875"            # PEEP
    second_max: float = 10
    tolerance_minutes: float = 30
    start_offset_hours: float = 6
    exposure_codes: tuple = ("1321341", "753626", "19003953")
    lead_in_hours: float = 6
    washout_hours: float = 3
    median_digits: int = 2
    # Map fractions in [0.1, 1] to percent before the range test
    normalise_first: bool = False
    # R11: 'median' over all qualifying pairs (reference) or 'start': the
    # values of the earliest pair (nearest partner, then earliest)
    value_at: str = "median"
    # 'counts': count each row's partners in one ordered sweep over both signals
    # and take weighted medians; 'pairs': join the signals within the band and take
    # approximate medians over the pairs
    pairing: str = "counts"


def eligibility_landmark(cohort: DataFrame, fact: DataFrame, exposure: DataFrame,
                         rule: EligibilityRule, *, entity: str = E, time: str = T,
                         code: str = C, value: str = V, unit: str = U,
                         episode_start: str = "first_imv_start",
                         episode_end: str = "first_imv_end",
                         admission_start: str = "admission_start") -> DataFrame:
    """First moment both signals meet their thresholds within the
    tolerance of each other, inside the first episode, at least
    ``start_offset_hours`` after admission, with no exposure active.

    Returns ``entity, eligible_start_time, eligible_start_fio2,
    eligible_start_peep``; the two values are lower medians over all qualifying
    pairs (the reference's join fan-out, R11), without forming the pairs.

    Both signals come from one scan of the facts as tagged rows, meet the episodes
    in one join and the exposures in one anti join, and are swept together.
    """
    bounds = (cohort.filter(F.col(episode_end).isNotNull())
                    .select(entity, admission_start, episode_start, episode_end))
    v = F.col(value)
    if rule.normalise_first:
        v = F.when(v.between(0.1, 1), v * 100).otherwise(v)
    is_first = F.col(code) == F.lit(rule.first_code)
    first = is_first & reduce(lambda x, y: x | y, [v.between(lo, hi) for lo, hi in rule.first_ranges])
    if rule.first_unit_not is not None:
        first = first & (F.col(unit) != F.lit(rule.first_unit_not))
    is_second = F.col(code) == F.lit(rule.second_code)
    second = is_second & (F.col(value) <= rule.second_max)
    # a row is tagged with every signal it counts for (codes may be the same)
    tags = F.array_compact(F.array(F.when(first, F.struct(F.lit("a").alias("s"), v.alias("v"))),
                                   F.when(second, F.struct(F.lit("b").alias("s"), F.col(value).alias("v")))))
    rows = (fact.filter(is_first | is_second).filter(first | second)
                .select(entity, F.col(time).alias("_time"), F.explode(tags).alias("_tag"))
                .select(entity, "_time", F.col("_tag.s").alias("_signal"), F.col("_tag.v").alias("_value")))
    rows = cohort_window_join(rows, bounds, entity, "_time", [(F.col(episode_start), F.col(episode_end))])
    rows = rows.filter(F.col("_time").between(F.col(episode_start), F.col(episode_end))
                       & ((F.col("_signal") == "b")
                          | (F.col("_time") >= shift(admission_start, rule.start_offset_hours))))
    # distinct rows and how often each occurs: also the one scan and exchange that
    # the sides of both sweeps below share
    rows = aggregate_split(rows, [entity, "_signal", "_time", "_value"], F.count(F.lit(1)).alias("_n"))
    # exposures exclude rows of the first signal only
    ex, lo, hi = _exposure_intervals(exposure, list(rule.exposure_codes), rule.lead_in_hours,
                                     rule.washout_hours, entity)
    rows = covered(rows, ex, entity, "_time", lo, hi)
    rows = rows.filter((F.col("_signal") == "b") | ~F.col("_covered")).drop("_covered")
    if rule.pairing == "counts" and rule.value_at == "median":
        return _eligibility_by_counts(rows, entity, rule)

    every = rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))

    def signal(name: str) -> DataFrame:
        return every.filter(F.col("_signal") == name).select(
            entity, F.col("_time").alias(f"{name}_time"), F.col("_value").alias(f"{name}_value"))

    pairs = paired_within(signal("a"), signal("b"), entity=entity, tolerance_minutes=rule.tolerance_minutes)
    if rule.value_at == "start":
        gap = F.abs(F.timestamp_diff("SECOND", F.col("a_time"), F.col("b_time")))
        earliest = F.min(F.struct("a_time", gap.alias("gap"), "b_time", "a_value", "b_value"))
        return aggregate_split(pairs, entity, earliest.alias("_p")).select(
            entity, F.col("_p.a_time").alias("eligible_start_time"),
            fixed(F.col("_p.a_value"), rule.median_digits).alias("eligible_start_fio2"),
            fixed(F.col("_p.b_value"), rule.median_digits).alias("eligible_start_peep"))
    med = lambda c: fixed(F.percentile_approx(F.col(c), 0.5, 10000), rule.median_digits)  # noqa
    return aggregate_split(pairs, entity,
                           F.min("a_time").alias("eligible_start_time"),
                           med("a_value").alias("eligible_start_fio2"),
                           med("b_value").alias("eligible_start_peep"))


def partner_pairs(rows: DataFrame, entity: str, tolerance_hours: float,
                  slice_hours: float | str = 24.0) -> DataFrame:
    """``rows`` (entity, ``_signal`` a or b, ``_time``, ``_value``: distinct, and ``_n``,
    how often each occurs) with ``_pairs``: how many pairs they form with rows of
    the other signal within the tolerance of them. No pair is formed.

    Every row enters one time-ordered stream three times: as itself, and as two
    queries, at its time less the tolerance (before others of that instant) and
    plus the tolerance (after them). Running counts of both signals' rows over the
    stream, sliced as in :mod:`.ordered`, answer all queries; a row's partners are
    the difference of its two.
    """
    own = [entity, "_signal", "_time", "_value"]
    counts = lambda s: F.when(F.col("_signal") == s, F.col("_n")).otherwise(0).cast("long")
    none = F.lit(0).cast("long")
    entry = lambda at, place, a, b: F.struct(
        at.alias("t"), F.lit(place).alias("place"), a.alias("a"), b.alias("b"))
    entries = F.array(entry(shift("_time", -tolerance_hours), 0, none, none),
                      entry(F.col("_time"), 1, counts("a"), counts("b")),
                      entry(shift("_time", tolerance_hours), 2, none, none))
    stream = rows.select(*own, "_n", F.explode(entries).alias("_e")).select(
        *own, "_n", F.col("_e.t").alias("_t"), F.col("_e.place").alias("_place"),
        F.col("_e.a").alias("_a"), F.col("_e.b").alias("_b"))
    cum = running_sums(stream, entity, "_t", "_place", {"_ca": "_a", "_cb": "_b"}, slice_hours=slice_hours)
    others = F.when(F.col("_signal") == "a", F.col("_cb")).otherwise(F.col("_ca"))
    sign = F.col("_place") - 1
    return aggregate_split(cum.filter(sign != 0), own, (F.sum(sign * others) * F.max("_n")).alias("_pairs"))


def _eligibility_by_counts(rows: DataFrame, entity: str, rule: EligibilityRule) -> DataFrame:
    """C30 without pairs: the earliest first-signal row with a partner, and the
    lower medians (``quantile_disc(0.5)``, exact) of both signals' values, each as
    often as it is in a pair.

    Weights are summed per (entity, signal, value) before anything is ordered, so
    the window over a signal's values has one row per distinct value.
    """
    paired = partner_pairs(rows, entity, rule.tolerance_minutes / 60.0).filter(F.col("_pairs") > 0)
    values = paired.groupBy(entity, "_signal", "_value").agg(
        F.sum("_pairs").alias("_w"), F.min("_time").alias("_first"))
    signal = Window.partitionBy(entity, "_signal")
    upto = F.sum("_w").over(signal.orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    values = values.select(entity, "_signal", "_value", "_w", upto.alias("_upto"), F.sum("_w").over(signal).alias("_all"),
                           F.min("_first").over(signal).alias("_first"))
    # the smallest value whose running weight exceeds k
    k = F.floor((F.col("_all") - 1) / 2)
    medians = values.filter((F.col("_upto") > k) & (F.col("_upto") - F.col("_w") <= k))
    of = lambda s, c: F.max(F.when(F.col("_signal") == s, F.col(c)))
    return medians.groupBy(entity).agg(
        of("a", "_first").alias("eligible_start_time"),
        fixed(of("a", "_value"), rule.median_digits).alias("eligible_start_fio2"),
        fixed(of("b", "_value"), rule.median_digits).alias("eligible_start_peep"))


def terminal_landmark(df: DataFrame, *, death_guard_hours: float = 12,
                      episode_end: str = "first_imv_end",
                      eligible: str = "eligible_start_time",
                      died: str = "died_ts", flag: str = "admission_has_neuro") -> DataFrame:
    """``first_weaning`` = end of the first episode when eligible, not
    dead within ``death_guard_hours`` whole hours of it and not flagged;
    plus ``duration_eligible_to_weaning`` in whole hours."""
    ok = (F.col(episode_end).isNotNull() & F.col(eligible).isNotNull()
          & (F.col(died).isNull()
             | (whole_hours(episode_end, died) >= death_guard_hours))
          & (F.col(flag) == 0))
    dur = F.when(F.col(episode_end).isNotNull() & F.col(eligible).isNotNull(),
                 whole_hours(eligible, episode_end))
    return df.withColumns({
        "first_weaning": F.when(ok, F.col(episode_end)),
        "duration_eligible_to_weaning": dur,
    })


def landmark_gap_summary(df: DataFrame, gap: str = "duration_eligible_to_weaning",
                         landmark: str = "first_weaning") -> DataFrame:
    """C31 check: distribution of the eligibility-to-landmark gap."""
    rows = df.filter(F.col(landmark).isNotNull())
    return rows.agg(F.count(F.lit(1)).alias("patients_with_weaning"),
                    fixed(F.avg(F.col(gap).cast("decimal(38,9)")), 1).alias("mean_gap_h"),
                    F.min(gap).alias("min_gap_h"), F.max(gap).alias("max_gap_h"),
                    F.count_if(F.col(gap) < 0).alias("impossible_negative_gaps"))

