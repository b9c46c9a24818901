"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` each.

Each entry binds the driver's test tables (``cohortkit.sources.bindings``)
to one operator of the inventory and runs it over the whole tables.
"""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import episodes, explore, onepass, quality
from ..operators import features as feat
from ..operators import landmarks as lmk
from ..operators import outcomes as outc
from ..operators import totals as tot
from ..operators.features import FeatureSpec
from ..operators.landmarks import EligibilityRule
from ..operators.quantiles import quantiles, side_by_side
from ..sources import bindings as B
from ..session import app_key, materialize
from ..sources import tables
from . import catalogue
from . import weaning as W
from .widetable import CatalogTable, assemble, update_from, update_where

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return deco


# Event types standing in for the ventilation concept ids of the episode search.
EPISODE_CODES = ["view", "click", "purchase"]


@register("gap_episodes")
def q_gap_episodes(spark, sf_dir):
    m = B.measurement(spark, sf_dir)
    return episodes.gap_episodes(m, EPISODE_CODES, gap_hours=24, min_hours=48,
                                 tiebreak="measurement_id")


# ---------------------------------------------------------------------------
# catalogue and exploration
# ---------------------------------------------------------------------------


# Parameters of the exploration queries (the analyst's inputs).
SEARCH_TERM = "ring"
CANDIDATE_IDS = [0, 1, 2, 10, 100, 1000]
SPOT_CONCEPT = 1
SYNONYM_TERM = "widget"
CO_IDS = [1, 2]
VARIABLE_TERMS = {"measurement": ["ring", "gear", "plate"],
                  "drug_exposure": ["build", "furn"],
                  "observation": ["view", "click"]}
VARIABLE_MIN_ENTITIES = 20
TEMPORAL_STATUS = "F"


@register("dataset_profile")
def q_dataset_profile(spark, sf_dir):
    return tables.dataset_profile(spark, sf_dir)


@register("column_profile")
def q_column_profile(spark, sf_dir):
    return tables.column_profile(spark, tables.read_table(spark, sf_dir, "events"))


@register("table_population")
def q_table_population(spark, sf_dir):
    return explore.table_population(B.measurement(spark, sf_dir))


@register("concept_search")
def q_concept_search(spark, sf_dir):
    return explore.concept_search(B.concept(spark, sf_dir), SEARCH_TERM, limit=100)


@register("concept_cross_reference")
def q_concept_cross_reference(spark, sf_dir):
    return explore.concept_cross_reference(B.line_fact(spark, sf_dir),
                                           B.concept(spark, sf_dir), CANDIDATE_IDS)


@register("top_measured")
def q_top_measured(spark, sf_dir):
    return explore.top_measured(B.line_fact(spark, sf_dir), B.concept(spark, sf_dir), k=50)


@register("spot_check")
def q_spot_check(spark, sf_dir):
    return explore.spot_check(B.line_fact(spark, sf_dir), B.concept(spark, sf_dir),
                              SPOT_CONCEPT, n_entities=10, limit=200)


@register("describe_values")
def q_describe_values(spark, sf_dir):
    # the spot check is at most 200 rows
    return explore.describe_values(q_spot_check(spark, sf_dir), "value_as_number", bounded=True)


@register("describe_measurements")
def q_describe_measurements(spark, sf_dir):
    """C5 / A17 over the whole fact: per code the description of its values."""
    return explore.describe_values(B.measurement(spark, sf_dir), "value_as_number",
                                   by=["measurement_concept_id"])


@register("spot_check_units")
def q_spot_check_units(spark, sf_dir):
    return explore.distinct_units(q_spot_check(spark, sf_dir))


@register("synonym_hunt")
def q_synonym_hunt(spark, sf_dir):
    return explore.synonym_hunt(B.line_fact(spark, sf_dir), B.concept(spark, sf_dir),
                                SYNONYM_TERM)


@register("co_occurrence_all")
def q_co_occurrence_all(spark, sf_dir):
    return explore.co_occurrence_all(B.line_fact(spark, sf_dir), CO_IDS)


@register("co_occurrence_compare")
def q_co_occurrence_compare(spark, sf_dir):
    return explore.co_occurrence_compare(B.line_fact(spark, sf_dir), CO_IDS[0], CO_IDS)


@register("variable_search")
def q_variable_search(spark, sf_dir):
    meas = B.line_fact(spark, sf_dir)
    drugs = B.order_fact(spark, sf_dir)
    obs = B.measurement(spark, sf_dir)
    sources = [
        explore.SearchSource("measurement", meas, VARIABLE_TERMS["measurement"],
                             concept_id="measurement_concept_id", with_rows=True,
                             names=B.concept(spark, sf_dir)),
        explore.SearchSource("drug_exposure", drugs, VARIABLE_TERMS["drug_exposure"],
                             concept_id="concept_name"),
        explore.SearchSource("observation", obs, VARIABLE_TERMS["observation"],
                             concept_id="measurement_concept_id",
                             concept_name="measurement_concept_id"),
    ]
    return explore.variable_search(sources, min_entities=VARIABLE_MIN_ENTITIES, k=20)


@register("population_rate")
def q_population_rate(spark, sf_dir):
    return explore.population_rate(B.measurement(spark, sf_dir), "visit_occurrence_id", 90)


@register("visit_types")
def q_visit_types(spark, sf_dir):
    return explore.visit_types(B.visits_many(spark, sf_dir), B.visit_concept(spark))


def _orders(spark, sf_dir):
    o = tables.read_table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("person_id"),
                    F.col("o_orderdate").alias("measurement_datetime"),
                    F.col("o_orderstatus").alias("measurement_concept_id"))


@register("temporal_distribution")
def q_temporal_distribution(spark, sf_dir):
    return explore.temporal_distribution(_orders(spark, sf_dir), TEMPORAL_STATUS)


@register("yearly_duplicates")
def q_yearly_duplicates(spark, sf_dir):
    visits = _orders(spark, sf_dir).select(
        "person_id", F.col("measurement_datetime").alias("visit_start_datetime"))
    return explore.yearly_duplicates(visits)


# ---------------------------------------------------------------------------
# episodes, landmarks, features, totals, outcomes: the weaning cohort
# (C10-C11, C13, C19-C41) on the events binding
# ---------------------------------------------------------------------------


# Parameters of the weaning cohort on the events binding (FIXTURES.md §4):
# 'view'/'click' stand for FiO2/PEEP, 'purchase' is the exposure and the
# intake, 'signup'/'error' are outputs.
TEST_RULE = EligibilityRule(
    first_code="view", first_ranges=((1, 50), (0, 0.5)), first_unit_not="%",
    second_code="click", second_max=60, tolerance_minutes=720, start_offset_hours=6,
    exposure_codes=B.EXPOSURE_KINDS, lead_in_hours=6, washout_hours=3)
TEST_FEATURES = (
    FeatureSpec("fio2", ("view",), 24, 0, value_range=(0.1, 100), fraction_to_percent=True,
                unit_not="%"),
    FeatureSpec("peep", ("click",), 24, 0),
    FeatureSpec("spo2", ("signup", "purchase"), 24, 24, fraction_to_percent=True),
    FeatureSpec("haemoglobin", ("error",), 24, 24, unit_equals="u"),
    FeatureSpec("haematocrit", ("view", "signup"), 24, 24, value_range=(0.1, 1)),
    FeatureSpec("lactate", ("purchase",), 48, 48),
)
TEST_CODE_SET = (
    ("purchase", "intake", "use", "incremental"),
    ("signup", "output", "use", "incremental"),
    ("error", "output", "use", "incremental"),
    ("click", "output", "exclude", "moving window"),
    ("view", "output", "exclude", "cumulative"),
)
EXCLUDED_CONDITIONS = ("%: 42}%",)   # flags about a tenth of the admissions
TEST_PARAMS = W.WeaningParams(
    segment_codes=("view", "click"), segment_gap_hours=36, rule=TEST_RULE,
    condition_patterns=EXCLUDED_CONDITIONS,
    death_guard_hours=12, min_duration_hours=24, horizon_hours=72,
    features=TEST_FEATURES, intake_codes=tot.codes_of(TEST_CODE_SET, "intake"),
    output_codes=tot.codes_of(TEST_CODE_SET, "output"), slope_min_hours=4,
    tiebreak="measurement_id")
CONDITION_PATTERNS = ("%: 7%", "%: 42}%", "%: 13}%")
COHORT_STARTS = ("2024-01-05", "2024-01-17")

_CHAINS: dict = {}
_LOCK = threading.RLock()   # one computation per (application, dataset)
COHORT_TABLES = ("events",)   # what the cohort's inputs are bound to


def weaning_inputs(spark, sf_dir) -> W.WeaningInputs:
    return W.WeaningInputs(
        visit=B.visit_per_entity(spark, sf_dir), measurement=B.measurement(spark, sf_dir),
        drug_exposure=B.drug_exposure(spark, sf_dir, null_ends=True, kinds=B.EXPOSURE_KINDS),
        condition=B.condition_occurrence(spark, sf_dir), death=B.death(spark, sf_dir))


def _chain(spark, sf_dir, stage: int):
    """The checkpointed base chain (stage 1: episode, 2: landmarks+outcomes),
    computed once per application and dataset, and again when its tables change."""
    key, version = (app_key(spark), sf_dir), tables.dataset_version(spark, sf_dir, COHORT_TABLES)
    with _LOCK:
        if key not in _CHAINS or _CHAINS[key][0] != version:
            inp = weaning_inputs(spark, sf_dir)
            c1 = W.episode_chain(inp, TEST_PARAMS)
            c2 = W.landmark_chain(c1, inp, TEST_PARAMS)
            _CHAINS[key] = (version, inp, c1, c2)
        _, inp, c1, c2 = _CHAINS[key]
    return inp, (c1 if stage == 1 else c2)


_WIDE: dict = {}


def weaning_wide(spark, sf_dir):
    """The assembled cohort table, stored once per application and version of the dataset.

    As in the schema-first pattern, the checks and reports (``check_*``,
    ``table_status``, ``feature_matrix``, the summaries) query the stored
    table instead of recomputing the feature and fluid passes each time.
    """
    key, version = (app_key(spark), sf_dir), tables.dataset_version(spark, sf_dir, COHORT_TABLES)
    with _LOCK:
        if key not in _WIDE or _WIDE[key][0] != version:
            inp, chain = _chain(spark, sf_dir, 2)
            _WIDE[key] = (version, W.store_table(W.assemble_table(chain, inp, TEST_PARAMS), inp,
                                                 "cohort"))
        return _WIDE[key][1]


# lineitem dates are whole days a few per supplier per month: 30-day slices
# keep the slice-edge summary small relative to the rows.
LINEITEM_SLICE_HOURS = 24 * 30


@register("cumulative_to_incremental")
def q_cumulative_to_incremental(spark, sf_dir):
    li = tables.read_table(spark, sf_dir, "lineitem")
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return episodes.cumulative_to_incremental(
        li.select("l_suppkey", *order, "l_quantity"), entity="l_suppkey", order=order,
        value="l_quantity", slice_hours=LINEITEM_SLICE_HOURS)


@register("cumulative_total_check")
def q_cumulative_total_check(spark, sf_dir):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return episodes.cumulative_total_check(q_cumulative_to_incremental(spark, sf_dir),
                                           entity="l_suppkey", order=order,
                                           value="l_quantity")


@register("time_based_visit_link")
def q_time_based_visit_link(spark, sf_dir):
    m = B.measurement(spark, sf_dir).select("measurement_id", "person_id",
                                            "measurement_datetime")
    v = B.visits_many(spark, sf_dir).select("person_id", "visit_occurrence_id",
                                            "visit_start_datetime", "visit_end_datetime")
    return episodes.link_by_interval(m, v)


@register("base_cohort")
def q_base_cohort(spark, sf_dir):
    return lmk.base_cohort(B.visits_many(spark, sf_dir), COHORT_STARTS)


@register("condition_flag")
def q_condition_flag(spark, sf_dir):
    base = lmk.base_cohort(B.visit_per_entity(spark, sf_dir)) \
              .withColumn("admission_has_neuro", F.lit(0).cast("long"))
    flag = lmk.condition_flag(base, B.condition_occurrence(spark, sf_dir), CONDITION_PATTERNS)
    return update_from(base, flag, "person_id")


@register("first_event_after")
def q_first_event_after(spark, sf_dir):
    base = lmk.base_cohort(B.visit_per_entity(spark, sf_dir))
    return episodes.first_event_after(base, B.measurement(spark, sf_dir),
                                      TEST_PARAMS.segment_codes, "admission_start")


@register("first_segment")
def q_first_segment(spark, sf_dir):
    starts = q_first_event_after(spark, sf_dir)
    return episodes.first_segment(starts, B.measurement(spark, sf_dir),
                                  TEST_PARAMS.segment_codes, "first_ts",
                                  gap_hours=TEST_PARAMS.segment_gap_hours,
                                  tiebreak="measurement_id")


@register("sanity_summary")
def q_sanity_summary(spark, sf_dir):
    _, c1 = _chain(spark, sf_dir, 1)
    hrs = F.timestamp_diff("HOUR", F.col("first_imv_start"), F.col("first_imv_end"))
    return tot.summary(c1, {
        "total_patients": F.count(F.lit(1)),
        "has_imv": F.count_if(F.col("first_imv_start").isNotNull()),
        "mean_imv_hours": explore.exact_mean_col(hrs, 1),
        "min_imv_hours": F.min(hrs),
        "max_imv_hours": F.max(hrs),
    }, where=F.col("first_imv_end").isNotNull())


def _pair_sides(spark, sf_dir):
    inp, c1 = _chain(spark, sf_dir, 1)
    r = TEST_RULE
    bounds = c1.filter(F.col("first_imv_end").isNotNull()) \
               .select("person_id", "first_imv_start", "first_imv_end")
    m = inp.measurement
    inside = F.col("measurement_datetime").between(F.col("first_imv_start"),
                                                   F.col("first_imv_end"))
    a = (m.filter((F.col("measurement_concept_id") == r.first_code)
                  & (F.col("value_as_number").between(1, 50)
                     | F.col("value_as_number").between(0, 0.5))
                  & (F.col("unit_source_value") != "%"))
          .join(bounds, "person_id").filter(inside)
          .select("person_id", F.col("measurement_datetime").alias("a_time"),
                  F.col("value_as_number").alias("a_value")))
    b = (m.filter((F.col("measurement_concept_id") == r.second_code)
                  & (F.col("value_as_number") <= r.second_max))
          .join(bounds, "person_id").filter(inside)
          .select("person_id", F.col("measurement_datetime").alias("b_time"),
                  F.col("value_as_number").alias("b_value")))
    return a, b


@register("paired_within")
def q_paired_within(spark, sf_dir):
    a, b = _pair_sides(spark, sf_dir)
    return lmk.paired_within(a, b, tolerance_minutes=TEST_RULE.tolerance_minutes)


@register("not_exposed")
def q_not_exposed(spark, sf_dir):
    m = B.measurement(spark, sf_dir).filter(F.col("measurement_concept_id") == "view") \
         .select("measurement_id", "person_id", "measurement_datetime", "value_as_number")
    return lmk.not_exposed(m, B.drug_exposure(spark, sf_dir, null_ends=True), ["purchase"],
                           lead_in_hours=6, washout_hours=3)


#: Three exposure codes, each with its own lead-in and wash-out.
EXPOSURE_HOURS = {"purchase": (6, 3), "signup": (2, 0), "error": (0, 12)}


@register("not_exposed_per_code")
def q_not_exposed_per_code(spark, sf_dir):
    m = B.measurement(spark, sf_dir).filter(F.col("measurement_concept_id") == "view") \
         .select("measurement_id", "person_id", "measurement_datetime", "value_as_number")
    return lmk.not_exposed(m, B.drug_exposure(spark, sf_dir, null_ends=True, kinds=B.EXPOSURE_KINDS),
                           EXPOSURE_HOURS)


@register("eligibility_landmark")
def q_eligibility_landmark(spark, sf_dir):
    inp, c1 = _chain(spark, sf_dir, 1)
    return lmk.eligibility_landmark(c1, inp.measurement, inp.drug_exposure, TEST_RULE)


@register("terminal_landmark")
def q_terminal_landmark(spark, sf_dir):
    _, c2 = _chain(spark, sf_dir, 2)
    return c2.select("person_id", "eligible_start_time", "first_weaning",
                     "duration_eligible_to_weaning")


@register("landmark_gap_summary")
def q_landmark_gap_summary(spark, sf_dir):
    _, c2 = _chain(spark, sf_dir, 2)
    return lmk.landmark_gap_summary(c2)


@register("nearest_at_landmark")
def q_nearest_at_landmark(spark, sf_dir):
    inp, c2 = _chain(spark, sf_dir, 2)
    return feat.nearest_at_landmark(c2, inp.measurement, TEST_FEATURES[0], "first_weaning",
                                    suffix="weaning", tiebreak="measurement_id",
                                    cohort_filter=F.col("cohort_criteria") == 1)


@register("unit_normalise")
def q_unit_normalise(spark, sf_dir):
    m = B.measurement(spark, sf_dir)
    return feat.unit_normalise(m, TEST_FEATURES[0]).select(
        "measurement_id", "person_id", "measurement_datetime", "value_as_number",
        "unit_source_value", "normalised_value")


@register("feature_set_two_landmarks")
def q_feature_set_two_landmarks(spark, sf_dir):
    inp, c2 = _chain(spark, sf_dir, 2)
    return feat.extract_features(c2, inp.measurement, TEST_FEATURES, W.LANDMARKS,
                                 tiebreak="measurement_id",
                                 cohort_filter=F.col("cohort_criteria") == 1)


#: The shape of the reference's catalogue: fourteen variables, one or two codes each.
TEST_FEATURES_14 = TEST_FEATURES[:2] + (
    FeatureSpec("sbp", ("signup",), 48, 48), FeatureSpec("dbp", ("error",), 96, 96),
    FeatureSpec("spo2", ("signup", "purchase"), 24, 24, fraction_to_percent=True),
    FeatureSpec("haemoglobin", ("error", "click"), 24, 24, unit_equals="u"),
    FeatureSpec("wbc", ("view",), 12, 12), FeatureSpec("platelets", ("click",), 12, 12),
    FeatureSpec("base_excess", ("purchase",), 12, 12), FeatureSpec("crp", ("signup",), 12, 12),
    FeatureSpec("creatinine", ("error",), 12, 12), FeatureSpec("albumin", ("view",), 96, 96),
    FeatureSpec("haematocrit", ("view", "signup"), 24, 24, value_range=(0.1, 1)),
    FeatureSpec("lactate", ("purchase", "click"), 48, 48))


@register("feature_set_fourteen")
def q_feature_set_fourteen(spark, sf_dir):
    """C22 at its full width: 28 nearest values and their times in one scan."""
    inp, c2 = _chain(spark, sf_dir, 2)
    return feat.extract_features(c2, inp.measurement, TEST_FEATURES_14, W.LANDMARKS,
                                 tiebreak="measurement_id",
                                 cohort_filter=F.col("cohort_criteria") == 1)


@register("landmark_slope")
def q_landmark_slope(spark, sf_dir):
    inp, c2 = _chain(spark, sf_dir, 2)
    f = W.feature_pass(c2, inp, TEST_PARAMS)
    return f.select("person_id", *[f"{s.name}_slope" for s in TEST_FEATURES])


@register("window_sum")
def q_window_sum(spark, sf_dir):
    inp, c2 = _chain(spark, sf_dir, 2)
    return tot.window_sum(c2, inp.measurement, TEST_PARAMS.intake_codes,
                          F.col("first_imv_start"), F.col("eligible_start_time"),
                          out="fluid_intake_imv_to_eligible",
                          cohort_filter=F.col("first_imv_end").isNotNull())


def _fluids(spark, sf_dir):
    inp, c2 = _chain(spark, sf_dir, 2)
    return W.fluid_pass(c2, inp, TEST_PARAMS)


@register("window_sum_zero_filled")
def q_window_sum_zero_filled(spark, sf_dir):
    return _fluids(spark, sf_dir).select("person_id", "fluid_intake_24h_prior",
                                         "fluid_output_24h_prior")


@register("code_set_audit")
def q_code_set_audit(spark, sf_dir):
    return tot.code_set_audit(B.measurement(spark, sf_dir),
                              tot.code_set_frame(spark, TEST_CODE_SET),
                              codes=[row[0] for row in TEST_CODE_SET])


@register("fluid_balance")
def q_fluid_balance(spark, sf_dir):
    return _fluids(spark, sf_dir).select(
        "person_id", "duration_imv_to_eligible",
        *[f"fluid_{k}_{p}" for p in W.PERIODS for k in ("intake", "output", "balance")])


@register("fluid_balance_slopes")
def q_fluid_balance_slopes(spark, sf_dir):
    return _fluids(spark, sf_dir).select(
        "person_id", *[f"fluid_{k}_{p}_slope" for p in W.PERIODS[:2]
                       for k in ("intake", "output", "balance")])


@register("fluid_summary")
def q_fluid_summary(spark, sf_dir):
    wide = weaning_wide(spark, sf_dir)
    return tot.summary(wide, {
        "mean_balance_p1_ml": explore.exact_mean_col(F.col("fluid_balance_imv_to_eligible"), 0),
        "mean_balance_p2_ml": explore.exact_mean_col(
            F.col("fluid_balance_eligible_to_weaning"), 0),
        "mean_balance_24h_ml": explore.exact_mean_col(F.col("fluid_balance_24h_prior"), 0),
        "mean_balance_slope_mlph": explore.exact_mean_col(
            F.col("fluid_balance_eligible_to_weaning_slope"), 3),
        "n": F.count(F.lit(1)),
    }, where=F.col("cohort_criteria") == 1)


@register("slope_histogram")
def q_slope_histogram(spark, sf_dir):
    wide = weaning_wide(spark, sf_dir).filter(F.col("cohort_criteria") == 1)
    return tot.histogram(wide, "fluid_balance_eligible_to_weaning_slope", -500, 500, 60)


@register("cohort_flag")
def q_cohort_flag(spark, sf_dir):
    _, c2 = _chain(spark, sf_dir, 2)
    return c2.select("person_id", "first_imv_duration", "cohort_criteria")


@register("outcome_classify")
def q_outcome_classify(spark, sf_dir):
    _, c2 = _chain(spark, sf_dir, 2)
    return c2.select("person_id", "weaning_to_second_imv", "weaning_success",
                     "weaning_failure", "weaning_outcome", "weaning_outcome_detail")


@register("outcome_distribution")
def q_outcome_distribution(spark, sf_dir):
    _, c2 = _chain(spark, sf_dir, 2)
    return outc.outcome_distribution(c2)


@register("weaning_cohort")
def q_weaning_cohort(spark, sf_dir):
    """The flagship: the whole wide table, one row per entity."""
    return weaning_wide(spark, sf_dir)


# ---------------------------------------------------------------------------
# wide-table lifecycle (T1-T12, C42-C43, C47-C49) and quality
# ---------------------------------------------------------------------------


# Expected ranges of the checked columns of the test cohort.
TEST_RANGES = {
    "fio2_at_eligible": (21, 100),
    "fio2_at_weaning": (21, 100),
    "peep_at_weaning": (0, 60),
    "haemoglobin_at_weaning": (0, 400),
    "lactate_at_weaning": (0, 400),
    "fluid_balance_imv_to_eligible": (-5000, 10000),
    "fluid_balance_24h_prior": (-5000, 10000),
    "eligible_start_fio2": (0, 50),
    "first_imv_duration": (24, 720),
}


def _wide_base(spark, sf_dir):
    """T5: base rows of the declared table (core columns, rest default)."""
    base = lmk.base_cohort(B.visit_per_entity(spark, sf_dir))
    return catalogue.wide_schema().base_rows(base)


@register("wide_base_rows")
def q_wide_base_rows(spark, sf_dir):
    return _wide_base(spark, sf_dir)


def _passes(spark, sf_dir):
    inp, c2 = _chain(spark, sf_dir, 2)
    m = inp.measurement

    def chain_pass(_):
        return c2.select("person_id",
                         F.col("eligible_start_time").alias("landmark_a_time"),
                         F.col("first_weaning").alias("landmark_b_time"),
                         F.col("weaning_failure").alias("outcome_flag"),
                         F.col("weaning_outcome").alias("outcome_label"),
                         "cohort_criteria", F.col("died_ts").alias("died_timestamp"))

    def demographics_pass(_):
        return B.person(spark, sf_dir)

    def fact_pass(base):
        """Feature, both totals and the last measurement: the facts are read once."""
        spec = replace(TEST_FEATURES[0], name="feature_1")
        sums = [tot.WindowSpec("cumulative_value_period_1", TEST_PARAMS.intake_codes,
                               F.col("first_imv_start"), F.col("eligible_start_time")),
                tot.WindowSpec("cumulative_value_period_2", TEST_PARAMS.intake_codes,
                               F.col("eligible_start_time"), F.col("first_weaning"))]
        found = onepass.fact_pass(
            c2, m, features=[spec], landmarks={"a": "eligible_start_time", "b": "first_weaning"},
            sums=sums, latest="last_known_measurement", tiebreak="measurement_id",
            feature_gate=F.col("cohort_criteria") == 1,
            sum_gate=F.col("first_imv_end").isNotNull())
        # a total without events keeps the declared default
        schema = catalogue.wide_schema()
        return found.withColumns({w.name: F.coalesce(F.col(w.name), schema.default_of(w.name))
                                  for w in sums})

    passes = [chain_pass, demographics_pass, fact_pass]
    derived = [lambda t: feat.landmark_slope(t, "feature_1", "a", "b", min_hours=4)]
    return passes, derived


@register("wide_assemble")
def q_wide_assemble(spark, sf_dir):
    passes, derived = _passes(spark, sf_dir)
    table = assemble(_wide_base(spark, sf_dir), "person_id", passes, derived)
    return catalogue.wide_schema().conform(table)


def _wide_steps(spark, sf_dir, empty: str):
    """Rows and columns of a catalogued wide table after each step of its life."""
    table = CatalogTable(spark, f"wide_{uuid.uuid4().hex}", catalogue.wide_schema())
    base = _wide_base(spark, sf_dir)
    steps = [("created", table.create()), ("loaded", table.insert(base))]
    before = table.read()
    steps += [(empty, getattr(table, empty)()), ("reader of the old version", before)]
    steps += [("loaded again", table.insert(base)), ("loaded twice", table.insert(base))]
    parts = [df.agg(F.lit(i).alias("step"), F.lit(name).alias("state"), F.count(F.lit(1)).alias("row_count"),
                    F.count_distinct("person_id").alias("patient_count"),
                    F.count_if(F.col("outcome_flag") == 0).alias("defaults"),
                    F.lit(len(df.columns)).cast("long").alias("column_count"))
             for i, (name, df) in enumerate(steps)]
    return reduce(lambda a, b: a.unionByName(b), parts)


@register("wide_reset")
def q_wide_reset(spark, sf_dir):
    """The declared table, dropped and declared anew, empty."""
    return _wide_steps(spark, sf_dir, "reset")


@register("wide_truncate")
def q_wide_truncate(spark, sf_dir):
    """T4: the table keeps its declaration and loses its rows."""
    return _wide_steps(spark, sf_dir, "truncate")


@register("update_where")
def q_update_where(spark, sf_dir):
    t = q_wide_assemble(spark, sf_dir)
    # Both SETs read the row as it was (outcome_flag reads the old label)
    return update_where(t, {
        "outcome_label": F.coalesce(F.col("outcome_label"), F.lit("unclassified")),
        "outcome_flag": F.when(F.col("outcome_label") == "failure", 1).otherwise(0)
                         .cast("long"),
    }, F.col("cohort_criteria") == 1)


def _eligibility_update(spark, sf_dir, times: int):
    inp, c1 = _chain(spark, sf_dir, 1)
    t = c1.select("person_id", "first_imv_start", "first_imv_end").withColumns({
        "eligible_start_time": F.lit(None).cast("timestamp_ntz"),
        "eligible_start_fio2": F.lit(None).cast("decimal(38,9)"),
        "eligible_start_peep": F.lit(None).cast("decimal(38,9)")})
    src = lmk.eligibility_landmark(c1, inp.measurement, inp.drug_exposure, TEST_RULE)
    for _ in range(times):
        t = update_from(t, src, "person_id")
    return t


@register("update_from")
def q_update_from(spark, sf_dir):
    return _eligibility_update(spark, sf_dir, 1)


@register("update_idempotent")
def q_update_idempotent(spark, sf_dir):
    return _eligibility_update(spark, sf_dir, 2)


@register("check_column")
def q_check_column(spark, sf_dir):
    return quality.check_column(weaning_wide(spark, sf_dir), "fio2_at_weaning", 21, 100)


@register("check_ranges")
def q_check_ranges(spark, sf_dir):
    return quality.check_ranges(weaning_wide(spark, sf_dir), TEST_RANGES)


@register("table_status")
def q_table_status(spark, sf_dir):
    return quality.table_status(weaning_wide(spark, sf_dir))


FEATURE_MATRIX_COLS = (
    [f"{s.name}_at_{l}" for s in TEST_FEATURES for l in ("eligible", "weaning")]
    + [f"{s.name}_slope" for s in TEST_FEATURES]
    + [f"fluid_balance_{p}" for p in W.PERIODS]
    + ["fluid_balance_eligible_to_weaning_slope", "eligible_start_fio2", "eligible_start_peep",
       "duration_eligible_to_weaning"])


@register("feature_matrix")
def q_feature_matrix(spark, sf_dir):
    """One feature vector per cohort entity with its label."""
    wide = weaning_wide(spark, sf_dir).filter(F.col("cohort_criteria") == 1)
    return wide.select("person_id", F.col("weaning_failure").alias("label"),
                       *FEATURE_MATRIX_COLS)


@register("demographics")
def q_demographics(spark, sf_dir):
    base = _wide_base(spark, sf_dir)
    return update_from(base, B.person(spark, sf_dir), "person_id") \
        .select("person_id", "age_at_admission", "sex")


@register("last_known_measurement")
def q_last_known_measurement(spark, sf_dir):
    base = _wide_base(spark, sf_dir)
    last = B.measurement(spark, sf_dir).groupBy("person_id").agg(
        F.max("measurement_datetime").alias("last_known_measurement"))
    return update_from(base, last, "person_id").select("person_id", "last_known_measurement")


# ---------------------------------------------------------------------------
# the reference's sanity checks after each step
# ---------------------------------------------------------------------------

def _pct(num, den, digits=1):
    from ..functions.numeric import percent
    return percent(num, den, digits)


@register("condition_flag_summary")
def q_condition_flag_summary(spark, sf_dir):
    t = q_condition_flag(spark, sf_dir)
    flagged = F.count_if(F.col("admission_has_neuro") == 1)
    return tot.summary(t, {
        "neuro_excluded": flagged,
        "non_neuro": F.count_if(F.col("admission_has_neuro") == 0),
        "pct_excluded": _pct(flagged, F.count(F.lit(1))),
    })


@register("base_cohort_check")
def q_base_cohort_check(spark, sf_dir):
    return tot.summary(q_base_cohort(spark, sf_dir), {
        "n": F.count(F.lit(1)), "unique_pts": F.count_distinct("person_id")})


@register("eligibility_summary")
def q_eligibility_summary(spark, sf_dir):
    _, c2 = _chain(spark, sf_dir, 2)
    gap = F.timestamp_diff("HOUR", F.col("eligible_start_time"), F.col("first_imv_end"))
    return tot.summary(c2, {
        "has_eligibility": F.count_if(F.col("eligible_start_time").isNotNull()),
        "imv_but_no_eligibility": F.count_if(F.col("eligible_start_time").isNull()
                                             & F.col("first_imv_end").isNotNull()),
        "mean_gap_hours": explore.exact_mean_col(gap, 1),
    })


@register("feature_summary")
def q_feature_summary(spark, sf_dir):
    wide = weaning_wide(spark, sf_dir)
    return tot.summary(wide, {
        "has_fio2": F.count("fio2_at_weaning"),
        "mean_fio2": explore.exact_mean_col(F.col("fio2_at_weaning"), 1),
        "min_fio2": F.min("fio2_at_weaning"), "max_fio2": F.max("fio2_at_weaning"),
    }, where=F.col("cohort_criteria") == 1)


@register("slope_summary")
def q_slope_summary(spark, sf_dir):
    wide = weaning_wide(spark, sf_dir)
    return tot.summary(wide, {
        "mean_fio2_slope": explore.exact_mean_col(F.col("fio2_slope"), 4),
        "mean_peep_slope": explore.exact_mean_col(F.col("peep_slope"), 4),
        "fio2_slope_missing": F.count_if(F.col("fio2_slope").isNull()),
        "total": F.count(F.lit(1)),
    }, where=F.col("cohort_criteria") == 1)


@register("intake_summary")
def q_intake_summary(spark, sf_dir):
    wide = weaning_wide(spark, sf_dir)
    x = F.col("fluid_intake_imv_to_eligible")
    return tot.summary(wide, {
        "mean_intake_ml": explore.exact_mean_col(x, 0),
        "min_intake_ml": F.min(x), "max_intake_ml": F.max(x),
        "impossible_negative_intake": F.count_if(x < 0),
    }, where=F.col("cohort_criteria") == 1)


@register("episode_summary")
def q_episode_summary(spark, sf_dir):
    """C15 follow-up: distribution of episode hours and distinct entities, with exact
    quartiles (the lower of two middle values). The episodes, which two parts of the
    plan read, are stored once."""
    ep = materialize(q_gap_episodes(spark, sf_dir).select("person_id", "episode_hours"), "episodes")
    h = F.col("episode_hours")
    stats = tot.summary(ep, {
        "count": F.count(h), "mean": F.avg(h.cast("double")),
        "std": F.stddev_samp(h.cast("double")), "min": F.min(h), "max": F.max(h),
        "unique_patients": F.count_distinct("person_id")})
    q = quantiles(ep, [], "episode_hours", [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    return side_by_side(stats, q).select(
        "count", F.col("mean").cast("decimal(38,6)").alias("mean"),
        F.col("std").cast("decimal(38,6)").alias("std"), "min", "p25", "p50", "p75", "max",
        "unique_patients")
