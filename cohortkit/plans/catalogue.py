"""The reference analysis's own parameters, for OMOP CDM data.

These are the values a user of the reference would pass when running the
weaning cohort on a real OMOP CDM instance. The test bindings use their own
parameters (see ``cohortkit.plans.weaning.TEST_PARAMS``).
"""

from __future__ import annotations

from ..operators.features import FeatureSpec
from ..operators.landmarks import EligibilityRule

# --- fixed values (must equal the reference's) -----------------------------
# Ventilation segment signals (a second ventilator parameter and PEEP set).
SEGMENT_CONCEPT_IDS = (36303816, 3022875)
# Exclusion drugs: noradrenaline, propofol, neuromuscular relaxant.
NORADRENALINE_ID = 1321341
PROPOFOL_ID = 753626
NMRA_ID = 19003953
# FiO2 and PEEP concept ids of the eligibility rule.
FIO2_ID = 2000000204
PEEP_ID = 3022875
# Fluid intake ids (all incremental).
INTAKE_IDS = (3037253, 3004654, 3010494, 2000000085, 3006552)
# Fluid output ids in use.
OUTPUT_IDS = (3014315, 2000000063, 21493943, 2000000090, 3026556, 3020433, 3006376,
              21491183, 3011087, 3008793, 2000000364, 2000000370)
# Output ids not to use, with the reason.
OUTPUT_EXCLUDED = ((3008828, "moving window"), (2000000064, "cumulative"),
                   (2000000232, "negligible"))
# Neurological condition text patterns (English and Dutch), case-sensitive LIKE.
NEURO_PATTERNS = (
    "%Head trauma%",
    "%Hoofdtrauma%",
    "%Head/multiple trauma%",
    "%CVA, cerebrovascular accident/stroke%",
    "%Subarachnoid hemorrhage%",
    "%S.A.B.%",
    "%Intracerebral subdural or subarachnoid haemorrhage%",
    "%Hemorrhage/hematoma, intracranial%",
    "%Intracerebraal haematoom%",
    "%Hematoma, subdural%",
    "%Subduraal haematoom%",
)
# Admission starts included (anonymised years start on January 1).
ADMISSION_STARTS = ("2017-01-01", "2010-01-01")
# Expected ranges per wide-table column (lower, upper).
EXPECTED_RANGES = {
    "heart_rate_at_a": (20, 250),
    "systolic_bp_at_a": (50, 300),
    "spo2_at_a": (50, 100),
    "fio2_at_a": (21, 100),
    "peep_at_a": (0, 30),
    "haemoglobin_at_a": (2, 20),
    "creatinine_at_a": (20, 2000),
    "lactate_at_a": (0, 30),
    "cumulative_value_period_1": (-5000, 10000),
}
# Feature catalogue: name, concept ids, hours before, hours after, rules.
FEATURES = (
    FeatureSpec("fio2", (2000000204,), 2, 0, value_range=(0.1, 100),
                fraction_to_percent=True, unit_not="%"),
    FeatureSpec("peep", (3022875,), 2, 0),
    FeatureSpec("sbp", (21490853,), 4, 4),
    FeatureSpec("dbp", (21490851,), 12, 12),
    FeatureSpec("spo2", (40762499, 3016502), 12, 12, fraction_to_percent=True),
    FeatureSpec("haemoglobin", (40762351, 21490721), 12, 12, unit_equals="mmol/l"),
    FeatureSpec("wbc", (3010813,), 12, 12),
    FeatureSpec("platelets", (3007461,), 12, 12),
    FeatureSpec("base_excess", (3003396,), 12, 12),
    FeatureSpec("crp", (3020460,), 12, 12),
    FeatureSpec("creatinine", (3020564,), 12, 12),
    FeatureSpec("albumin", (3024561,), 12, 12),
    FeatureSpec("haematocrit", (3034976, 3009542), 12, 12, value_range=(0.1, 1)),
    FeatureSpec("lactate", (3047181, 3018405), 12, 12),
)
# Thresholds of the cohort analysis.
SEGMENT_GAP_HOURS = 6
DEATH_GUARD_HOURS = 12
MIN_DURATION_HOURS = 24
OUTCOME_HORIZON_HOURS = 48
SLOPE_MIN_HOURS = 4
POPULATED_OK_PERCENT = 80
VISIT_ID_OK_PERCENT = 90
# The declared wide table of the schema-first pattern: name, type, default.
WIDE_TABLE_COLUMNS = (
    ("person_id", "bigint", None),
    ("admission_start", "timestamp_ntz", None),
    ("admission_end", "timestamp_ntz", None),
    ("age_at_admission", "decimal(38,9)", None),
    ("sex", "string", None),
    ("landmark_a_time", "timestamp_ntz", None),
    ("landmark_b_time", "timestamp_ntz", None),
    ("feature_1_at_a", "decimal(38,9)", None),
    ("feature_1_at_a_time", "timestamp_ntz", None),
    ("feature_1_at_b", "decimal(38,9)", None),
    ("feature_1_at_b_time", "timestamp_ntz", None),
    ("feature_1_slope", "decimal(38,9)", None),
    ("cumulative_value_period_1", "decimal(38,9)", 0),
    ("cumulative_value_period_2", "decimal(38,9)", 0),
    ("outcome_flag", "bigint", 0),
    ("outcome_label", "string", None),
    ("cohort_criteria", "bigint", None),
    ("died_timestamp", "timestamp_ntz", None),
    ("last_known_measurement", "timestamp_ntz", None),
)
# --- end of fixed values ----------------------------------------------------

def wide_schema():
    """The declared wide table as a ``WideSchema``."""
    from .widetable import WideColumn, WideSchema
    return WideSchema([WideColumn(n, t, d) for n, t, d in WIDE_TABLE_COLUMNS])


ELIGIBILITY = EligibilityRule(
    first_code=FIO2_ID, first_ranges=((1, 50), (0, 0.5)), first_unit_not="%",
    second_code=PEEP_ID, second_max=10, tolerance_minutes=30, start_offset_hours=6,
    exposure_codes=(NORADRENALINE_ID, PROPOFOL_ID, NMRA_ID), lead_in_hours=6,
    washout_hours=3)


def reference_params(tiebreak: str | None = "measurement_id"):
    """The weaning cohort with the reference's own parameters (OMOP ids)."""
    from .weaning import WeaningParams
    return WeaningParams(
        segment_codes=SEGMENT_CONCEPT_IDS, segment_gap_hours=SEGMENT_GAP_HOURS,
        rule=ELIGIBILITY, death_guard_hours=DEATH_GUARD_HOURS,
        min_duration_hours=MIN_DURATION_HOURS, horizon_hours=OUTCOME_HORIZON_HOURS,
        condition_patterns=NEURO_PATTERNS, admission_starts=ADMISSION_STARTS,
        features=FEATURES, intake_codes=INTAKE_IDS, output_codes=OUTPUT_IDS,
        slope_min_hours=SLOPE_MIN_HOURS, tiebreak=tiebreak)
