"""The oracle's literal parameters stay in step with the registered queries'."""

from cohortkit.plans import oracle as O
from cohortkit.plans import registry as R


def test_feature_catalogue_matches_oracle():
    spark_side = [(f.name, list(f.codes), f.before_hours, f.after_hours, f.value_range,
                   f.fraction_to_percent, f.unit_equals, f.unit_not) for f in R.TEST_FEATURES]
    oracle_side = [(n, c, b, a, tuple(r) if r else None, fr, ue, un)
                   for n, c, b, a, r, fr, ue, un in O.TEST_FEATURES]
    assert spark_side == oracle_side


def test_ranges_codes_and_parameters_match_oracle():
    assert R.TEST_RANGES == O.TEST_RANGES
    assert list(R.TEST_PARAMS.intake_codes) == O.INTAKE
    assert list(R.TEST_PARAMS.output_codes) == O.OUTPUT
    assert R.EPISODE_CODES == O.EPISODE_CODES
    assert R.CANDIDATE_IDS == O.CANDIDATE_IDS


def test_every_query_has_an_oracle():
    assert set(R.QUERIES) <= set(O.ORACLE)
