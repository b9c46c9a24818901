"""The weaning cohort with the reference's own parameters on a tiny OMOP-shaped
fixture (integer concept ids, the reference's column names)."""

import datetime as dt

from cohortkit.plans import catalogue, weaning

A = dt.datetime(2017, 1, 1)


def h(n):
    return A + dt.timedelta(hours=n)


def test_reference_parameters_run_end_to_end(spark):
    visit = spark.createDataFrame(
        [(1, A, h(24 * 20)), (1, A, h(24 * 20)), (2, A, h(24 * 20)), (3, A, None)],
        "person_id long, visit_start_datetime timestamp_ntz, visit_end_datetime timestamp_ntz")
    rows, i = [], 0

    def m(p, t, c, v, u="cmH2O"):
        nonlocal i
        i += 1
        rows.append((i, p, h(t), c, float(v), u))

    for p in (1, 2):
        for t in range(1, 60):                 # ventilation every hour for 59 h
            m(p, t, 36303816, 1)
            m(p, t, 3022875, 8 if t > 10 else 14)
        for t in range(8, 60, 2):              # FiO2 in percent, falling
            m(p, t + 0.25, 2000000204, 60 - t / 2, "%%")
        m(p, 70, 3022875, 5)                   # second episode 11 h after the first
        for t in range(2, 60, 6):
            m(p, t, 3037253, 100)              # intake
            m(p, t + 1, 3014315, 40)           # urine output
    fact = spark.createDataFrame(rows, "measurement_id long, person_id long, "
                                       "measurement_datetime timestamp_ntz, "
                                       "measurement_concept_id long, value_as_number double, "
                                       "unit_source_value string")
    drugs = spark.createDataFrame(
        [(2, 1321341, h(0), h(30))],           # noradrenaline delays person 2
        "person_id long, drug_concept_id long, drug_exposure_start_datetime timestamp_ntz, "
        "drug_exposure_end_datetime timestamp_ntz")
    cond = spark.createDataFrame([(2, h(5), "Head trauma, closed")],
                                 "person_id long, condition_start_datetime timestamp_ntz, "
                                 "condition_source_value string")
    inputs = weaning.WeaningInputs(visit=visit, measurement=fact, drug_exposure=drugs,
                                   condition=cond, death=None, cut=False)
    table = {r.person_id: r for r in
             weaning.weaning_table(inputs, catalogue.reference_params()).collect()}
    assert sorted(table) == [1, 2]                       # one row per admission with an end
    p1, p2 = table[1], table[2]
    assert p1.first_imv_start == h(1) and p1.first_imv_end == h(59)
    assert p1.second_imv_start == h(70)
    assert p1.eligible_start_time == h(20.25)            # FiO2 = 60 - t/2 <= 50 from t = 20
    assert p1.first_weaning == h(59) and p1.cohort_criteria == 1
    assert (p1.weaning_outcome, p1.weaning_outcome_detail) == ("failure", "reintubated")
    assert p1.fluid_intake_imv_to_eligible is not None and p1.fio2_at_weaning is not None
    assert p2.admission_has_neuro == 1 and p2.cohort_criteria is None
    assert p2.eligible_start_time >= h(33)               # 3 h wash-out after noradrenaline


def test_one_row_per_entity_check(spark):
    import pytest
    visit = spark.createDataFrame([(1, A, h(10)), (1, A, h(30))],
                                  "person_id long, visit_start_datetime timestamp_ntz, "
                                  "visit_end_datetime timestamp_ntz")
    empty = spark.createDataFrame([], "measurement_id long, person_id long, "
                                      "measurement_datetime timestamp_ntz, "
                                      "measurement_concept_id long, value_as_number double, "
                                      "unit_source_value string")
    drugs = spark.createDataFrame([], "person_id long, drug_concept_id long, "
                                      "drug_exposure_start_datetime timestamp_ntz, "
                                      "drug_exposure_end_datetime timestamp_ntz")
    inputs = weaning.WeaningInputs(visit=visit, measurement=empty, drug_exposure=drugs,
                                   cut=False, check_one_row_per_entity=True)
    with pytest.raises(ValueError):
        weaning.episode_chain(inputs, catalogue.reference_params())
