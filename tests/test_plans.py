"""Plan shape: no Python in the hot path, no cartesian products, one scan
of the facts per fused pass, filters pushed into the Parquet scan."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from cohortkit.operators import features, landmarks, onepass
from cohortkit.plans import registry as R
from cohortkit.sources import bindings as B

SF_DIR = "/root/testdata/sf0.001"
BAD = ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_no_python_eval_or_cartesian(spark, name):
    text = plan(entry.queries()[name](spark, SF_DIR))
    for bad in BAD:
        assert bad not in text, f"{name}: {bad}"


def test_fused_features_scan_events_once(spark):
    inp, chain = R._chain(spark, SF_DIR, 2)
    df = features.extract_features(chain, inp.measurement, R.TEST_FEATURES, R.W.LANDMARKS,
                                   tiebreak="measurement_id",
                                   cohort_filter=F.col("cohort_criteria") == 1)
    text = plan(df)
    assert len(re.findall(r"events\.parquet", text)) == 1


def test_code_filter_pushed_to_scan(spark):
    df = B.measurement(spark, SF_DIR).filter(F.col("measurement_concept_id").isin("view"))
    text = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(event_type), In(event_type, [view])]" in text \
        or "PushedFilters: [In(event_type, [view])" in text or "EqualTo(event_type,view)" in text


def test_measurement_pass_is_one_scan_and_equals_separate_passes(spark):
    inp, chain = R._chain(spark, SF_DIR, 2)
    fused = R.W.measurement_pass(chain, inp, R.TEST_PARAMS)
    assert len(re.findall(r"events\.parquet", plan(fused))) == 1
    sep = (R.W.feature_pass(chain, inp, R.TEST_PARAMS)
           .join(R.W.fluid_pass(chain, inp, R.TEST_PARAMS), "person_id", "full"))
    cols = sorted(fused.columns)
    assert cols == sorted(sep.columns)
    assert sorted(map(tuple, fused.select(cols).collect()), key=str) == \
           sorted(map(tuple, sep.select(cols).collect()), key=str)


def test_wide_table_reads_its_facts_once(spark):
    for name in ("wide_assemble", "update_where"):
        text = plan(R.QUERIES[name](spark, SF_DIR))
        # the admissions, which the test binding derives from events, and the facts
        assert len(re.findall(r"events\.parquet", text)) == 2, name


def test_fact_pass_equals_separate_passes(spark):
    inp, chain = R._chain(spark, SF_DIR, 2)
    m, gate = inp.measurement, F.col("cohort_criteria") == 1
    marks = {"a": "eligible_start_time", "b": "first_weaning"}
    specs = [R.tot.WindowSpec("s1", ("purchase",), F.col("first_imv_start"), F.col("first_weaning")),
             R.tot.WindowSpec("s2", ("signup", "error"), F.col("admission_start"),
                              F.col("first_imv_start"), closed="left")]
    for tiebreak in ("measurement_id", None):
        feats = R.TEST_FEATURES[:3] if tiebreak else R.TEST_FEATURES[1:2]
        fused = onepass.fact_pass(chain, m, features=feats, landmarks=marks, sums=specs, latest="last",
                                  feature_gate=gate, tiebreak=tiebreak)
        a = features.extract_features(chain, m, feats, marks, tiebreak=tiebreak, cohort_filter=gate)
        b = R.tot.window_sums(chain, m, specs)
        last = m.groupBy("person_id").agg(F.max("measurement_datetime").alias("last"))
        apart = chain.select("person_id").join(last, "person_id").join(a, "person_id", "left") \
                     .join(b, "person_id", "left").select(*fused.columns)
        assert fused.count() > 0
        assert sorted(map(tuple, fused.collect()), key=str) == sorted(map(tuple, apart.collect()), key=str)


def test_nearest_rows_use_hash_aggregation(spark):
    inp, chain = R._chain(spark, SF_DIR, 2)
    fused = R.W.measurement_pass(chain, inp, R.TEST_PARAMS)
    feats = features.extract_features(chain, inp.measurement, R.TEST_FEATURES, R.W.LANDMARKS,
                                      tiebreak="measurement_id",
                                      cohort_filter=F.col("cohort_criteria") == 1)
    for df in (fused, feats):
        text = plan(df)
        assert "SortAggregate" not in text and "HashAggregate" in text


def test_eligibility_is_one_scan_without_pairs(spark):
    """As it ran: both signals from one scan, no join of one with the other."""
    inp, c1 = R._chain(spark, SF_DIR, 1)
    df = landmarks.eligibility_landmark(c1, inp.measurement, inp.drug_exposure, R.TEST_RULE)
    df.collect()
    final = plan(df).split("== Initial Plan ==")[0]
    scans = re.findall(r"FileScan parquet[^\n]*measurement|FileScan parquet[^\n]*", final)
    facts = [x for x in scans if "value" in x]
    assert len(facts) == 1, facts
    assert R.TEST_RULE.pairing == "counts"
