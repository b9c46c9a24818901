"""Edge semantics on tiny hand-made frames (FIXTURES.md §6)."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cohortkit.operators import episodes, features, landmarks, outcomes, quality, totals
from cohortkit.plans.widetable import update_from

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)
EV = "person_id long, measurement_datetime timestamp_ntz, measurement_concept_id string, " \
     "value_as_number double, unit_source_value string, measurement_id long"


def events(spark, rows):
    return spark.createDataFrame(rows, EV)


def h(n):
    return dt.timedelta(hours=n)


def test_gap_exactly_24h_strict_is_one_episode(spark):
    df = events(spark, [(1, T0, "a", 1.0, "u", 1), (1, T0 + h(24), "a", 1.0, "u", 2),
                        (1, T0 + h(48), "a", 1.0, "u", 3)])
    ep = episodes.gap_episodes(df, ["a"], gap_hours=24, min_hours=0,
                               tiebreak="measurement_id").collect()
    assert len(ep) == 1 and ep[0].measurement_count == 3 and ep[0].episode_hours == 48


def test_gap_over_24h_splits(spark):
    df = events(spark, [(1, T0, "a", 1.0, "u", 1), (1, T0 + h(25), "a", 1.0, "u", 2)])
    ep = episodes.gap_episodes(df, ["a"], gap_hours=24, min_hours=0,
                               tiebreak="measurement_id").orderBy("episode_number").collect()
    assert [r.episode_number for r in ep] == [1, 2]


def test_segment_gap_exactly_6h_not_strict_ends_segment(spark):
    df = events(spark, [(1, T0, "a", 1.0, "u", 1), (1, T0 + h(6), "a", 1.0, "u", 2)])
    coh = spark.createDataFrame([(1, T0)], "person_id long, start timestamp_ntz")
    seg = episodes.first_segment(coh, df, ["a"], "start", gap_hours=6,
                                 tiebreak="measurement_id").collect()[0]
    assert seg.segment_end_ts == T0 and seg.next_segment_ts == T0 + h(6)


def test_segment_gap_5h59_does_not_split(spark):
    df = events(spark, [(1, T0, "a", 1.0, "u", 1),
                        (1, T0 + h(5) + dt.timedelta(minutes=59), "a", 1.0, "u", 2)])
    coh = spark.createDataFrame([(1, T0)], "person_id long, start timestamp_ntz")
    seg = episodes.first_segment(coh, df, ["a"], "start", gap_hours=6).collect()[0]
    assert seg.segment_end_ts == T0 + h(5) + dt.timedelta(minutes=59)
    assert seg.next_segment_ts is None


def test_slope_needs_more_than_4_whole_hours(spark):
    rows = [(1, Decimal("10"), T0, Decimal("20"), T0 + h(4) + dt.timedelta(minutes=59)),
            (2, Decimal("10"), T0, Decimal("20"), T0 + h(5))]
    df = spark.createDataFrame(rows, "person_id long, f_at_a decimal(38,9), "
                                     "f_at_a_time timestamp_ntz, f_at_b decimal(38,9), "
                                     "f_at_b_time timestamp_ntz")
    out = {r.person_id: r.f_slope for r in
           features.landmark_slope(df, "f", "a", "b").collect()}
    assert out[1] is None and out[2] == Decimal("2.000000000")


def test_unit_not_percent_drops_null_units(spark):
    df = events(spark, [(1, T0, "a", 0.5, None, 1), (1, T0, "a", 0.5, "%", 2),
                        (1, T0, "a", 0.5, "u", 3)])
    spec = features.FeatureSpec("f", ("a",), 1, 0, unit_not="%", fraction_to_percent=True)
    rows = features.unit_normalise(df, spec).collect()
    assert len(rows) == 1 and rows[0].measurement_id == 3 and rows[0].normalised_value == 50.0


def test_exposure_with_null_end_never_excludes(spark):
    ev = events(spark, [(1, T0 + h(1), "a", 1.0, "u", 1), (2, T0 + h(1), "a", 1.0, "u", 2)])
    ex = spark.createDataFrame(
        [(1, "d", T0, None), (2, "d", T0, T0 + h(2))],
        "person_id long, drug_concept_id string, drug_exposure_start_datetime timestamp_ntz, "
        "drug_exposure_end_datetime timestamp_ntz")
    kept = landmarks.not_exposed(ev, ex, ["d"]).collect()
    assert [r.person_id for r in kept] == [1]


def test_window_edges_are_inclusive_and_empty_windows(spark):
    ev = events(spark, [(1, T0, "a", 1.0, "u", 1), (1, T0 + h(2), "a", 2.0, "u", 2),
                        (1, T0 + h(3), "a", 4.0, "u", 3)])
    coh = spark.createDataFrame([(1, T0, T0 + h(2)), (2, T0, T0 + h(2))],
                                "person_id long, lo timestamp_ntz, hi timestamp_ntz")
    s = totals.window_sum(coh, ev, ["a"], F.col("lo"), F.col("hi"), out="v").collect()
    assert len(s) == 1 and s[0].v == Decimal("3.000000000")  # person 2: no row (NULL)


def test_cumulative_reset_series(spark):
    values = [0, 150, 320, 480, 100, 290, 450, 610]
    df = spark.createDataFrame([(1, T0 + h(i), i, float(v)) for i, v in enumerate(values)],
                               "e long, t timestamp_ntz, n long, v double")
    inc = episodes.cumulative_to_incremental(df, entity="e", order=["t", "n"], value="v")
    got = [r.incremental for r in inc.orderBy("t").collect()]
    assert got == [0, 150, 170, 160, 100, 190, 160, 160]
    chk = episodes.cumulative_total_check(inc, entity="e", order=["t", "n"], value="v")
    r = chk.collect()[0]
    assert (r.last_cumulative, r.incremental_total, r.totals_match) == (610, 1090, 0)


def test_all_null_column_fails(spark):
    df = spark.createDataFrame([(1, None, 1), (2, None, 1)],
                               "person_id long, x decimal(38,9), cohort_criteria long")
    r = quality.check_column(df, "x", 0, 10).collect()[0]
    assert r.status.startswith("FAIL") and r.pct_null == Decimal("100.000000000")


def test_reintubated_before_died(spark):
    df = spark.createDataFrame([(1, T0, T0 + h(10), T0 + h(20), 1)],
                               "person_id long, first_weaning timestamp_ntz, "
                               "second_imv_start timestamp_ntz, died_ts timestamp_ntz, "
                               "cohort_criteria long")
    r = outcomes.outcome_classify(df, horizon_hours=48).collect()[0]
    assert (r.weaning_outcome, r.weaning_outcome_detail, r.weaning_failure) == \
           ("failure", "reintubated", 1)


def test_populated_79_5_rounds_to_ok(spark):
    rows = [(i, 1 if i < 159 else None, 1) for i in range(200)]
    df = spark.createDataFrame(rows, "person_id long, x long, cohort_criteria long")
    st = {r.column_name: r for r in quality.table_status(df).collect()}
    assert st["x"].pct_populated == Decimal("80.000000000") and st["x"].status == "OK"


def test_matched_update_with_null_overwrites(spark):
    t = spark.createDataFrame([(1, 5), (2, 6)], "person_id long, c long")
    s = spark.createDataFrame([(1, None)], "person_id long, c long")
    out = {r.person_id: r.c for r in update_from(t, s, "person_id").collect()}
    assert out == {1: None, 2: 6}


def test_condition_patterns_are_case_sensitive_and_dot_literal(spark):
    coh = spark.createDataFrame([(1, T0, T0 + h(48)), (2, T0, T0 + h(48))],
                                "person_id long, admission_start timestamp_ntz, "
                                "admission_end timestamp_ntz")
    cond = spark.createDataFrame([(1, T0 + h(1), "x S.A.B. y"), (2, T0 + h(1), "x SxAxBx y")],
                                 "person_id long, condition_start_datetime timestamp_ntz, "
                                 "condition_source_value string")
    flagged = landmarks.condition_flag(coh, cond, ["%S.A.B.%"]).collect()
    assert [r.person_id for r in flagged] == [1]


def test_left_closed_periods_do_not_double_count(spark):
    ev = events(spark, [(1, T0 + h(2), "a", 5.0, "u", 1)])
    coh = spark.createDataFrame([(1, T0, T0 + h(2), T0 + h(4))],
                                "person_id long, s timestamp_ntz, m timestamp_ntz, "
                                "e timestamp_ntz")
    both = [totals.WindowSpec("p1", ("a",), F.col("s"), F.col("m")),
            totals.WindowSpec("p2", ("a",), F.col("m"), F.col("e"))]
    left = [totals.WindowSpec("p1", ("a",), F.col("s"), F.col("m"), closed="left"),
            totals.WindowSpec("p2", ("a",), F.col("m"), F.col("e"), closed="left")]
    r = totals.window_sums(coh, ev, both).collect()[0]
    assert r.p1 == r.p2 == Decimal("5.000000000")          # reference: counted twice
    r = totals.window_sums(coh, ev, left).collect()[0]
    assert r.p1 is None and r.p2 == Decimal("5.000000000")


def test_open_ended_exposure_option(spark):
    ev = events(spark, [(1, T0 + h(30), "a", 1.0, "u", 1)])
    ex = spark.createDataFrame(
        [(1, "d", T0, None)],
        "person_id long, drug_concept_id string, drug_exposure_start_datetime timestamp_ntz, "
        "drug_exposure_end_datetime timestamp_ntz")
    assert landmarks.not_exposed(ev, ex, ["d"]).count() == 1
    assert landmarks.not_exposed(ev, ex, ["d"], open_ended=True).count() == 0


def test_eligibility_value_options(spark):
    rows = [(1, T0 + h(7), "f", 0.4, "u", 1), (1, T0 + h(7), "p", 5.0, "u", 2),
            (1, T0 + h(9), "f", 30.0, "u", 3), (1, T0 + h(9), "p", 9.0, "u", 4)]
    fact = events(spark, rows)
    coh = spark.createDataFrame([(1, T0, T0, T0 + h(20))],
                                "person_id long, admission_start timestamp_ntz, "
                                "first_imv_start timestamp_ntz, first_imv_end timestamp_ntz")
    ex = spark.createDataFrame([], "person_id long, drug_concept_id string, "
                                   "drug_exposure_start_datetime timestamp_ntz, "
                                   "drug_exposure_end_datetime timestamp_ntz")
    base = dict(first_code="f", second_code="p", second_max=10, tolerance_minutes=30,
                exposure_codes=("d",))
    start = landmarks.eligibility_landmark(
        coh, fact, ex, landmarks.EligibilityRule(**base, value_at="start")).collect()[0]
    assert start.eligible_start_time == T0 + h(7)
    assert (start.eligible_start_fio2, start.eligible_start_peep) == \
           (Decimal("0.400000000"), Decimal("5.000000000"))
    norm = landmarks.eligibility_landmark(
        coh, fact, ex, landmarks.EligibilityRule(**base, first_ranges=((1, 50),),
                                                 normalise_first=True, value_at="start"))
    assert norm.collect()[0].eligible_start_fio2 == Decimal("40.000000000")


def test_segment_search_upper_bound_option(spark):
    df = events(spark, [(1, T0, "a", 1.0, "u", 1), (1, T0 + h(2), "a", 1.0, "u", 2),
                        (1, T0 + h(30), "a", 1.0, "u", 3)])
    coh = spark.createDataFrame([(1, T0, T0 + h(10))],
                                "person_id long, start timestamp_ntz, stop timestamp_ntz")
    open_ = episodes.first_segment(coh, df, ["a"], "start", gap_hours=6).collect()[0]
    bound = episodes.first_segment(coh, df, ["a"], "start", gap_hours=6,
                                   until="stop").collect()[0]
    assert open_.next_segment_ts == T0 + h(30)      # reference: no upper bound
    assert bound.segment_end_ts == T0 + h(2) and bound.next_segment_ts is None


def test_nearest_tie_breaks_are_deterministic(spark):
    L = T0 + h(10)
    m = dt.timedelta(minutes=1)
    rows = [(1, L - h(1) - 20 * m, "a", 1.0, "u", 1),   # 1 h 20 min before
            (1, L + h(1) + 10 * m, "a", 2.0, "u", 2),   # 1 h 10 min after: same hour, nearer
            (2, L - 30 * m, "a", 3.0, "u", 4),          # 30 min before
            (2, L + 30 * m, "a", 4.0, "u", 3),          # 30 min after: tie on seconds
            (3, L, "a", 5.0, "u", 7), (3, L, "a", 6.0, "u", 6)]   # same time: smaller id
    fact = events(spark, rows)
    coh = spark.createDataFrame([(p, L) for p in (1, 2, 3)], "person_id long, lm timestamp_ntz")
    spec = features.FeatureSpec("f", ("a",), 2, 2)
    got = {r.person_id: r.f_at_x for r in
           features.nearest_at_landmark(coh, fact, spec, "lm", suffix="x",
                                        tiebreak="measurement_id").collect()}
    assert got == {1: Decimal("2.000000000"), 2: Decimal("3.000000000"),
                   3: Decimal("6.000000000")}


def test_operators_accept_zoned_timestamps(spark):
    rows = [(1, T0 + h(i * 30), "a", float(i), "u", i) for i in range(5)]
    ntz = events(spark, rows)
    ltz = ntz.withColumn("measurement_datetime", F.col("measurement_datetime").cast("timestamp"))
    a = episodes.gap_episodes(ntz, ["a"], gap_hours=24, min_hours=0, tiebreak="measurement_id")
    b = episodes.gap_episodes(ltz, ["a"], gap_hours=24, min_hours=0, tiebreak="measurement_id")
    key = lambda r: (r.episode_number, r.measurement_count, r.episode_hours)
    assert sorted(map(key, a.collect())) == sorted(map(key, b.collect()))
    coh = spark.createDataFrame([(1, T0 + h(61))], "person_id long, lm timestamp")
    spec = features.FeatureSpec("f", ("a",), 12, 12)
    r = features.nearest_at_landmark(coh, ltz, spec, "lm", suffix="x",
                                     tiebreak="measurement_id").collect()[0]
    assert r.f_at_x == Decimal("2.000000000")


def test_entity_without_events_gets_null_periods_and_zero_24h(spark):
    from cohortkit.plans import weaning
    chain = spark.createDataFrame(
        [(1, T0, T0 + h(30), T0 + h(10), T0 + h(30), 20, 1),
         (2, T0, T0 + h(30), T0 + h(10), T0 + h(30), 20, 1)],
        "person_id long, first_imv_start timestamp_ntz, first_imv_end timestamp_ntz, "
        "eligible_start_time timestamp_ntz, first_weaning timestamp_ntz, "
        "duration_eligible_to_weaning long, cohort_criteria long")
    fact = events(spark, [(1, T0 + h(5), "in", 100.0, "u", 1),
                          (1, T0 + h(20), "out", 40.0, "u", 2)])
    params = weaning.WeaningParams(segment_codes=("x",), segment_gap_hours=6,
                                   rule=landmarks.EligibilityRule(), intake_codes=("in",),
                                   output_codes=("out",))
    inputs = weaning.WeaningInputs(visit=None, measurement=fact, drug_exposure=None, cut=False)
    out = {r.person_id: r for r in weaning.fluid_pass(chain, inputs, params).collect()}
    assert out[1].fluid_intake_imv_to_eligible == Decimal("100.000000000")
    assert out[1].fluid_output_24h_prior == Decimal("40.000000000")
    assert out[1].fluid_balance_24h_prior == Decimal("-40.000000000")
    p2 = out[2]                                  # no events at all
    assert p2.fluid_intake_imv_to_eligible is None and p2.fluid_balance_imv_to_eligible is None
    assert p2.fluid_intake_24h_prior == p2.fluid_output_24h_prior == Decimal("0E-9")
    assert p2.fluid_balance_24h_prior == Decimal("0E-9")


def test_per_code_exposure_windows(spark):
    ev = events(spark, [(1, T0 + h(4), "a", 1.0, "u", 1), (2, T0 + h(4), "a", 1.0, "u", 2)])
    ex = spark.createDataFrame(
        [(1, "norad", T0, T0 + h(1)), (2, "propofol", T0, T0 + h(1))],
        "person_id long, drug_concept_id string, drug_exposure_start_datetime timestamp_ntz, "
        "drug_exposure_end_datetime timestamp_ntz")
    # event 3 h after the end: excluded by a 3 h wash-out, kept with a 1 h one
    kept = landmarks.not_exposed(ev, ex, {"norad": (6, 1), "propofol": (6, 3)}).collect()
    assert [r.person_id for r in kept] == [1]


def test_optional_24h_rate_slopes(spark):
    from cohortkit.plans import weaning
    chain = spark.createDataFrame([(1, T0, T0 + h(30), T0 + h(10), T0 + h(30), 20, 1)],
                                  "person_id long, first_imv_start timestamp_ntz, "
                                  "first_imv_end timestamp_ntz, eligible_start_time timestamp_ntz, "
                                  "first_weaning timestamp_ntz, duration_eligible_to_weaning long, "
                                  "cohort_criteria long")
    fact = events(spark, [(1, T0 + h(20), "in", 48.0, "u", 1)])
    params = weaning.WeaningParams(segment_codes=("x",), segment_gap_hours=6,
                                   rule=landmarks.EligibilityRule(), intake_codes=("in",),
                                   output_codes=("out",), slopes_24h=True)
    inputs = weaning.WeaningInputs(visit=None, measurement=fact, drug_exposure=None, cut=False)
    r = weaning.fluid_pass(chain, inputs, params).collect()[0]
    assert r.fluid_intake_24h_prior_slope == Decimal("2.000000000")


def test_time_buckets_ignore_session_time_zone(spark):
    from cohortkit.functions.timecalc import time_bucket
    # the spring-forward gap of 2024 in New York: 02:00-03:00 on 10 March
    rows = [(dt.datetime(2024, 3, 10, 1, 59),), (dt.datetime(2024, 3, 10, 2, 30),),
            (dt.datetime(2024, 3, 10, 3, 10),)]
    df = spark.createDataFrame(rows, "t timestamp_ntz")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = [r.b for r in df.select(time_bucket("t", 0.25).alias("b")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == sorted(got) and len(set(got)) == 3
