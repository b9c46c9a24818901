"""Properties from the survey's test strategy, on generated data."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cohortkit.operators import episodes, outcomes

T0 = dt.datetime(2024, 1, 1)
SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])

event_lists = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 24 * 60 * 20)),
                       min_size=1, max_size=120)


@SETTINGS
@given(rows=event_lists, gap=st.sampled_from([1, 6, 24]))
def test_episodes_partition_the_events(spark, rows, gap):
    data = [(e, T0 + dt.timedelta(minutes=m), i) for i, (e, m) in enumerate(rows)]
    df = spark.createDataFrame(data, "person_id long, measurement_datetime timestamp_ntz, "
                                     "measurement_id long") \
              .withColumn("measurement_concept_id", F.lit("a"))
    ep = episodes.gap_episodes(df, None, gap_hours=gap, min_hours=0,
                               tiebreak="measurement_id", slice_hours=5.0).collect()
    assert sum(r.measurement_count for r in ep) == len(data)
    by_entity = {}
    for r in ep:
        by_entity.setdefault(r.person_id, []).append(r)
    for rs in by_entity.values():
        rs.sort(key=lambda r: r.episode_number)
        assert [r.episode_number for r in rs] == list(range(1, len(rs) + 1))
        for a, b in zip(rs, rs[1:]):      # episodes are disjoint and ordered
            assert a.episode_end <= b.episode_start


@SETTINGS
@given(st.lists(st.tuples(st.integers(-100, 200), st.integers(-100, 200),
                          st.booleans(), st.booleans()), min_size=1, max_size=40))
def test_success_and_failure_split_the_cohort(spark, rows):
    data = []
    for i, (s2, d, has2, hasd) in enumerate(rows):
        data.append((i, T0, T0 + dt.timedelta(hours=s2) if has2 else None,
                     T0 + dt.timedelta(hours=d) if hasd else None, 1 if i % 3 else None))
    df = spark.createDataFrame(data, "person_id long, first_weaning timestamp_ntz, "
                                     "second_imv_start timestamp_ntz, died_ts timestamp_ntz, "
                                     "cohort_criteria long")
    for r in outcomes.outcome_classify(df, horizon_hours=48).collect():
        if r.cohort_criteria == 1:
            assert r.weaning_success + r.weaning_failure == 1
            assert r.weaning_outcome_detail in (None, "reintubated", "died")
        else:
            assert r.weaning_success == r.weaning_failure == 0 and r.weaning_outcome is None


@SETTINGS
@given(st.lists(st.integers(0, 500), min_size=2, max_size=60))
def test_increments_do_not_depend_on_slicing(spark, values):
    rows = [(1, T0 + dt.timedelta(hours=i), i, float(v)) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "e long, t timestamp_ntz, n long, v double")
    whole = episodes.cumulative_to_incremental(df, entity="e", order=["t", "n"], value="v",
                                               slice_hours=3.0)
    small = episodes.cumulative_to_incremental(df, entity="e", order=["t", "n"], value="v",
                                               slice_hours=1000.0)
    a = sorted((r.n, r.incremental) for r in whole.collect())
    b = sorted((r.n, r.incremental) for r in small.collect())
    assert a == b
    # increments never exceed the running value and sum to at least the last value
    assert all(inc <= values[n] for n, inc in a)
    assert sum(inc for _, inc in a) >= values[-1]
