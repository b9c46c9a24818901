"""A third of the facts in one entity, no broadcast: adaptive execution splits the
entity's rows in every operator that meets the facts, and results stay the same."""

import contextlib
import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortkit.operators import episodes, features, ordered, totals

T0 = dt.datetime(2020, 1, 1)
CONF = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2", "spark.sql.shuffle.partitions": "12"}


@contextlib.contextmanager
def settings(spark, conf):
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def inputs(spark):
    n = 240_000
    facts = spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 500 + 1).alias("person_id"),
        (F.lit(T0) + F.make_dt_interval(mins=F.pmod(F.xxhash64("id"), F.lit(60 * 24 * 60)).cast("int"))).cast("timestamp_ntz").alias("measurement_datetime"),
        F.lit("c").alias("measurement_concept_id"), (F.pmod(F.xxhash64("id", F.lit(1)), F.lit(1000)) / 10).alias("value_as_number"),
        F.col("id").alias("measurement_id"))
    cohort = spark.range(501).select(F.col("id").alias("person_id"), F.lit(T0 + dt.timedelta(days=5)).cast("timestamp_ntz").alias("start"),
                                     F.lit(T0 + dt.timedelta(days=40)).cast("timestamp_ntz").alias("landmark"))
    return facts, cohort


SPEC = features.FeatureSpec("f", ("c",), 24 * 30)


def nearest(facts, cohort):
    return features.nearest_at_landmark(cohort, facts, SPEC, "landmark", tiebreak="measurement_id")


def fused(facts, cohort):
    return features.extract_features(cohort, facts, [SPEC], {"a": "landmark", "b": "start"}, tiebreak="measurement_id")


def sums(facts, cohort):
    return totals.window_sum(cohort, facts, ["c"], F.col("start"), F.col("landmark"))


def first_event(facts, cohort):
    return episodes.first_event_after(cohort, facts, ["c"], "start")


def first_segment(facts, cohort):
    return episodes.first_segment(cohort, facts, ["c"], "start", gap_hours=1, tiebreak="measurement_id")


@pytest.mark.parametrize("operator", [nearest, fused, sums, first_event, first_segment])
def test_hot_entity_is_split(spark, inputs, operator):
    plain = sorted(map(tuple, operator(*inputs).collect()), key=str)
    with settings(spark, CONF):
        df = operator(*inputs)
        assert sorted(map(tuple, df.collect()), key=str) == plain and len(plain) == 501
        plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin(skew=true)" in plan, plan[:3000]


def test_segments_are_windowed_by_slice(spark, inputs):
    with settings(spark, CONF):
        df = first_segment(*inputs)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
    # the window's exchange is by (entity, slice); nothing but summaries is windowed by the entity
    assert "hashpartitioning(_slice" in plan


def test_rows_of_one_instant_are_cut(spark, monkeypatch):
    monkeypatch.setattr(ordered, "AUTO_TARGET_ROWS", 200)
    df = spark.range(0, 6000, 1, 4).select(
        F.when(F.col("id") < 5000, 0).otherwise(F.col("id")).alias("e"), F.lit(T0).cast("timestamp_ntz").alias("t"), "id",
        (F.col("id") % 7).alias("v"))
    sizes = ordered.add_slice(df, "t", "auto", ["e"], tiebreak="id").filter("e = 0").groupBy("_slice").count().collect()
    assert len(sizes) >= 12 and max(r["count"] for r in sizes) <= 1000
    w = Window.partitionBy("e").orderBy("t", "id")
    got = ordered.with_neighbors(df, "e", "t", "id", ["v"], prev=True, next=True, slice_hours="auto")
    want = df.select("*", F.lag("v").over(w).alias("prev_v"), F.lead("v").over(w).alias("next_v"))
    assert sorted(got.select("id", "prev_v", "next_v").collect(), key=str) == sorted(want.select("id", "prev_v", "next_v").collect(), key=str)
    total = ordered.running_sum(df, "e", "t", "id", "v", "cum", slice_hours="auto")
    want = df.select("id", F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("cum"))
    assert sorted(total.select("id", "cum").collect()) == sorted(want.collect())
    numbered = ordered.segment_numbers(df, "e", "t", "id", lambda prev, cur: cur > prev, "seg", slice_hours="auto")
    assert {r["seg"] for r in numbered.collect()} == {1}
