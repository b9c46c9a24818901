"""The skew-safe operators give the same answers as the plain forms."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cohortkit.operators import bands, features, ordered
from cohortkit.plans.widetable import assemble, update_from

T0 = dt.datetime(2024, 1, 1)


def random_events(spark, seed, n_entities=6, hot=400, cold=30, span_h=24 * 10):
    rnd = random.Random(seed)
    rows, eid = [], 0
    for e in range(n_entities):
        n = hot if e == 0 else rnd.randint(0, cold)   # entity 0 is the hot key
        for _ in range(n):
            t = T0 + dt.timedelta(seconds=rnd.randint(0, span_h * 3600))
            if rnd.random() < 0.1 and rows:          # exact time ties
                t = rows[-1][1]
            rows.append((e, t, eid, rnd.choice(["a", "b"]), float(rnd.randint(0, 100))))
            eid += 1
    return spark.createDataFrame(rows, "e long, t timestamp_ntz, id long, c string, v double")


@pytest.mark.parametrize("seed,slice_hours", [(1, 24.0), (2, 1.0), (3, 0.25), (4, 240.0)])
def test_neighbors_equal_plain_lag_lead(spark, seed, slice_hours):
    df = random_events(spark, seed)
    got = ordered.with_neighbors(df, "e", "t", "id", ["t", "v"], prev=True, next=True,
                                 slice_hours=slice_hours)
    w = Window.partitionBy("e").orderBy("t", "id")
    want = df.select("*", F.lag("t").over(w).alias("prev_t"), F.lag("v").over(w).alias("prev_v"),
                     F.lead("t").over(w).alias("next_t"), F.lead("v").over(w).alias("next_v"))
    cols = ["e", "t", "id", "c", "v", "prev_t", "prev_v", "next_t", "next_v"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())


@pytest.mark.parametrize("seed,slice_hours", [(5, 24.0), (6, 0.5)])
def test_running_sum_equals_plain_window(spark, seed, slice_hours):
    df = random_events(spark, seed)
    got = ordered.running_sum(df, "e", "t", "id", "v", "cum", slice_hours=slice_hours)
    w = Window.partitionBy("e").orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("cum", F.sum("v").over(w))
    assert sorted(got.select("id", "cum").collect()) == sorted(want.select("id", "cum").collect())


@pytest.mark.parametrize("how", ["inner", "left_semi", "left_anti", "left"])
@pytest.mark.parametrize("bucket_hours", [1.0, 6.0, 48.0])
def test_interval_join_equals_brute_force(spark, how, bucket_hours):
    rnd = random.Random(7)
    pts = spark.createDataFrame(
        [(rnd.randint(0, 3), T0 + dt.timedelta(minutes=rnd.randint(0, 60 * 72)), i)
         for i in range(300)], "e long, t timestamp_ntz, pid long")
    ivs = []
    for j in range(40):
        s = T0 + dt.timedelta(minutes=rnd.randint(0, 60 * 72))
        end = None if j % 9 == 0 else s + dt.timedelta(minutes=rnd.randint(0, 60 * 20))
        ivs.append((rnd.randint(0, 3), s, end, j))
    iv = spark.createDataFrame(ivs, "e long, s timestamp_ntz, x timestamp_ntz, iid long")
    got = bands.interval_join(pts, iv, "e", "t", F.col("s"), F.col("x"), how=how,
                              bucket_hours=bucket_hours)
    cond = (pts.e == iv.e) & pts.t.between(iv.s, iv.x)
    want = pts.join(iv, cond, how)
    if how in ("inner", "left"):
        want = want.select(pts.e, pts.t, pts.pid, iv.s, iv.x, iv.iid)
    assert sorted(got.collect(), key=str) == sorted(want.collect(), key=str)


def test_long_intervals_take_two_rows_at_most(spark):
    pts = spark.createDataFrame([(1, T0 + dt.timedelta(hours=h), h) for h in (0, 3, 30)]
                                + [(2, T0, 100)], "e long, t timestamp_ntz, pid long")
    iv = spark.createDataFrame(
        [(1, T0 + dt.timedelta(hours=2), dt.datetime(9999, 12, 31), 0),   # open to a far date
         (1, T0 - dt.timedelta(days=7300), T0 + dt.timedelta(hours=4), 1),  # 20 years
         (1, T0 + dt.timedelta(days=9), dt.datetime(9999, 12, 31), 2),    # after all points
         (2, T0, None, 3), (3, T0, dt.datetime(9999, 12, 31), 4)],       # no end, no points
        "e long, s timestamp_ntz, x timestamp_ntz, iid long")
    rows = bands.interval_cells(iv, F.col("s"), F.col("x"), 1.0)
    counts = {r.iid: r["count"] for r in rows.groupBy("iid").count().collect()}
    assert set(counts) == {0, 1, 2, 4} and max(counts.values()) <= 2   # however long
    got = bands.interval_join(pts, iv, "e", "t", F.col("s"), F.col("x"), bucket_hours=1.0)
    assert sorted((r.pid, r.iid) for r in got.collect()) == [(0, 1), (3, 0), (3, 1), (30, 0)]
    left = bands.interval_join(pts, iv, "e", "t", F.col("s"), F.col("x"), how="left_anti",
                               bucket_hours=1.0)
    assert [r.pid for r in left.collect()] == [100]
    ids = bands.intervals_with_points(iv, pts, "e", ["iid"], "t", F.col("s"), F.col("x"), 1.0)
    assert sorted(r.iid for r in ids.collect()) == [0, 1]


def test_fused_features_equal_single_feature(spark):
    rnd = random.Random(11)
    rows = []
    for i in range(2000):
        e = rnd.randint(0, 20)
        rows.append((e, T0 + dt.timedelta(minutes=rnd.randint(0, 60 * 96)),
                     rnd.choice(["a", "b", "c"]), rnd.random() * 120,
                     rnd.choice(["u", "%", None]), i))
    fact = spark.createDataFrame(rows, "person_id long, measurement_datetime timestamp_ntz, "
                                       "measurement_concept_id string, value_as_number double, "
                                       "unit_source_value string, measurement_id long")
    coh = spark.createDataFrame(
        [(e, T0 + dt.timedelta(hours=rnd.randint(10, 80)),
          None if e % 5 == 0 else T0 + dt.timedelta(hours=rnd.randint(10, 80)))
         for e in range(21)], "person_id long, la timestamp_ntz, lb timestamp_ntz")
    specs = [features.FeatureSpec("f", ("a",), 6, 0, value_range=(0.1, 100),
                                  fraction_to_percent=True, unit_not="%"),
             features.FeatureSpec("g", ("b", "c"), 3, 3, unit_equals="u")]
    fused = features.extract_features(coh, fact, specs, {"x": "la", "y": "lb"},
                                      tiebreak="measurement_id")
    fused_rows = {r.person_id: r for r in fused.collect()}
    for spec in specs:
        for sfx, lm in (("x", "la"), ("y", "lb")):
            single = features.nearest_at_landmark(coh, fact, spec, lm, suffix=sfx,
                                                  tiebreak="measurement_id")
            col = f"{spec.name}_at_{sfx}"
            for r in single.collect():
                fr = fused_rows[r.person_id]
                assert (fr[col], fr[f"{col}_time"]) == (r[col], r[f"{col}_time"])
            n_fused = sum(1 for r in fused_rows.values() if r[col] is not None
                          or r[f"{col}_time"] is not None)
            assert n_fused == single.count()


def test_update_is_idempotent_and_passes_commute(spark):
    base = spark.createDataFrame([(i, None, None) for i in range(10)],
                                 "person_id long, a long, b long")
    pa = lambda t: spark.createDataFrame([(i, i * 2) for i in range(0, 10, 2)],  # noqa
                                         "person_id long, a long")
    pb = lambda t: spark.createDataFrame([(i, i * 3) for i in range(0, 10, 3)],  # noqa
                                         "person_id long, b long")
    once = update_from(base, pa(base), "person_id")
    twice = update_from(once, pa(base), "person_id")
    assert sorted(once.collect()) == sorted(twice.collect())
    ab = assemble(base, "person_id", [pa, pb])
    ba = assemble(base, "person_id", [pb, pa])
    assert sorted(ab.collect()) == sorted(ba.select(*ab.columns).collect())
    with pytest.raises(ValueError):
        assemble(base, "person_id", [pa, pa])


def test_auto_slices_split_a_dense_hot_entity(spark, monkeypatch):
    from cohortkit.operators import ordered as O
    monkeypatch.setattr(O, "AUTO_TARGET_ROWS", 50)
    df = random_events(spark, 21, hot=600, span_h=6)     # 600 rows within 6 hours
    sliced = O.add_slice(df, "t", "auto", ["e"], target_rows=50)
    per_slice = sliced.filter("e = 0").groupBy("_slice").count().collect()
    assert len(per_slice) >= 8 and max(r["count"] for r in per_slice) <= 150
    got = O.with_neighbors(df, "e", "t", "id", ["t"], prev=True, next=True, slice_hours="auto")
    w = Window.partitionBy("e").orderBy("t", "id")
    want = df.select("*", F.lag("t").over(w).alias("prev_t"), F.lead("t").over(w).alias("next_t"))
    cols = ["id", "prev_t", "next_t"]
    assert sorted(got.select(cols).collect()) == sorted(want.select(cols).collect())


@pytest.mark.parametrize("bucket_hours", [2.0, 24.0])
def test_intervals_with_points_equals_brute_force(spark, bucket_hours):
    rnd = random.Random(13)
    iv = spark.createDataFrame(
        [(rnd.randint(0, 4), T0 + dt.timedelta(hours=rnd.randint(0, 100)), j) for j in range(60)],
        "e long, s timestamp_ntz, iid long").withColumn("x", F.col("s") + F.expr("interval 5 hours"))
    pts = spark.createDataFrame(
        [(rnd.randint(0, 4), T0 + dt.timedelta(minutes=rnd.randint(0, 6000))) for _ in range(80)],
        "e long, t timestamp_ntz")
    got = bands.intervals_with_points(iv, pts, "e", ["iid"], "t", F.col("s"), F.col("x"),
                                      bucket_hours=bucket_hours)
    want = (iv.join(pts, (iv.e == pts.e) & pts.t.between(iv.s, iv.x), "left_semi")
              .select("e", "iid").distinct())
    assert sorted(got.collect()) == sorted(want.collect())


@pytest.mark.parametrize("seed", [3, 4])
def test_pair_free_eligibility_equals_pairs(spark, seed):
    import dataclasses
    from cohortkit.operators import landmarks
    rnd = random.Random(seed)
    rows, i = [], 0
    for e in range(5):
        n = 300 if e == 0 else 40
        for _ in range(n):
            t = T0 + dt.timedelta(minutes=10 * rnd.randint(0, 600))   # 10-min grid: exact ties
            code = rnd.choice(["f", "p"])
            v = float(rnd.choice([0.3, 0.4, 21, 30, 40, 45, 5, 8, 10] if code == "f"
                                 else [4, 5, 6, 8, 10]))
            rows.append((e, t, code, v, "u", i))
            i += 1
            if rnd.random() < 0.1:                                     # exact duplicate row
                rows.append((e, t, code, v, "u", i))
                i += 1
    fact = spark.createDataFrame(rows, "person_id long, measurement_datetime timestamp_ntz, "
                                       "measurement_concept_id string, value_as_number double, "
                                       "unit_source_value string, measurement_id long")
    coh = spark.createDataFrame([(e, T0, T0, T0 + dt.timedelta(hours=100)) for e in range(5)],
                                "person_id long, admission_start timestamp_ntz, "
                                "first_imv_start timestamp_ntz, first_imv_end timestamp_ntz")
    ex = spark.createDataFrame([(0, "d", T0 + dt.timedelta(hours=20), T0 + dt.timedelta(hours=22))],
                               "person_id long, drug_concept_id string, "
                               "drug_exposure_start_datetime timestamp_ntz, "
                               "drug_exposure_end_datetime timestamp_ntz")
    rule = landmarks.EligibilityRule(first_code="f", second_code="p", second_max=9,
                                     tolerance_minutes=30, exposure_codes=("d",))
    pairs = landmarks.eligibility_landmark(
        coh, fact, ex, dataclasses.replace(rule, pairing="pairs")).collect()
    counts = landmarks.eligibility_landmark(coh, fact, ex, rule).collect()
    assert rule.pairing == "counts"
    assert sorted(pairs) == sorted(counts) and len(pairs) >= 4


@pytest.mark.parametrize("seed,slice_hours,gap", [(31, 24.0, 6), (32, 0.5, 1), (33, 240.0, 24)])
def test_segment_numbers_equal_lag_and_running_sum(spark, seed, slice_hours, gap):
    from cohortkit.functions.timecalc import whole_hours
    df = random_events(spark, seed)
    is_new = lambda prev, cur: whole_hours(prev, cur) > gap
    got = ordered.segment_numbers(df, "e", "t", "id", is_new, "seg", slice_hours=slice_hours)
    w = Window.partitionBy("e").orderBy("t", "id")
    prev = F.lag("t").over(w)
    flags = df.withColumn("_f", F.when(prev.isNull() | is_new(prev, F.col("t")), 1).otherwise(0))
    want = flags.withColumn("seg", F.sum("_f").over(
        w.rowsBetween(Window.unboundedPreceding, 0)))
    assert sorted(got.select("id", "seg").collect()) == sorted(want.select("id", "seg").collect())
