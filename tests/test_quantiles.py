"""Exact quantiles against numpy and DuckDB."""

import random

import duckdb
import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cohortkit.operators import explore
from cohortkit.operators.quantiles import order_number, quantiles

PROBS, NAMES = [0.0, 0.1, 0.25, 0.5, 0.75, 1.0], ["q0", "q10", "q25", "q50", "q75", "q100"]


def test_order_number_has_the_order_of_doubles(spark):
    rng = random.Random(3)
    xs = [0.0, -0.0, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308,
          1.7976931348623157e308, -1.7976931348623157e308, float("inf"), float("-inf"), float("nan")]
    for k in range(-1022, 1024, 31):
        xs += [2.0 ** k, float(np.nextafter(2.0 ** k, 0)), -float(np.nextafter(2.0 ** k, 9e307))]
    xs += [rng.uniform(-1, 1) * 10 ** rng.randint(-300, 300) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in df.select("x", order_number(F.col("x")).alias("k")).collect():
        bits = int(np.float64(abs(r.x)).view(np.int64))
        want = 2 ** 63 - 1 if r.x != r.x else bits if r.x > 0 else -bits
        assert r.k == want, r.x


def test_quantiles_of_groups_equal_duckdb(spark):
    rng = random.Random(5)
    rows = [("hot", rng.gauss(0, 1e6)) for _ in range(4000)] + [("ties", 7.5)] * 300 \
        + [("ties", -7.5)] * 100 + [(None, float(i)) for i in range(7)] + [("one", 3.25)] \
        + [("none", None)] * 3 + [("hot", None)] * 5
    pdf = pd.DataFrame(rows, columns=["g", "x"])
    df = spark.createDataFrame(rows, "g string, x double").repartition(7)
    for interpolate, f in ((False, "quantile_disc"), (True, "quantile_cont")):
        want = {r[0]: r[1] for r in duckdb.sql(
            f"SELECT g, {f}(x, {PROBS}) FROM pdf WHERE NOT isnan(x) GROUP BY g").fetchall()}
        got = {r[0]: list(r[1:]) for r in
               quantiles(df, ["g"], "x", PROBS, NAMES, interpolate).collect()}
        assert set(got) == set(want) == {"hot", "ties", "one", None}
        for g in got:
            assert np.allclose(got[g], want[g], rtol=1e-12, atol=0)
            assert interpolate or got[g] == want[g]


def test_quantiles_of_longs_keep_every_digit_and_their_type(spark):
    xs = [2 ** 62 + i for i in range(50)] + [-2 ** 63, 2 ** 63 - 1, 0, -1]
    df = spark.createDataFrame([(x,) for x in xs], "x long")
    out = quantiles(df, [], "x", [0.0, 0.5, 1.0], ["a", "b", "c"])
    assert dict(out.dtypes) == {"a": "bigint", "b": "bigint", "c": "bigint"}
    assert tuple(out.collect()[0]) == (-2 ** 63, sorted(xs)[(len(xs) + 1) // 2 - 1], 2 ** 63 - 1)


def test_no_values_give_one_row_of_nulls(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    for interpolate in (False, True):
        assert [tuple(r) for r in quantiles(df, [], "x", [0.5], ["m"], interpolate).collect()] == [(None,)]
    r = explore.describe_values(df, "x").collect()[0]
    assert (r["count"], r["p50"], r["max"]) == (0, None, None)


def test_describe_values_is_the_same_bounded_or_not(spark):
    rng = random.Random(8)
    df = spark.createDataFrame([("a" if i % 3 else None, rng.uniform(-5, 5)) for i in range(400)]
                               + [("nulls", None)], "g string, x double")
    key = lambda r: str(r.g)
    a = sorted(explore.describe_values(df, "x", ["g"]).collect(), key=key)
    b = sorted(explore.describe_values(df, "x", ["g"], bounded=True).collect(), key=key)
    assert a == b and len(a) == 3


def test_windows_stand_on_aggregates_by_cells(spark):
    df = spark.range(1000).select((F.col("id") * 0.5).alias("x"))
    lines = quantiles(df, [], "x", [0.5], ["m"])._jdf.queryExecution().optimizedPlan().toString().split("\n")
    ops = [line.lstrip(" :+-") for line in lines]
    windows = [i for i, op in enumerate(ops) if op.startswith("Window")]
    assert windows
    for i in windows:
        below = next(op for op in ops[i + 1:] if not op.startswith(("Window", "Project", "Filter")))
        assert below.startswith("Aggregate"), below
