"""Every registered query against its DuckDB twin on the smallest dataset."""

import os

import pytest

import __spark_entry__ as entry
from cohortkit.plans.registry import QUERIES as REGISTERED
import tools.oracle_check as oc
from tools.oracle_check import duck, rows_of

oc.STRICT = True   # exact values: no float tolerance

SF_DIR = "/root/testdata/sf0.001"
NAMES = sorted(REGISTERED)   # the training-data queries have tests of their own

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test data not present")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF_DIR)
    srows = [tuple(r) for r in sdf.collect()]
    sql = entry.oracle_sql().get(name)
    assert sql is not None, f"{name} has no oracle"
    cur = con.execute(sql)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert rows_of(sdf.columns, srows) == rows_of(dcols, drows)


def test_entry_returns_all_entities(spark, con):
    df = entry.entry(spark)
    n = df.count()
    users = con.execute("SELECT COUNT(DISTINCT user_id) FROM events").fetchall()[0][0]
    assert n == users > 0


BUCKET_PATH_QUERIES = ["first_event_after", "first_segment", "eligibility_landmark",
                       "nearest_at_landmark", "feature_set_two_landmarks", "window_sum",
                       "fluid_balance", "weaning_cohort", "wide_assemble"]


@pytest.mark.parametrize("name", BUCKET_PATH_QUERIES)
def test_shuffled_cohort_join_matches_oracle(spark, con, name):
    """The cohort joins shuffle when broadcasting is switched off, as for a
    large cohort; the result must not change."""
    from cohortkit.plans import registry as R
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    saved = dict(R._CHAINS), dict(R._WIDE)
    R._CHAINS.clear()
    R._WIDE.clear()
    try:
        sdf = entry.queries()[name](spark, SF_DIR)
        srows = [tuple(r) for r in sdf.collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        R._CHAINS.clear()
        R._WIDE.clear()
        R._CHAINS.update(saved[0])
        R._WIDE.update(saved[1])
    cur = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert rows_of(sdf.columns, srows) == rows_of(dcols, cur.fetchall())
