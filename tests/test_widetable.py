"""Wide-table lifecycle: declaration, reset, base rows, snapshots, catalogue."""

import datetime as dt
import os
import tempfile
from decimal import Decimal

from pyspark.sql import functions as F

from cohortkit.plans import catalogue
from cohortkit.plans.widetable import WideColumn, WideSchema, snapshot, update_where
from cohortkit.sources import tables


def test_declared_schema_defaults_and_empty_table(spark):
    schema = catalogue.wide_schema()
    empty = schema.empty(spark)
    assert empty.count() == 0 and empty.columns == schema.names
    base = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2))],
                                 "person_id long, admission_start timestamp_ntz, "
                                 "admission_end timestamp_ntz")
    row = schema.base_rows(base).collect()[0]
    assert row.cumulative_value_period_1 == Decimal("0E-9") and row.outcome_flag == 0
    assert row.feature_1_at_a is None and row.cohort_criteria is None
    ddl = schema.ddl("cohort")
    assert "CUMULATIVE_VALUE_PERIOD_1" not in ddl and "DEFAULT 0" in ddl


def test_update_where_reads_old_row(spark):
    df = spark.createDataFrame([(1, 5, 0), (2, 7, 1)], "k long, a long, b long")
    out = update_where(df, {"a": F.col("b"), "b": F.col("a")}, F.col("k") == 1)
    assert sorted(map(tuple, out.collect())) == [(1, 0, 5), (2, 7, 1)]


def test_snapshot_round_trip(spark):
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    path = os.path.join(tempfile.mkdtemp(prefix="cohortkit-test-"), "snap")
    back = snapshot(df, path)
    assert sorted(back.collect()) == sorted(df.collect())


def test_schema_catalogue_numeric_only(spark):
    ev = spark.createDataFrame([(1, "a", 2.0)], "id long, name string, v double")
    rows = tables.schema_frame(spark, ev, numeric_only=True).collect()
    assert [(r.ordinal_position, r.column_name) for r in rows] == [(1, "id"), (3, "v")]


def test_sorted_fact_layout_keeps_rows_and_sorts_files(spark):
    from cohortkit.sources import bindings, layout
    m = bindings.measurement(spark, "/root/testdata/sf0.001")
    path = os.path.join(tempfile.mkdtemp(prefix="cohortkit-test-"), "facts")
    out = layout.write_sorted_facts(m, path, files=4)
    assert out.count() == m.count()
    # each file holds a contiguous code range: per file, codes are sorted
    per_file = (out.withColumn("f", F.input_file_name())
                   .groupBy("f").agg(F.min("measurement_concept_id").alias("lo"),
                                     F.max("measurement_concept_id").alias("hi"))
                   .orderBy("lo").collect())
    for a, b in zip(per_file, per_file[1:]):
        assert a.hi <= b.lo


def test_reference_style_sql_through_views(spark):
    from cohortkit.sources import bindings
    names = bindings.register_views(spark, "/root/testdata/sf0.001")
    assert "measurement" in names
    q = """
    SELECT measurement_concept_id, COUNT(*) AS measurement_count,
           COUNT(DISTINCT person_id) AS patient_count
    FROM measurement WHERE measurement_concept_id IN (:a, :b)
    GROUP BY measurement_concept_id ORDER BY measurement_count DESC
    """
    rows = spark.sql(q, args={"a": "view", "b": "click"}).collect()
    assert {r.measurement_concept_id for r in rows} == {"view", "click"}


def test_catalogued_table_keeps_its_readers(spark):
    import uuid

    from cohortkit.plans.widetable import CatalogTable
    schema = WideSchema([WideColumn("person_id", "bigint"), WideColumn("a", "bigint", 0), WideColumn("b", "string")])
    table = CatalogTable(spark, f"wide_{uuid.uuid4().hex}", schema)
    assert table.create().count() == 0
    rows = spark.createDataFrame([(1, "x"), (2, "y")], "person_id long, b string")
    loaded = table.insert(rows)
    assert sorted(map(tuple, loaded.collect())) == [(1, 0, "x"), (2, 0, "y")]
    table.apply(lambda t: update_where(t, {"a": F.lit(7).cast("long")}, F.col("person_id") == 2))
    assert spark.table(table.name).agg(F.sum("a")).first()[0] == 7
    for emptied in (table.truncate, table.reset):
        table.insert(rows)
        before = table.read()
        assert emptied().count() == 0 and spark.table(table.name).columns == ["person_id", "a", "b"]
        assert before.count() > 0 and loaded.count() == 2  # readers keep what they began with
    table.expire()
    assert len(table.versions) == 1 and spark.table(table.name).count() == 0


def test_column_profile_shuffles_digests(spark):
    from cohortkit.sources.tables import column_profile
    long = ["x" * 10_000 + str(i % 3) for i in range(30)]
    df = spark.createDataFrame([(i, t, None if i % 2 else "s") for i, t in enumerate(long)], "i int, t string, s string")
    got = {r.column_name: (r.row_count, r.non_null_count, r.distinct_count) for r in column_profile(spark, df).collect()}
    assert got == {"i": (30, 30, 30), "t": (30, 30, 3), "s": (30, 15, 1)}
