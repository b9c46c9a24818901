"""Exploration operators on tiny hand-made frames."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from cohortkit.operators import explore

T0 = dt.datetime(2024, 1, 1)
CONCEPT = "concept_id long, concept_name string, domain_id string, vocabulary_id string, " \
          "concept_class_id string, standard_concept string"
FACT = "person_id long, measurement_concept_id long, measurement_datetime timestamp_ntz, " \
       "value_as_number double, unit_source_value string"


def concepts(spark):
    return spark.createDataFrame([(1, "FiO2 setting", "M", "V", "C", "S"),
                                  (2, "fio2 measured", "M", "V", "C", "S"),
                                  (3, "PEEP", "M", "V", "C", "S")], CONCEPT)


def facts(spark):
    rows = [(p, c, T0 + dt.timedelta(hours=i), v, u)
            for i, (p, c, v, u) in enumerate([(1, 1, 1.0, "%"), (1, 1, 2.0, "%"), (2, 1, 2.0, "a"),
                                               (2, 2, 0.005, "a"), (3, 2, 0.0, "a"),
                                               (3, 3, 5.0, "b")])]
    return spark.createDataFrame(rows, FACT)


def test_concept_search_is_case_insensitive(spark):
    names = [r.concept_name for r in explore.concept_search(concepts(spark), "FIO2").collect()]
    assert names == ["FiO2 setting", "fio2 measured"]


def test_cross_reference_mean_rounds_half_up_exactly(spark):
    rows = {r.measurement_concept_id: r for r in
            explore.concept_cross_reference(facts(spark), concepts(spark), [1, 2]).collect()}
    assert rows[1].measurement_count == 3 and rows[1].patient_count == 2
    assert rows[1].mean_value == Decimal("1.670000000")       # 5/3 = 1.666... -> 1.67
    assert rows[2].mean_value == Decimal("0.000000000")       # 0.0025 -> 0.00 (2 digits)


def test_top_measured_breaks_count_ties_by_code(spark):
    got = [r.measurement_concept_id for r in
           explore.top_measured(facts(spark), concepts(spark), k=2).collect()]
    assert got == [1, 2]


def test_spot_check_sample_is_repeatable(spark):
    a = explore.spot_check(facts(spark), concepts(spark), 1, n_entities=1).collect()
    b = explore.spot_check(facts(spark), concepts(spark), 1, n_entities=1).collect()
    assert a == b and {r.person_id for r in a} == {1}


def test_co_occurrence(spark):
    f = facts(spark)
    assert [r.person_id for r in explore.co_occurrence_all(f, [2, 3]).collect()] == [3]
    r = explore.co_occurrence_compare(f, 1, [1, 2]).collect()[0]
    assert (r.single_count, r.all_count) == (2, 1)


def test_empty_table_guards(spark):
    empty = spark.createDataFrame([], FACT)
    p = explore.population_rate(empty, "unit_source_value").collect()[0]
    assert p.total_rows == 0 and p.pct_populated is None and p.meets_threshold == 0
    t = explore.table_population(empty).collect()[0]
    assert (t.row_count, t.is_empty) == (0, 1)


def test_yearly_duplicates_counts_exact_copies(spark):
    v = spark.createDataFrame([(1, T0, T0), (1, T0, T0), (1, T0 + dt.timedelta(days=2), T0),
                               (2, T0, None)],
                              "person_id long, visit_start_datetime timestamp_ntz, "
                              "visit_end_datetime timestamp_ntz")
    r = explore.yearly_duplicates(v).collect()[0]
    assert (r.unique_patients, r.total_rows, r.duplicate_rows, r.exact_duplicate_rows) == \
           (2, 4, 2, 1)


def test_variable_search_per_source_threshold_and_top_k(spark):
    f = facts(spark).join(concepts(spark).select(F.col("concept_id").alias(
        "measurement_concept_id"), "concept_name"), "measurement_concept_id")
    src = [explore.SearchSource("m", f, ["fio2"], concept_id="measurement_concept_id",
                                with_rows=True),
           explore.SearchSource("n", f, ["peep"], concept_id="measurement_concept_id")]
    rows = explore.variable_search(src, min_entities=0, k=1).collect()
    got = {(r.source_table, r.concept_id, r.patient_count, r.measurement_count) for r in rows}
    assert got == {("m", "1", 2, 3), ("n", "3", 1, None)}


def test_top_measured_unnamed_code_takes_no_place(spark):
    f = spark.createDataFrame([(1, 0), (2, 0), (3, 0), (1, 7), (2, 7), (1, 8)],
                              "person_id long, measurement_concept_id long")
    c = spark.createDataFrame([(7, "seven"), (8, "eight")], "concept_id long, concept_name string")
    got = [tuple(r) for r in explore.top_measured(f, c, k=2).collect()]
    assert got == [(7, "seven", 2, 2), (8, "eight", 1, 1)]


def test_tables_are_listed_by_uri(spark):
    from cohortkit.sources import tables
    names = tables.list_tables(spark, "file:///root/testdata/sf0.001")
    assert "events" in names and names == tables.list_tables(spark, "/root/testdata/sf0.001")
    assert tables.dataset_profile(spark, "file:///root/testdata/sf0.001").count() == len(names)


def test_column_profile_counts_values(spark):
    from cohortkit.sources import tables
    schema = "`a.b` long, x double, s string, raw binary, m array<int>"
    df = spark.createDataFrame([(1, 0.0, None, b"\xff", [1]), (1, -0.0, "", b"\xfe", [1]),
                                (None, float("nan"), "", None, None)], schema)
    got = [tuple(r)[3:] for r in tables.column_profile(spark, df).orderBy("ordinal_position").collect()]
    assert got == [(3, 2, 1), (3, 3, 2), (3, 2, 1), (3, 2, 2), (3, 2, 1)]
    empty = tables.column_profile(spark, df.limit(0)).collect()
    assert len(empty) == 5 and all(tuple(r)[3:] == (0, 0, 0) for r in empty)


def test_a_rewritten_data_set_is_read_anew(spark, tmp_path):
    from cohortkit.plans import registry as R
    from cohortkit.sources import tables
    sf = str(tmp_path)
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    path = tables.table_path(sf, "events")
    events.write.parquet(path)
    first = tables.read_table(spark, sf, "events")
    assert tables.read_table(spark, sf, "events") is first
    n, (_, chain) = first.count(), R._chain(spark, sf, 1)
    people = chain.count()
    assert R._chain(spark, sf, 1)[1] is chain
    some = events.filter("user_id <= 3")
    some.write.mode("overwrite").parquet(path)
    assert tables.read_table(spark, sf, "events").count() == some.count() < n
    assert R._chain(spark, sf, 1)[1].count() == some.select("user_id").distinct().count() < people
