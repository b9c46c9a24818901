"""Bindings of the driver's test tables to the shapes the operators expect.

The operators take OMOP-style column names as defaults (``person_id``,
``measurement_datetime``, ...). These functions project the synthetic test
tables onto those names, so that every operator runs on the given tables and
its work grows with them. Each binding has a SQL twin (``*_SQL``) that the
DuckDB oracle uses, so the two sides read identical inputs.

All bindings are projections and filters over one scan (plus one per-entity
aggregate for visits and deaths); Catalyst pushes filters through them into
the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import read_table
from ..functions.timecalc import shift

# ---------------------------------------------------------------------------
# events -> measurement (event fact)
# ---------------------------------------------------------------------------

# Fixed values of the binding: unit artefacts every tenth event, a missing
# unit every tenth event, half of the 'view' rows stored as fractions, a
# quarter of the rows without a visit id.
MEASUREMENT_SQL = """
SELECT
  event_id AS measurement_id,
  user_id AS person_id,
  ts AS measurement_datetime,
  event_type AS measurement_concept_id,
  CASE WHEN event_type = 'view' AND event_id % 2 = 1 THEN value / 100 ELSE value END
    AS value_as_number,
  CASE WHEN event_id % 10 = 0 THEN '%' WHEN event_id % 10 = 1 THEN NULL ELSE 'u' END
    AS unit_source_value,
  CASE WHEN event_id % 4 = 0 THEN NULL ELSE event_id END AS visit_occurrence_id
FROM events
"""


def measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return e.select(
        eid.alias("measurement_id"),
        F.col("user_id").alias("person_id"),
        F.col("ts").alias("measurement_datetime"),
        F.col("event_type").alias("measurement_concept_id"),
        F.when((F.col("event_type") == "view") & (eid % 2 == 1), F.col("value") / 100)
         .otherwise(F.col("value")).alias("value_as_number"),
        F.when(eid % 10 == 0, F.lit("%")).when(eid % 10 == 1, F.lit(None).cast("string"))
         .otherwise(F.lit("u")).alias("unit_source_value"),
        F.when(eid % 4 == 0, F.lit(None).cast("long")).otherwise(eid)
         .alias("visit_occurrence_id"),
    )


# ---------------------------------------------------------------------------
# events -> visit_occurrence
# ---------------------------------------------------------------------------

VISIT_PER_ENTITY_SQL = """
SELECT
  user_id AS person_id,
  user_id AS visit_occurrence_id,
  date_trunc('day', min(ts)) AS visit_start_datetime,
  date_trunc('day', min(ts)) + INTERVAL 30 DAY AS visit_end_datetime
FROM events
GROUP BY user_id
"""


def visit_per_entity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One admission per entity: the day of its first event, 30 days long."""
    e = read_table(spark, sf_dir, "events")
    first = e.groupBy("user_id").agg(F.min("ts").alias("_first"))
    start = F.date_trunc("day", F.col("_first")).cast("timestamp_ntz")
    return first.select(
        F.col("user_id").alias("person_id"),
        F.col("user_id").alias("visit_occurrence_id"),
        start.alias("visit_start_datetime"),
        shift(start, 30 * 24).alias("visit_end_datetime"),
    )


VISITS_MANY_SQL = """
SELECT
  event_id AS visit_occurrence_id,
  user_id AS person_id,
  event_id % 3 AS visit_concept_id,
  date_trunc('day', ts) AS visit_start_datetime,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE date_trunc('day', ts) + INTERVAL 3 DAY END
    AS visit_end_datetime
FROM events
WHERE event_type = 'signup'
"""


def visits_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many visits per entity, with exact duplicates and missing ends."""
    e = read_table(spark, sf_dir, "events").filter(F.col("event_type") == "signup")
    start = F.date_trunc("day", F.col("ts")).cast("timestamp_ntz")
    return e.select(
        F.col("event_id").alias("visit_occurrence_id"),
        F.col("user_id").alias("person_id"),
        (F.col("event_id") % 3).alias("visit_concept_id"),
        start.alias("visit_start_datetime"),
        F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(shift(start, 72)).alias("visit_end_datetime"),
    )


# The three visit types of the literal visit dimension.
VISIT_CONCEPTS = [(0, "Intensive Care"), (1, "Inpatient Visit"), (2, "Emergency Room Visit")]
VISIT_CONCEPT_SQL = """
SELECT * FROM (VALUES (0, 'Intensive Care'), (1, 'Inpatient Visit'),
                      (2, 'Emergency Room Visit')) t(concept_id, concept_name)
"""


def visit_concept(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(VISIT_CONCEPTS, "concept_id long, concept_name string")


# ---------------------------------------------------------------------------
# events -> drug_exposure, condition_occurrence, death
# ---------------------------------------------------------------------------

#: Event types that stand for exposure codes where three are asked for.
EXPOSURE_KINDS = ("purchase", "signup", "error")


def drug_exposure_sql(null_ends: bool, kinds: tuple = ("purchase",)) -> str:
    end = ("CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts + INTERVAL 2 HOUR END"
           if null_ends else "ts + INTERVAL 2 HOUR")
    return f"""
SELECT
  event_id AS drug_exposure_id,
  user_id AS person_id,
  event_type AS drug_concept_id,
  ts AS drug_exposure_start_datetime,
  {end} AS drug_exposure_end_datetime
FROM events
WHERE event_type IN ({', '.join(repr(k) for k in kinds)})
"""


def drug_exposure(spark: SparkSession, sf_dir: str, null_ends: bool = False,
                  kinds: tuple = ("purchase",)) -> DataFrame:
    """Exposure intervals: each event of ``kinds`` is a 2 h exposure."""
    e = read_table(spark, sf_dir, "events").filter(F.col("event_type").isin(*kinds))
    end = shift("ts", 2)
    if null_ends:
        end = F.when(F.col("event_id") % 7 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(end)
    return e.select(
        F.col("event_id").alias("drug_exposure_id"),
        F.col("user_id").alias("person_id"),
        F.col("event_type").alias("drug_concept_id"),
        F.col("ts").alias("drug_exposure_start_datetime"),
        end.alias("drug_exposure_end_datetime"),
    )


CONDITION_SQL = """
SELECT user_id AS person_id, ts AS condition_start_datetime,
       props AS condition_source_value
FROM events
WHERE event_type = 'error'
"""


def condition_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events").filter(F.col("event_type") == "error")
    return e.select(F.col("user_id").alias("person_id"),
                    F.col("ts").alias("condition_start_datetime"),
                    F.col("props").alias("condition_source_value"))


DEATH_SQL = """
SELECT user_id AS person_id, max(ts) AS death_datetime
FROM events
WHERE event_type = 'error' AND value > 100
GROUP BY user_id
"""


def death(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return (e.filter((F.col("event_type") == "error") & (F.col("value") > 100))
             .groupBy(F.col("user_id").alias("person_id"))
             .agg(F.max("ts").alias("death_datetime")))


# ---------------------------------------------------------------------------
# part + lineitem -> concept vocabulary + a second fact
# ---------------------------------------------------------------------------

CONCEPT_SQL = """
SELECT p_partkey AS concept_id, p_name AS concept_name,
       'Measurement' AS domain_id, p_type AS vocabulary_id,
       p_brand AS concept_class_id, 'S' AS standard_concept
FROM part
"""


def concept(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").alias("concept_id"),
        F.col("p_name").alias("concept_name"),
        F.lit("Measurement").alias("domain_id"),
        F.col("p_type").alias("vocabulary_id"),
        F.col("p_brand").alias("concept_class_id"),
        F.lit("S").alias("standard_concept"),
    )


LINE_FACT_SQL = """
SELECT l_suppkey AS person_id, l_partkey AS measurement_concept_id,
       l_shipdate AS measurement_datetime, l_quantity AS value_as_number,
       l_returnflag AS unit_source_value
FROM lineitem
"""


def line_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem as a measurement table coded by part (the vocabulary)."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("person_id"),
        F.col("l_partkey").alias("measurement_concept_id"),
        F.col("l_shipdate").alias("measurement_datetime"),
        F.col("l_quantity").alias("value_as_number"),
        F.col("l_returnflag").alias("unit_source_value"),
    )


# ---------------------------------------------------------------------------
# orders / customer -> a fact coded by market segment; person attributes
# ---------------------------------------------------------------------------

ORDER_FACT_SQL = """
SELECT o.o_custkey AS person_id, c.c_mktsegment AS concept_name, o.o_orderkey AS row_id
FROM orders o JOIN customer c ON c.c_custkey = o.o_custkey
"""


def order_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders")
    c = read_table(spark, sf_dir, "customer")
    return (o.join(c, o.o_custkey == c.c_custkey, "inner")
             .select(F.col("o_custkey").alias("person_id"),
                     F.col("c_mktsegment").alias("concept_name"),
                     F.col("o_orderkey").alias("row_id")))


PERSON_SQL = """
SELECT c_custkey AS person_id, CAST(c_acctbal AS DECIMAL(38,9)) AS age_at_admission,
       c_mktsegment AS sex
FROM customer
"""


def person(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read_table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").alias("person_id"),
                    F.col("c_acctbal").cast("decimal(38,9)").alias("age_at_admission"),
                    F.col("c_mktsegment").alias("sex"))


def register_views(spark: SparkSession, sf_dir: str) -> list[str]:
    """Expose the bound shapes as temp views under their OMOP names, so that
    SQL written against the reference's tables runs through ``spark.sql``
    (with ``args=`` for parameters, S6). Views are lazy: nothing is read."""
    views = {
        "measurement": measurement(spark, sf_dir),
        "visit_occurrence": visits_many(spark, sf_dir),
        "drug_exposure": drug_exposure(spark, sf_dir),
        "condition_occurrence": condition_occurrence(spark, sf_dir),
        "death": death(spark, sf_dir),
        "concept": concept(spark, sf_dir),
        "person": person(spark, sf_dir),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return sorted(views)
