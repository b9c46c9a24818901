"""Exploration jobs: vocabulary search, cross-reference, profiling.

C1 ``concept_search``, C2 ``concept_cross_reference``, C3 ``top_measured``,
C4 ``spot_check``, C5 ``describe_values`` / ``distinct_units``,
C6 ``synonym_hunt``, C7 ``co_occurrence_all``, C8 ``co_occurrence_compare``,
C9 ``variable_search``, C12 ``population_rate``, C14 ``visit_types``,
C16 ``temporal_distribution``, C17 ``table_population``,
C18 ``yearly_duplicates``.

Facts are aggregated by code *before* names are joined (names depend on the
code only), so the join sees one row per code instead of one per event.
Broadcasts are used only where the broadcast side is bounded by a parameter
(an id list, ``k``, ``n_entities``); other joins are left to AQE, which
broadcasts at runtime only after it has measured the side.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import fixed, numeric, percent
from ..functions.text import contains_any_ci, contains_ci
from .quantiles import quantiles, side_by_side

E, T, C, V = "person_id", "measurement_datetime", "measurement_concept_id", "value_as_number"
U = "unit_source_value"
CONCEPT_COLS = ["concept_id", "concept_name", "domain_id", "vocabulary_id",
                "concept_class_id", "standard_concept"]


def exact_mean(col: str, digits: int) -> F.Column:
    """``ROUND(AVG(x), digits)`` on exact decimals (half-up, engine independent)."""
    return fixed(F.avg(numeric(col)), digits)


def exact_mean_col(col: F.Column, digits: int) -> F.Column:
    return fixed(F.avg(numeric(col)), digits)


def concept_search(concept: DataFrame, term: str, limit: int | None = 100) -> DataFrame:
    """Vocabulary rows whose name contains ``term`` (any case), by name."""
    hits = (concept.filter(contains_ci("concept_name", term))
                   .select(*CONCEPT_COLS)
                   .orderBy("concept_name", "concept_id"))
    return hits.limit(limit) if limit else hits


def _code_stats(fact: DataFrame, *, entity: str, code: str, value: str | None,
                value_digits: int = 2) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("measurement_count"),
            F.count_distinct(entity).alias("patient_count")]
    if value:
        aggs += [F.min(value).alias("min_value"), F.max(value).alias("max_value"),
                 exact_mean(value, value_digits).alias("mean_value")]
    return fact.groupBy(code).agg(*aggs)


def concept_cross_reference(fact: DataFrame, concept: DataFrame, ids: Sequence, *,
                            entity: str = E, code: str = C, value: str = V) -> DataFrame:
    """For candidate ids, counts and value range joined with the name."""
    ids = list(ids)
    stats = _code_stats(fact.filter(F.col(code).isin(ids)), entity=entity, code=code,
                        value=value)
    names = F.broadcast(concept.filter(F.col("concept_id").isin(ids))
                               .select("concept_id", "concept_name", "vocabulary_id"))
    return (stats.join(names, stats[code] == names["concept_id"], "inner")
                 .select(code, "concept_name", "vocabulary_id", "measurement_count",
                         "patient_count", "min_value", "max_value", "mean_value")
                 .orderBy(F.desc("measurement_count"), code))


def top_measured(fact: DataFrame, concept: DataFrame, k: int = 50, *,
                 entity: str = E, code: str = C) -> DataFrame:
    """The ``k`` most measured codes with names (ties by code).

    Codes without a name take no place: names are joined to the counts by
    code before the limit. Distinct entities are counted for the ``k`` codes
    that are left only.
    """
    names = concept.select(F.col("concept_id").alias(code), "concept_name")
    top = (fact.groupBy(code).agg(F.count(F.lit(1)).alias("measurement_count"))
           .join(names, code, "inner")
           .orderBy(F.desc("measurement_count"), code, "concept_name").limit(k))
    stats = fact.join(F.broadcast(top.select(code).distinct()), code, "left_semi") \
                .groupBy(code).agg(F.count_distinct(entity).alias("patient_count"))
    return (F.broadcast(top).join(stats, code, "inner")
            .select(code, "concept_name", "measurement_count", "patient_count")
            .orderBy(F.desc("measurement_count"), code))


def spot_check(fact: DataFrame, concept: DataFrame, concept_id, n_entities: int = 10,
               limit: int | None = 200, *, entity: str = E, time: str = T, code: str = C,
               value: str = V, unit: str = U) -> DataFrame:
    """C4: rows of one code for a sample of entities, with unit and name.

    The sample is the ``n_entities`` smallest entity ids having the code (the
    reference's unordered ``LIMIT`` made repeatable); it is bounded by
    ``n_entities`` and broadcast into a semi join.
    """
    rows = fact.filter(F.col(code) == F.lit(concept_id))
    sample = rows.select(entity).distinct().orderBy(entity).limit(n_entities)
    name = F.broadcast(concept.filter(F.col("concept_id") == F.lit(concept_id))
                              .select("concept_id", "concept_name"))
    out = (rows.join(F.broadcast(sample), entity, "left_semi")
               .join(name, F.col(code) == F.col("concept_id"), "inner")
               .select(entity, time, "concept_name", value, unit)
               .orderBy(entity, time, value, unit))
    return out.limit(limit) if limit else out


def describe_values(df: DataFrame, col: str, by: Sequence[str] = (), *, bounded: bool = False
                    ) -> DataFrame:
    """``Series.describe()``: count, mean, std, min, quartiles, max, per group of ``by``.

    The quartiles are exact and interpolated like pandas, by the level-wise selection of
    :mod:`.quantiles`, which scans ``df`` four times more. For an input that is
    bounded by a parameter (a spot check) ``bounded=True`` takes them in the same
    pass, with ``percentile``, which keeps every distinct value in one buffer.
    Groups without values have count 0 and nulls.
    """
    by = list(by)
    x = F.col(col).cast("double")
    quartiles, names = [0.25, 0.5, 0.75], ["p25", "p50", "p75"]
    d6 = "decimal(38,6)"   # engines differ in the last bits of these; 6 digits do not
    aggs = [F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
            F.min(x).alias("min"), F.max(x).alias("max")]
    if bounded:
        q = F.percentile(x, F.array(*[F.lit(p) for p in quartiles]))
        stats = df.groupBy(*by).agg(*aggs, q.alias("_q"))
        stats = stats.withColumns({n: F.col("_q")[i] for i, n in enumerate(names)})
    else:
        stats = df.groupBy(*by).agg(*aggs)
        q = quantiles(df.withColumn("_x", x), by, "_x", quartiles, names, interpolate=True)
        if by:
            q = q.withColumnsRenamed({b: f"_by_{b}" for b in by})
            on = [F.col(b).eqNullSafe(F.col(f"_by_{b}")) for b in by]
            stats = stats.join(q, reduce(lambda a, b: a & b, on), "left")
        else:
            stats = side_by_side(stats, q)
    return stats.select(*by, "count", F.col("mean").cast(d6).alias("mean"),
                        F.col("std").cast(d6).alias("std"), "min",
                        *[F.col(n).cast(d6).alias(n) for n in names], "max")


def distinct_units(df: DataFrame, unit: str = U) -> DataFrame:
    """The distinct units seen (``Series.unique()``)."""
    return df.select(unit).distinct()


def synonym_hunt(fact: DataFrame, concept: DataFrame, term: str, *, entity: str = E,
                 code: str = C) -> DataFrame:
    """Every *measured* code whose name contains ``term``, with counts."""
    matched = concept.filter(contains_ci("concept_name", term)) \
                     .select("concept_id", "concept_name", "vocabulary_id")
    hits = fact.join(matched.select(F.col("concept_id").alias(code)), code, "left_semi")
    stats = _code_stats(hits, entity=entity, code=code, value=None)
    return (stats.join(matched, stats[code] == matched["concept_id"], "inner")
                 .select(code, "concept_name", "vocabulary_id", "measurement_count",
                         "patient_count")
                 .orderBy(F.desc("measurement_count"), code))


def co_occurrence_all(fact: DataFrame, ids: Sequence, *, entity: str = E,
                      code: str = C) -> DataFrame:
    """Entities having every one of ``ids`` (at any time).

    One presence flag per id by conditional ``max`` (the manual pivot of the
    reference), all partial aggregates.
    """
    ids = list(ids)
    flags = [F.max(F.when(F.col(code) == F.lit(i), 1).otherwise(0)).alias(f"_has_{n}")
             for n, i in enumerate(ids)]
    g = fact.filter(F.col(code).isin(ids)).groupBy(entity).agg(*flags)
    cond = reduce(lambda a, b: a & b, [F.col(f"_has_{n}") == 1 for n in range(len(ids))])
    return g.filter(cond).select(entity)


def co_occurrence_compare(fact: DataFrame, single, ids: Sequence, *, entity: str = E,
                          code: str = C) -> DataFrame:
    """Entities with ``single`` vs. entities with all of ``ids``, one pass."""
    ids = list(ids)
    every = list(dict.fromkeys([single, *ids]))
    flags = [F.max(F.when(F.col(code) == F.lit(i), 1).otherwise(0)).alias(f"_has_{n}")
             for n, i in enumerate(every)]
    g = fact.filter(F.col(code).isin(every)).groupBy(entity).agg(*flags)
    all_ids = reduce(lambda a, b: a & b,
                     [F.col(f"_has_{every.index(i)}") == 1 for i in ids])
    return g.agg(F.count_if(F.col("_has_0") == 1).alias("single_count"),
                 F.count_if(all_ids).alias("all_count"))


@dataclass(frozen=True)
class SearchSource:
    """One fact table of a variable search: its name column and terms.

    ``names`` is a vocabulary (``concept_id``, ``concept_name``) for a fact that has codes
    only; without it the fact carries the names itself.
    """
    name: str
    fact: DataFrame
    terms: Sequence[str]
    concept_id: str = "concept_id"
    concept_name: str = "concept_name"
    entity: str = E
    with_rows: bool = False
    names: DataFrame | None = None


def variable_search(sources: Sequence[SearchSource], min_entities: int = 100,
                    k: int = 20) -> DataFrame:
    """Any-of term search over several fact tables, one frame.

    Per source: codes whose name matches any term, distinct entities (and
    rows where ``with_rows``), kept when entities > ``min_entities``, top
    ``k`` by entities. Each source is aggregated by its own columns, ids in
    their native types; only the counts are unioned, with ids as text. With a
    vocabulary the terms are matched once per name, the facts of other codes go in a
    semi join, and names are joined to the counts. The per-source top-k is a
    ``row_number`` over the small aggregate, partitioned by source.
    """
    parts = []
    for s in sources:
        size = [F.count_distinct(s.entity).alias("patient_count"),
                F.count(F.lit(1)).alias("_rows")]
        if s.names is None:
            counts = (s.fact.filter(contains_any_ci(s.concept_name, s.terms))
                      .groupBy(F.col(s.concept_id).alias("_id"),
                               F.col(s.concept_name).alias("_name")).agg(*size))
        else:
            names = (s.names.filter(contains_any_ci("concept_name", s.terms))
                     .select(F.col("concept_id").alias("_id"), F.col("concept_name").alias("_name")))
            facts = s.fact.select(F.col(s.concept_id).alias("_id"), s.entity)
            counts = (facts.join(names, "_id", "left_semi").groupBy("_id").agg(*size)
                      .join(names, "_id", "inner"))
        rows = F.col("_rows") if s.with_rows else F.lit(None)
        parts.append(counts.select(F.lit(s.name).alias("source_table"),
                                   F.col("_id").cast("string").alias("concept_id"),
                                   F.col("_name").cast("string").alias("concept_name"),
                                   "patient_count", rows.cast("long").alias("measurement_count")))
    u = reduce(DataFrame.unionByName, parts).filter(F.col("patient_count") > min_entities)
    w = Window.partitionBy("source_table").orderBy(F.desc("patient_count"), "concept_id")
    return (u.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= k)
             .select("source_table", "concept_id", "concept_name", "patient_count",
                     "measurement_count"))


def population_rate(df: DataFrame, col: str, threshold: float = 90.0) -> DataFrame:
    """Rows, rows with ``col`` set, percent (1 digit), threshold flag."""
    g = df.agg(F.count(F.lit(1)).alias("total_rows"), F.count(col).alias("rows_with_value"))
    pct = percent(F.col("rows_with_value"), F.col("total_rows"), 1)
    return (g.withColumn("pct_populated", pct)
             .withColumn("meets_threshold",
                         (F.coalesce(F.col("pct_populated"), F.lit(0)) >= threshold)
                         .cast("long")))


def visit_types(visit: DataFrame, concept: DataFrame, *, entity: str = E,
                code: str = "visit_concept_id") -> DataFrame:
    """C14: visits and distinct entities per visit type, with names."""
    g = visit.groupBy(code).agg(F.count(F.lit(1)).alias("visit_count"),
                                F.count_distinct(entity).alias("patient_count"))
    return (g.join(concept.select("concept_id", "concept_name"),
                   g[code] == F.col("concept_id"), "inner")
             .select(code, "concept_name", "visit_count", "patient_count")
             .orderBy(F.desc("visit_count"), code))


def temporal_distribution(fact: DataFrame, concept_id, *, entity: str = E, time: str = T,
                          code: str = C) -> DataFrame:
    """Rows and distinct entities of one code by calendar year."""
    return (fact.filter(F.col(code) == F.lit(concept_id))
                .groupBy(F.year(time).alias("year"))
                .agg(F.count(F.lit(1)).alias("measurement_count"),
                     F.count_distinct(entity).alias("patient_count"))
                .orderBy("year"))


def table_population(df: DataFrame, entity: str = E) -> DataFrame:
    """C17: row count, distinct entities and an empty flag."""
    return (df.agg(F.count(F.lit(1)).alias("row_count"),
                   F.count_distinct(entity).alias("patient_count"))
              .withColumn("is_empty", (F.col("row_count") == 0).cast("long")))


def yearly_duplicates(visit: DataFrame, *, entity: str = E,
                      start: str = "visit_start_datetime",
                      identity: Sequence[str] | None = None) -> DataFrame:
    """Per start year distinct entities, rows, rows minus entities.

    ``rows - entities`` is the reference's "duplicate rows" (it also counts
    repeat admissions, R2); ``exact_duplicate_rows`` counts rows that repeat
    an identical ``identity`` tuple of their entity (default: all columns).
    One scan: rows are counted per identity, identities per entity, entities
    per year.
    """
    own = [c for c in (identity or visit.columns) if c != entity]
    per_row = (visit.filter(F.col(start).isNotNull())
               .groupBy(F.year(start).alias("_year"), F.col(entity).alias("_entity"), *own)
               .agg(F.count(F.lit(1)).alias("_n")))
    per_entity = per_row.groupBy("_year", "_entity").agg(F.sum("_n").alias("_n"),
                                                         F.count(F.lit(1)).alias("_distinct"))
    per_year = per_entity.groupBy(F.col("_year").alias("year")).agg(
        F.count("_entity").alias("unique_patients"), F.sum("_n").alias("total_rows"),
        F.sum("_distinct").alias("_distinct_rows"))
    return (per_year.select("year", "unique_patients", "total_rows",
                            (F.col("total_rows") - F.col("unique_patients"))
                            .alias("duplicate_rows"),
                            (F.col("total_rows") - F.col("_distinct_rows"))
                            .alias("exact_duplicate_rows"))
                    .orderBy("year"))
