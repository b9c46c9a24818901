"""Cohort flag and outcome classification."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import percent
from ..functions.timecalc import whole_hours


def cohort_flag(df: DataFrame, *, min_hours: float = 24, start: str = "first_imv_start",
                landmark: str = "first_weaning", flag: str = "admission_has_neuro"
                ) -> DataFrame:
    """``first_imv_duration`` (whole hours start -> landmark) and
    ``cohort_criteria`` = 1 when the landmark exists, the duration is at
    least ``min_hours`` and the entity is not flagged; NULL otherwise."""
    dur = F.when(F.col(start).isNotNull(), whole_hours(start, landmark))
    d = df.withColumn("first_imv_duration", dur)
    ok = (F.col(landmark).isNotNull() & (F.col("first_imv_duration") >= min_hours)
          & (F.col(flag) == 0))
    return d.withColumn("cohort_criteria", F.when(ok, F.lit(1).cast("long")))


def outcome_classify(df: DataFrame, *, horizon_hours: float = 48,
                     landmark: str = "first_weaning", second: str = "second_imv_start",
                     died: str = "died_ts") -> DataFrame:
    """Success when neither a second episode nor death follows the
    landmark within ``horizon_hours`` whole hours; failure otherwise, with
    detail ``reintubated`` before ``died``. Only cohort rows are classified.

    ``weaning_to_second_imv`` is the whole hours from landmark to the second
    episode's start (read but never written in the reference, R4).
    """
    d = df.withColumn("weaning_to_second_imv", whole_hours(landmark, second))
    w2s = F.col("weaning_to_second_imv")
    dh = whole_hours(landmark, died)
    early_second = w2s.isNotNull() & (w2s < horizon_hours)
    early_death = F.col(died).isNotNull() & (dh < horizon_hours)
    in_cohort = F.col("cohort_criteria") == 1
    success = in_cohort & (w2s.isNull() | (w2s >= horizon_hours)) \
        & (F.col(died).isNull() | (dh >= horizon_hours))
    failure = in_cohort & (early_second | early_death)
    detail = (F.when(early_second, "reintubated").when(early_death, "died")
               .otherwise("unknown"))
    return d.withColumns({
        "weaning_success": F.when(success, 1).otherwise(0).cast("long"),
        "weaning_failure": F.when(failure, 1).otherwise(0).cast("long"),
        "weaning_outcome": F.when(failure, "failure").when(success, "success"),
        "weaning_outcome_detail": F.when(failure, detail),
    })


def outcome_distribution(df: DataFrame) -> DataFrame:
    """Cohort size by outcome and detail, with percent of the cohort.

    The share uses a window over the grouped result (at most a handful of
    rows), never over the cohort rows.
    """
    g = (df.filter(F.col("cohort_criteria") == 1)
           .groupBy(F.coalesce("weaning_outcome", F.lit("unclassified")).alias("outcome"),
                    F.coalesce("weaning_outcome_detail", F.lit("")).alias("detail"))
           .agg(F.count(F.lit(1)).alias("n")))
    total = F.sum("n").over(Window.partitionBy())
    return (g.withColumn("pct", percent(F.col("n"), total, 1))
             .withColumn("label", F.concat_ws("\n", "outcome", "detail"))
             .orderBy(F.desc("n"), "outcome", "detail"))
