"""cohortkit: entity-level cohorts and feature tables from long event tables, on Spark.

Every operator is a DataFrame -> DataFrame function; the most used ones are
re-exported here.
"""

from .operators.episodes import (cumulative_to_incremental, cumulative_total_check,
                                 first_event_after, first_segment, gap_episodes,
                                 link_by_interval)
from .operators.explore import (co_occurrence_all, co_occurrence_compare, concept_cross_reference,
                                concept_search, describe_values, population_rate, spot_check,
                                synonym_hunt, table_population, temporal_distribution,
                                top_measured, variable_search, visit_types, yearly_duplicates)
from .operators.features import (FeatureSpec, extract_features, landmark_slope,
                                 nearest_at_landmark, unit_normalise)
from .operators.landmarks import (EligibilityRule, base_cohort, condition_flag,
                                  eligibility_landmark, not_exposed, paired_within,
                                  terminal_landmark)
from .operators.outcomes import cohort_flag, outcome_classify, outcome_distribution
from .operators.quality import check_column, check_ranges, table_status
from .operators.totals import WindowSpec, code_set_audit, histogram, window_sum, window_sums
from .plans.weaning import WeaningInputs, WeaningParams, weaning_table
from .plans.widetable import WideColumn, WideSchema, assemble, update_from, update_where

__version__ = "0.1.0"
