"""Generic DataFrame -> DataFrame operators (column names are parameters)."""

from orebridge.operators.dedup import flag_duplicates, keep_first
from orebridge.operators.inject import inject_defects, pick
from orebridge.operators.joins import attach, broadcast_if_bounded, join_on, salted_join, semi_reduce
from orebridge.operators.keys import (KeyCheckError, assert_all_empty, assert_empty,
                                      assign_surrogate_keys, declared_checks, failed_rows, fk_orphans,
                                      insert_if_absent, key_usage, key_violations, long_values, max_key, null_rows)
from orebridge.operators.median import (approximate_median, group_median, impute_group_median,
                                        median_from_counts, median_sketches, merge_sketches, value_counts)
from orebridge.operators.ordering import running_total, with_position
from orebridge.operators.outliers import (flag_outliers, limits_from_moments, moments,
                                          sigma_bounds)

__all__ = [
    "KeyCheckError", "approximate_median", "assert_all_empty", "assert_empty", "assign_surrogate_keys",
    "attach", "broadcast_if_bounded", "declared_checks", "failed_rows", "fk_orphans", "flag_duplicates", "flag_outliers",
    "group_median", "impute_group_median", "inject_defects", "insert_if_absent",
    "join_on", "keep_first", "key_usage", "key_violations", "long_values", "max_key", "null_rows", "pick",
    "limits_from_moments", "median_from_counts", "median_sketches", "merge_sketches", "moments",
    "running_total", "salted_join", "semi_reduce", "sigma_bounds", "value_counts", "with_position",
]
