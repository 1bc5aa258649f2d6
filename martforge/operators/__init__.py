"""DataFrame -> DataFrame operators."""

from martforge.operators.aggregates import (cond_sums, count_if, date_spine, days_per_week, fill_by_type,
                                            join_distinct, min_if, string_agg_distinct, top_k_by_count)
from martforge.operators.fill import fill, first_in_group
from martforge.operators.history import change_points, lag_in_group, latest_version, top_row
from martforge.operators.joins import anti_join_any, null_safe_join
from martforge.operators.mode import mode, modes
from martforge.operators.reshape import pivot
from martforge.operators.setops import append_row, union_distinct, union_tagged

__all__ = [
    "cond_sums", "count_if", "date_spine", "days_per_week", "fill_by_type", "join_distinct", "min_if",
    "string_agg_distinct", "top_k_by_count", "fill", "first_in_group", "change_points",
    "lag_in_group", "latest_version", "top_row", "anti_join_any",
    "null_safe_join", "mode", "modes", "pivot", "append_row", "union_distinct", "union_tagged",
]
