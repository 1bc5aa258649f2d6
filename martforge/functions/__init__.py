"""Column-level functions (all JVM-side built-in expressions)."""

from martforge.functions.dates import (as_date, calendar_columns, days_between, epoch_ms_to_timestamp,
                                       hours_between, minute_trunc, month_start, quarter_start,
                                       week_start, weekday_mon1)
from martforge.functions.nulls import (any_matches, eq_or_false, matches, not_in_keep_null, not_matches,
                                       null_safe_on, paste, strict_max, strict_min, strict_sum)
from martforge.functions.rules import code_map, ladder, regex_ladder
from martforge.functions.urls import referrer_host, split_at, strip_query, url_host, url_param

__all__ = [
    "as_date", "calendar_columns", "days_between", "epoch_ms_to_timestamp", "hours_between",
    "minute_trunc", "month_start", "quarter_start", "week_start", "weekday_mon1",
    "any_matches", "eq_or_false", "matches", "not_in_keep_null", "not_matches", "null_safe_on",
    "paste", "strict_max", "strict_min", "strict_sum", "code_map", "ladder", "regex_ladder",
    "referrer_host", "split_at", "strip_query", "url_host", "url_param",
]
