"""Table operators: deduplication, keys, ranks, upsert, history, star joins, checks."""

from martloom.operators.aggregates import (
    conditional_counts,
    distinct_counts,
    majority,
    sorted_set,
)
from martloom.operators.calendar import (
    CALENDAR_COLUMNS,
    Period,
    calendar,
    calendar_between,
    in_any_period,
    period_of,
)
from martloom.operators.checks import (
    assert_unique,
    distinct_ids,
    duplicate_keys,
    parents_without_children,
    require_rows,
)
from martloom.operators.dedupe import dedupe
from martloom.operators.history import late_rows, open_history, scd2_apply
from martloom.operators.keys import dense_key, stable_key
from martloom.operators.ranks import global_ranks, share_of_max, top_n_per_group
from martloom.operators.skew import hot_keys, salted_join
from martloom.operators.star import Dim, match_report, star_join
from martloom.operators.upsert import Within, upsert, upsert_where

__all__ = [
    "CALENDAR_COLUMNS",
    "Dim",
    "Period",
    "Within",
    "assert_unique",
    "calendar",
    "calendar_between",
    "conditional_counts",
    "dedupe",
    "dense_key",
    "distinct_counts",
    "distinct_ids",
    "duplicate_keys",
    "global_ranks",
    "hot_keys",
    "in_any_period",
    "late_rows",
    "majority",
    "match_report",
    "open_history",
    "parents_without_children",
    "period_of",
    "require_rows",
    "salted_join",
    "scd2_apply",
    "share_of_max",
    "sorted_set",
    "stable_key",
    "star_join",
    "top_n_per_group",
    "upsert",
    "upsert_where",
]
