"""DataFrame -> DataFrame steps the pipelines are built from."""

from stockloom.operators.aggregates import (
    conditional_sum,
    dedup_all,
    distinct_count,
    distinct_rows,
    group_agg,
    having,
    ordered_array,
    sample_stddev,
    wape,
    weighted_pop_sd,
    with_total,
)
from stockloom.operators.filters import (
    active_items_filter,
    clip_percentile,
    current_period,
    normal_sales,
)
from stockloom.operators.joins import (
    anti_missing,
    contains_any,
    cross_grid,
    date_array,
    effective_at,
    inner_equi,
    latest_version,
    left_default,
    market_override,
    market_override_totals,
    previous_period_join,
    range_join,
    rolling_reference,
    semi_in,
    two_grain_override,
    update_from,
    with_scalar,
)
from stockloom.operators.reshape import (
    pivot_sum,
    report_order,
    sort_desc,
    union_all,
    union_distinct,
    unnest,
)
from stockloom.operators.windows import (
    count_over,
    leave_one_out_mean,
    max_over,
    neighbours,
    next_h_array,
    partition_percentile,
    period_rank,
    row_number_by,
    share_of_total,
    split_running_sum,
    top1_min,
    trailing_stats,
)

__all__ = [
    "active_items_filter", "anti_missing", "clip_percentile", "conditional_sum",
    "contains_any", "count_over", "cross_grid", "current_period", "date_array",
    "dedup_all", "distinct_count", "distinct_rows", "effective_at", "group_agg",
    "having", "inner_equi", "latest_version", "leave_one_out_mean",
    "left_default", "market_override", "market_override_totals", "max_over", "neighbours",
    "next_h_array", "normal_sales",
    "ordered_array", "partition_percentile", "period_rank", "pivot_sum",
    "previous_period_join", "range_join", "report_order", "rolling_reference",
    "row_number_by", "sample_stddev", "semi_in", "share_of_total", "sort_desc",
    "split_running_sum", "top1_min", "trailing_stats", "two_grain_override",
    "union_all", "union_distinct", "unnest", "update_from", "wape",
    "weighted_pop_sd", "with_scalar", "with_total",
]
