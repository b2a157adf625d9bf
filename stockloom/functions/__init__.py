"""Column expressions.  Everything here stays inside JVM code generation."""

from stockloom.functions.dates import (
    calendar_parts,
    format_date,
    period_index,
    shift_date,
    trunc_period,
    week_boundary_diff,
    week_index,
    week_label,
    year_boundary_diff,
)
from stockloom.functions.scalar import (
    build_key,
    cap_value,
    ceil_to_pack,
    clip,
    forward_season,
    max_of_buckets,
    output_transform,
    override_value,
    pad_dept,
    safe_divide,
    select_by_least,
    split_key,
    strict_greatest,
    strict_least,
    strip_quotes,
    strip_thousands,
    unpad_dept,
)

__all__ = [
    "build_key", "calendar_parts", "cap_value", "ceil_to_pack", "clip",
    "format_date", "forward_season", "max_of_buckets", "output_transform",
    "override_value", "pad_dept", "period_index", "safe_divide",
    "select_by_least", "shift_date", "split_key", "strict_greatest",
    "strict_least", "strip_quotes", "strip_thousands", "trunc_period",
    "unpad_dept", "week_boundary_diff", "week_index", "week_label",
    "year_boundary_diff",
]
