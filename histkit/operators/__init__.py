"""Operators on DataFrames; each can be used on its own."""

from .checks import (
    Checks,
    check_distinct_count_equal,
    check_not_null,
    check_recency,
    check_table,
    column_profile,
    observed,
)
from .children import child_columns, child_list, child_pivot, explode_variant, lateral_left
from .key_filter import key_filter, may_match, pages_for
from .pivot import attribute_rows, infer_fields, pivot_attributes, pivot_rows
from .skew import Cuts, if_small, sampled, stretches, time_cuts
from .versions import (
    anti_rows,
    anti_versions,
    change_history,
    compact_changes,
    dedupe_versions,
    latest_per_key,
    union_distinct,
)
from .watermark import current_watermark, watermark_filter, watermark_subquery

__all__ = [
    "Checks",
    "Cuts",
    "anti_rows",
    "anti_versions",
    "attribute_rows",
    "change_history",
    "check_distinct_count_equal",
    "check_not_null",
    "check_recency",
    "check_table",
    "child_columns",
    "child_list",
    "child_pivot",
    "column_profile",
    "compact_changes",
    "current_watermark",
    "dedupe_versions",
    "explode_variant",
    "if_small",
    "infer_fields",
    "key_filter",
    "latest_per_key",
    "lateral_left",
    "may_match",
    "observed",
    "pages_for",
    "pivot_attributes",
    "pivot_rows",
    "sampled",
    "stretches",
    "time_cuts",
    "union_distinct",
    "watermark_filter",
    "watermark_subquery",
]
