"""Column functions: built-in Spark expressions only, no Python UDFs."""

from kpimart.functions.dates import (
    add_business_days_expr,
    add_business_days_off_expr,
    add_deadline,
    month_keys,
    business_days_between,
    date_lit,
    deadline_expr,
    month_end,
    month_start,
    ts_lit,
)
from kpimart.functions.flags import prefix_flag, prefix_match, relabel, sla_flag, threshold_flag

__all__ = [
    "add_business_days_expr",
    "add_business_days_off_expr",
    "add_deadline",
    "month_keys",
    "business_days_between",
    "date_lit",
    "deadline_expr",
    "month_end",
    "month_start",
    "prefix_flag",
    "prefix_match",
    "relabel",
    "sla_flag",
    "threshold_flag",
    "ts_lit",
]
