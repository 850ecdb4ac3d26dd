"""DataFrame operators: calendar, scope, joins, measures, stacking."""

from kpimart.operators.calendar import (
    add_business_days,
    business_day_calendar,
    calendar_rows,
    calendar_of,
    fiscal_calendar,
    date_span,
    fiscal_period,
    measured_calendar,
    month_end_calendar,
)
from kpimart.operators.joins import (
    enrich,
    enrich_multiplicity,
    enrich_split,
    enrich_weighted,
    first_per_key,
    hot_keys,
    latest_flag,
    latest_per_key,
    latest_rank,
    maybe_broadcast,
    require_related,
    require_related_weighted,
    row_rank,
)
from kpimart.operators.measures import (
    collapse_dims,
    count_measure,
    percentile_carry,
    percentile_measure,
    ratio_measure,
    sum_measure,
)
from kpimart.operators.scope import (
    Segment,
    all_of,
    predicate,
    scope,
    segment,
    transition_scope,
)
from kpimart.operators.stack import stack

__all__ = [
    "Segment", "add_business_days", "all_of", "business_day_calendar", "calendar_rows",
    "collapse_dims", "count_measure", "enrich", "enrich_multiplicity", "enrich_split", "enrich_weighted", "first_per_key",
    "calendar_of", "fiscal_calendar", "fiscal_period", "latest_flag", "latest_per_key", "latest_rank",
    "date_span", "hot_keys", "maybe_broadcast", "measured_calendar", "month_end_calendar", "percentile_carry", "percentile_measure",
    "predicate", "ratio_measure", "require_related", "require_related_weighted", "row_rank", "scope", "segment", "stack",
    "sum_measure", "transition_scope",
]
