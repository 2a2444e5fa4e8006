from stmtscope.operators.filters import (
    drop_connection_resets,
    keep_event_types,
    with_norm_texts,
    within_time_range,
)
from stmtscope.operators.flatten import (
    duplicate_keys,
    flatten_all,
    flatten_events,
    outcome_flags,
    select_events,
    split_rejects,
    to_batches,
)
from stmtscope.operators.summaries import (
    PlanLimits,
    batch_summary,
    exemplars_by_aggregate,
    exemplars_by_join,
    first_occurrences,
    metric_summary,
    metric_values,
    numbered_executions,
    unique_batches,
    wide_metric_summary,
)

__all__ = [
    "PlanLimits",
    "batch_summary",
    "drop_connection_resets",
    "duplicate_keys",
    "exemplars_by_aggregate",
    "exemplars_by_join",
    "first_occurrences",
    "flatten_all",
    "flatten_events",
    "keep_event_types",
    "metric_summary",
    "metric_values",
    "numbered_executions",
    "outcome_flags",
    "select_events",
    "split_rejects",
    "to_batches",
    "unique_batches",
    "wide_metric_summary",
    "with_norm_texts",
    "within_time_range",
]
