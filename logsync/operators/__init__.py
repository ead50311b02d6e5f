"""DataFrame operators over message logs, offset tables and health samples."""

from .audit import reconcile, relayed_counts, replication_lag
from .filters import attribute_filters, filter_messages, filtered_counts, opaque_filter
from .health import (
    active_history,
    best_per_tick,
    candidate_history,
    elect_source,
    lag_breaches,
    node_health_summary,
    node_weights,
    switch_counts,
)
from .lookup import bounded_rows, local_table, lookup_join
from .mirrors import merge_mirrors, tag_mirrors
from .numbering import assign_target_offsets, number_rows
from .offsets import (
    after_offsets,
    between_offsets,
    gap_report,
    high_watermarks,
    reached_end,
    remaining_offsets,
    source_progress,
    until_offsets,
)
from .routing import (
    expect_topic,
    route_partition,
    route_topics,
    stamp_source_time,
    to_message,
    validate_routes,
)

__all__ = [
    "active_history",
    "after_offsets",
    "assign_target_offsets",
    "attribute_filters",
    "best_per_tick",
    "between_offsets",
    "bounded_rows",
    "candidate_history",
    "elect_source",
    "expect_topic",
    "filter_messages",
    "filtered_counts",
    "gap_report",
    "high_watermarks",
    "lag_breaches",
    "local_table",
    "lookup_join",
    "merge_mirrors",
    "node_health_summary",
    "node_weights",
    "number_rows",
    "opaque_filter",
    "reached_end",
    "reconcile",
    "relayed_counts",
    "remaining_offsets",
    "replication_lag",
    "route_partition",
    "route_topics",
    "source_progress",
    "stamp_source_time",
    "switch_counts",
    "tag_mirrors",
    "to_message",
    "until_offsets",
    "validate_routes",
]
