"""Continuous replication with Structured Streaming."""

from .health import ActiveHistory, active_history_stream
from .mirrors import dedupe_mirrors, merge_mirrors_stream
from .progress import (
    ProgressListener,
    batch_metrics,
    denied_totals,
    metrics_over_time,
    observe_relay,
    progress_metrics,
    progress_rows,
)
from .relay import relay_stream, relay_until_end

__all__ = [
    "ActiveHistory",
    "ProgressListener",
    "active_history_stream",
    "batch_metrics",
    "dedupe_mirrors",
    "denied_totals",
    "merge_mirrors_stream",
    "metrics_over_time",
    "observe_relay",
    "progress_metrics",
    "progress_rows",
    "relay_stream",
    "relay_until_end",
]
