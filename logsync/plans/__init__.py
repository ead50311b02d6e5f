"""Whole replication plans put together from the operators."""

from .failover import relay_with_failover
from .replicate import captured, check_routes, outstanding_messages, relay_bounded, rounds
from .tail import progress_of, tail_progress

__all__ = [
    "captured",
    "check_routes",
    "outstanding_messages",
    "progress_of",
    "relay_bounded",
    "relay_with_failover",
    "rounds",
    "tail_progress",
]
