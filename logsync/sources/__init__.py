"""Message logs as bounded or unbounded DataFrames."""

from .kafka import KafkaLog, offsets_from_json, offsets_json
from .read import end_offsets, read_log, read_log_stream, read_mirrors
from .table import TableLog

__all__ = [
    "KafkaLog",
    "TableLog",
    "end_offsets",
    "offsets_from_json",
    "offsets_json",
    "read_log",
    "read_log_stream",
    "read_mirrors",
]
