"""Targets that messages are written to."""

from .committed import BatchSink, CommittedTarget, FolderSink, RowTarget, write_committed
from .options import ack_policy, compression_codec, write_options
from .order import order_for_write, staged_rounds
from .targets import KafkaTarget, TableTarget, Target, missing_from
from .write import write_batch_idempotent, write_log, write_log_stream

__all__ = [
    "BatchSink",
    "CommittedTarget",
    "FolderSink",
    "KafkaTarget",
    "RowTarget",
    "TableTarget",
    "Target",
    "ack_policy",
    "compression_codec",
    "missing_from",
    "order_for_write",
    "staged_rounds",
    "write_batch_idempotent",
    "write_committed",
    "write_log",
    "write_log_stream",
    "write_options",
]
