"""Writing messages, once or continuously."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from .targets import TableTarget, Target


def write_log(messages: DataFrame, target: Target, batch_id: int | None = None) -> int:
    """Write a bounded set of messages; returns the batch id used."""
    if batch_id is None:
        if isinstance(target, TableTarget):
            batch_id = target.next_batch_id(messages.sparkSession)
        else:
            batch_id = 0
    target.write_batch(messages, batch_id)
    return batch_id


def write_batch_idempotent(messages: DataFrame, batch_id: int, path: str) -> None:
    """Write a batch to the table log at ``path``; a repeat adds nothing."""
    TableTarget(path).write_batch(messages, batch_id)


def write_log_stream(
    messages: DataFrame,
    target: Target,
    checkpoint: str,
    trigger: dict | None = None,
    name: str | None = None,
) -> StreamingQuery:
    """Write a stream in micro-batches.

    ``trigger`` holds arguments of ``DataStreamWriter.trigger``; the source's
    ``max_per_trigger`` bounds a batch's size.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        # A target may go over the batch more than once.
        batch.persist()
        try:
            target.write_batch(batch, batch_id)
        finally:
            batch.unpersist()

    writer = messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    return writer.trigger(**(trigger or {"processingTime": "1 second"})).start()
