"""Merging mirrored sources while they grow."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from ..operators.intervals import offset_intervals, outside_intervals
from ..operators.mirrors import COORDINATES, merge_mirrors
from ..operators.routing import to_message
from ..sinks.targets import TableTarget
from ..sinks.write import write_log_stream


def dedupe_mirrors(mirrors: DataFrame, delay: str) -> DataFrame:
    """First copy of every coordinate among those at most ``delay`` apart.

    Keeps that much state. A mirror lagging further behind than ``delay`` loses
    first copies, so use it only where the lag is known to be smaller.
    """
    return mirrors.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(COORDINATES)


def merge_mirrors_stream(
    mirrors: DataFrame,
    routes: DataFrame,
    target: TableTarget,
    checkpoint: str,
    prefer: int | None = None,
    delay: str | None = None,
    trigger: dict | None = None,
    name: str = "merge-mirrors",
) -> StreamingQuery:
    """Copy all mirrors at once, every coordinate a single time.

    ``mirrors`` is a stream with ``node_id``. Copies inside a batch are merged,
    and what the target has dealt with, which it keeps as intervals of offsets, is
    left out; no other state is kept and mirrors may lag as far as they like. ``delay`` thins the stream beforehand.
    """
    if delay is not None:
        mirrors = dedupe_mirrors(mirrors, delay)

    class Merged:
        def write_batch(self, batch: DataFrame, batch_id: int) -> None:
            # What was dealt with goes before copies are compared, without a look at the target's log.
            fresh = outside_intervals(batch, target.covered(batch.sparkSession))
            messages = to_message(merge_mirrors(fresh, prefer).drop("node_id"), routes)
            # Written down once, as numbering goes over the merged batch twice.
            replace(target, stage=True).write_batch(messages, batch_id, offset_intervals(batch))

        def high_watermarks(self, spark):
            return target.high_watermarks(spark)

    return write_log_stream(mirrors, Merged(), checkpoint, trigger, name)
