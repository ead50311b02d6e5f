"""Continuous copies of one source, and copies that stop at its present end."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.filters import Filter, attribute_filters
from ..operators.intervals import offset_intervals
from ..operators.routing import to_message
from ..plans.replicate import captured, check_routes, refuse_unplaced, source_topics
from ..sinks.targets import TableTarget, Target
from ..sinks.write import write_log_stream
from ..sources.read import LogSource, read_log_stream
from .progress import batch_metrics, observe_relay


def relay_stream(
    spark: SparkSession,
    source: LogSource,
    routes: DataFrame,
    target: Target,
    checkpoint: str,
    filters: Mapping[str, Filter] | None = None,
    mode: str = "source",
    partitions: int | None = None,
    start: DataFrame | None = None,
    max_per_trigger: int | None = None,
    trigger: dict | None = None,
    name: str = "relay",
    catalog: DataFrame | None = None,
) -> StreamingQuery:
    """Copy the routed topics as they grow; the checkpoint resumes by itself.

    All routes share one query: a broadcast lookup places each record. ``start``
    counts on the first start only, so pass the same one, or none, afterwards.
    Routes are checked first, by the partitions that the target declares and by
    ``catalog``, if given.
    """
    refuse_unplaced(spark, target, routes)
    if catalog is not None:
        check_routes(routes, catalog)
    log = read_log_stream(spark, source, source_topics(routes), start, max_per_trigger)
    judged = attribute_filters(log, filters or {})
    counted = observe_relay(judged, list(filters or {}))
    skipped = None if start is None else captured(spark, start)

    class Judged:
        """Takes records with what the filters said, so that the target knows all that was dealt with."""

        def write_batch(self, batch: DataFrame, batch_id: int) -> None:
            allowed = batch.where(F.col("denied_by").isNull()).drop("denied_by")
            messages = to_message(allowed, routes, mode, partitions)
            if not isinstance(target, TableTarget):
                target.write_batch(messages, batch_id)
                return
            covered = offset_intervals(batch)
            if skipped is not None:
                # What the caller left out on purpose is no hole.
                before = skipped.withColumns({"low": F.lit(0).cast("long"), "high": F.col("next_offset")})
                covered = covered.unionByName(before.select(*covered.columns))
            target.write_batch(messages, batch_id, covered, batch_metrics(batch))

        def high_watermarks(self, spark: SparkSession) -> DataFrame:
            return target.high_watermarks(spark)

    return write_log_stream(counted, Judged(), checkpoint, trigger, name)


def relay_until_end(
    spark: SparkSession,
    source: LogSource,
    routes: DataFrame,
    target: Target,
    checkpoint: str,
    **options,
) -> StreamingQuery:
    """``relay_stream`` up to what the source holds at the start, in bounded batches.

    The engine fixes the end itself and counts as read what it has copied, so
    messages that arrive meanwhile belong to the next run on the checkpoint. The
    query ends by itself; ``awaitTermination`` waits for it.
    """
    return relay_stream(
        spark, source, routes, target, checkpoint, trigger={"availableNow": True}, **options
    )
