"""Bounded replication: what a source still owes its target."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import Filter, filter_messages
from ..operators.intervals import INTERVAL_SCHEMA, outside_intervals
from ..operators.lookup import BROADCAST_ROWS, bounded_rows, local_table
from ..operators.offsets import after_offsets
from ..operators.routing import to_message, validate_routes
from ..schemas import OFFSETS_SCHEMA
from ..session import run_folder
from ..sinks.targets import TableTarget, Target
from ..sources.read import LogSource, end_offsets, read_log
from .tail import progress_of


def outstanding_messages(
    log: DataFrame,
    progress: DataFrame,
    routes: DataFrame,
    filters: Mapping[str, Filter] | None = None,
    mode: str = "source",
    partitions: int | None = None,
    missing: str = "start",
) -> DataFrame:
    """Messages of ``log`` beyond ``progress``, filtered, routed and stamped.

    A map-only plan over the log: the bounds, the routes and the filters are
    all decided row by row.
    """
    pending = filter_messages(after_offsets(log, progress, missing), filters or {})
    return to_message(pending, routes, mode, partitions)


def source_topics(routes: DataFrame) -> list[str]:
    rows = bounded_rows(routes.select("source_topic").distinct(), BROADCAST_ROWS)
    if rows is None:
        raise ValueError("more routes than a cluster has topics")
    return [row.source_topic for row in rows]


def check_routes(routes: DataFrame, catalog: DataFrame) -> None:
    """Refuse to start when a target topic or pinned partition is missing."""
    problems = validate_routes(routes, catalog).limit(20).collect()
    if problems:
        listed = "; ".join(
            f"{p.source_topic} -> {p.target_topic}:{p.target_partition} ({p.reason})"
            for p in problems
        )
        raise ValueError(f"routes without a place to go: {listed}")


def refuse_unplaced(spark: SparkSession, target: Target, routes: DataFrame) -> None:
    """``check_routes`` by what the target says that it has, if it does."""
    known = target.catalog(spark) if hasattr(target, "catalog") else None
    if known is not None:
        check_routes(routes, known)


def captured(spark: SparkSession, offsets: DataFrame) -> DataFrame:
    """The offsets as they are now, independent of later writes."""
    rows = bounded_rows(offsets.select(*OFFSETS_SCHEMA.fieldNames()), BROADCAST_ROWS)
    if rows is None:
        raise ValueError("more offsets than a cluster has partitions")
    return local_table(spark, rows, OFFSETS_SCHEMA)


def relay_bounded(
    spark: SparkSession,
    source: LogSource,
    routes: DataFrame,
    target: Target,
    filters: Mapping[str, Filter] | None = None,
    mode: str = "source",
    partitions: int | None = None,
    missing: str = "start",
    max_per_round: int | None = None,
) -> int:
    """Copy from where the target stands up to the ends seen now, and stop.

    Start and stop bounds both reach the scan. A target that tells which offsets
    it has dealt with gets those it lacks, holes behind others included.
    ``max_per_round`` copies at most that many offsets of a partition at a time,
    one batch after the other: a target that takes a partition from a single
    task, in order, is never handed an unbounded one, and a job that is lost
    resumes at its last round. By default the target decides. Returns the number
    of batches written.
    """
    topics = source_topics(routes)
    refuse_unplaced(spark, target, routes)
    ends = captured(spark, end_offsets(spark, source, topics))
    start = captured(spark, progress_of(spark, target, routes, ends))
    done = _done_beyond(target, start) if isinstance(target, TableTarget) else None
    if max_per_round is None:
        max_per_round = getattr(target, "max_per_round", None)
    batches = 0
    for low, high in rounds(start, ends, missing, max_per_round):
        log = read_log(spark, source, topics, _offsets(spark, low), _offsets(spark, high), "skip")
        if done is not None:
            log = outside_intervals(log, done)
        messages = to_message(filter_messages(log, filters or {}), routes, mode, partitions)
        if isinstance(target, TableTarget):
            judged = [(*pair, low[pair], high[pair]) for pair in low]
            target.write_batch(messages, target.next_batch_id(spark), local_table(spark, judged, INTERVAL_SCHEMA))
        else:
            target.write_batch(messages, batches)
        batches += 1
    return batches


def _done_beyond(target: TableTarget, start: DataFrame) -> DataFrame | None:
    """Intervals that the target has dealt with behind its first hole; nothing where it has none."""
    spark = start.sparkSession
    behind = (
        target.covered(spark)
        .join(F.broadcast(start), ["topic", "partition"])
        .where(F.col("low") > F.col("next_offset"))
        .select(*INTERVAL_SCHEMA.fieldNames())
    )
    rows = bounded_rows(behind, BROADCAST_ROWS)
    if rows is not None:
        return local_table(spark, rows, INTERVAL_SCHEMA) if rows else None
    # As they are now: snapshots go when newer ones come.
    path = run_folder(spark, "dealt-with")
    behind.write.parquet(path)
    return spark.read.schema(INTERVAL_SCHEMA).parquet(path)


def _offsets(spark: SparkSession, offsets: Mapping[tuple[str, int], int]) -> DataFrame:
    return local_table(spark, [(*pair, offset) for pair, offset in offsets.items()], OFFSETS_SCHEMA)


def rounds(
    start: DataFrame, ends: DataFrame, missing: str, width: int | None
) -> Iterator[tuple[dict[tuple[str, int], int], dict[tuple[str, int], int]]]:
    """Start and end offsets of each round, for the partitions it advances.

    The longest partition takes ``width`` offsets a round and so decides how
    many rounds there are; the others are spread over all of them by what they
    have left, so rounds are alike and end together. Only the round at hand is kept.
    """
    first = {(row.topic, row.partition): row.next_offset for row in start.collect()}
    at: dict[tuple[str, int], int] = {}
    last: dict[tuple[str, int], int] = {}
    for row in ends.collect():
        pair = (row.topic, row.partition)
        low = first.get(pair, 0 if missing == "start" else row.next_offset)
        if low < row.next_offset:
            at[pair], last[pair] = low, row.next_offset
    while at:
        most = max(last[pair] - low for pair, low in at.items())
        left = 1 if width is None else -(-most // width)
        upto = {pair: low + -(-(last[pair] - low) // left) for pair, low in at.items()}
        yield at, upto
        at = {pair: offset for pair, offset in upto.items() if offset < last[pair]}
