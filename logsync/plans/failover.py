"""Replication from whichever of several identical sources is healthiest."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from datetime import datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.filters import Filter
from ..operators.health import active_history
from ..operators.lookup import BROADCAST_ROWS, bounded_rows, local_table
from ..schemas import HEALTH_SCHEMA, OFFSETS_SCHEMA
from ..sinks.targets import Target
from ..sources.read import LogSource, end_offsets
from .replicate import captured, relay_bounded, source_topics
from .tail import progress_of

# A source that cannot be read: a plan that fails, or a job that does.
UNREADABLE = (PySparkException, Py4JJavaError)

STATE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("candidate", T.IntegerType()),
        T.StructField("record", T.LongType()),
        T.StructField("active", T.IntegerType()),
    ]
)
# Fixed value: offsets by which a source may lag before it is given up.
LAG_THRESHOLD = 1_000


def poll_sources(
    spark: SparkSession, sources: Sequence[LogSource], topics: Sequence[str], tick: datetime
) -> DataFrame:
    """One health sample per source, topic and partition.

    A source that cannot be read yields a row with ok=false per topic.
    """
    rows = []
    for node, source in enumerate(sources):
        try:
            ends = bounded_rows(end_offsets(spark, source, topics), BROADCAST_ROWS)
            if ends is None:
                raise ValueError("more offsets than a cluster has partitions")
            seen = {row.topic for row in ends}
            rows += [(tick, r.topic, node, r.partition, r.next_offset, True) for r in ends]
            # A topic without records is healthy and weighs nothing.
            rows += [(tick, t, node, None, 0, True) for t in topics if t not in seen]
        except UNREADABLE:
            rows += [(tick, topic, node, None, None, False) for topic in topics]
    return local_table(spark, rows, HEALTH_SCHEMA)


def relay_with_failover(
    spark: SparkSession,
    sources: Sequence[LogSource],
    routes: DataFrame,
    target: Target,
    rounds: int,
    filters: Mapping[str, Filter] | None = None,
    threshold: int = LAG_THRESHOLD,
    mode: str = "source",
    partitions: int | None = None,
    poll: Callable[[int], DataFrame] | None = None,
    interval: float = 0.0,
    max_rounds_without_source: int | None = None,
    documented_rule: bool = True,
) -> list[dict[str, int | None]]:
    """Rounds of: poll health, settle the active source, copy what it has more.

    Every round starts from the target's own progress, so a change of source
    neither repeats nor loses messages. With ``documented_rule`` the healthy
    source with the largest weight becomes candidate, which is what a target
    already level with its sources needs; otherwise a candidate must exceed the
    weight remembered so far. ``poll`` replaces the health samples. Returns the
    active node per topic for each round.
    """
    topics = source_topics(routes)
    done = progress_of(spark, target, routes, _first_ends(spark, sources, topics))
    state = _initial_state(spark, topics, captured(spark, done))
    history: list[dict[str, int | None]] = []
    idle = 0
    for number in range(rounds):
        if number and interval:
            time.sleep(interval)
        tick = datetime.now(timezone.utc)
        health = poll(number) if poll else poll_sources(spark, sources, topics, tick)
        if documented_rule:
            # Forget the remembered weight: any healthy node may take over.
            state = state.withColumn("record", F.lit(-1).cast("bigint"))
        settled = active_history(health, threshold, state=state)
        rows = (
            settled.groupBy("topic")
            .agg(F.max_by(F.struct("candidate", "record", "node_id"), "tick").alias("now"))
            .select("topic", "now.candidate", "now.record", F.col("now.node_id").alias("active"))
            .collect()
        )
        state = local_table(spark, rows, STATE_SCHEMA)
        active = {row.topic: row.active for row in rows}
        history.append(active)
        idle = 0 if any(node is not None for node in active.values()) else idle + 1
        if max_rounds_without_source is not None and idle > max_rounds_without_source:
            raise RuntimeError(f"no healthy source in {idle} rounds")
        for node in sorted({n for n in active.values() if n is not None}):
            mine = [topic for topic, chosen in active.items() if chosen == node]
            try:
                relay_bounded(
                    spark,
                    sources[node],
                    routes.where(F.col("source_topic").isin(mine)),
                    target,
                    filters,
                    mode,
                    partitions,
                )
            except UNREADABLE:
                # A source that died under way leaves an uncounted batch, which
                # the next one replaces; anything else is not ours to hide.
                if _readable(spark, sources[node], mine):
                    raise
    return history


def _first_ends(spark: SparkSession, sources: Sequence[LogSource], topics: Sequence[str]) -> DataFrame:
    """End offsets of the first source that can be read; nothing where none can."""
    for source in sources:
        try:
            return local_table(spark, end_offsets(spark, source, topics).collect(), OFFSETS_SCHEMA)
        except UNREADABLE:
            continue
    return local_table(spark, [], OFFSETS_SCHEMA)


def _readable(spark: SparkSession, source: LogSource, topics: Sequence[str]) -> bool:
    try:
        end_offsets(spark, source, topics).collect()
    except UNREADABLE:
        return False
    return True


def _initial_state(spark: SparkSession, topics: Sequence[str], done: DataFrame) -> DataFrame:
    """No candidate yet; the weight to beat is what the target already holds."""
    sums = done.where(F.col("topic").isin(list(topics))).groupBy("topic").agg(
        F.sum("next_offset").alias("sum")
    )
    held = {row.topic: row["sum"] for row in sums.collect()}
    rows = [(topic, None, held.get(topic, 0), None) for topic in topics]
    return local_table(spark, rows, STATE_SCHEMA)
