"""From source records to target messages: topics, partitions, headers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.headers import (
    SOURCE_TIME_HEADER,
    append_headers,
    epoch_ns_text,
    single_header,
)
from ..schemas import MESSAGE_COLUMNS
from .lookup import LITERAL_ROWS, bounded_rows, lookup_join, refuse_repeats

PARTITION_MODES = ("source", "pinned", "auto")


def expect_topic(log: DataFrame, topic: str) -> DataFrame:
    """Fail the job on the first record of any other topic.

    Stated as a filter, so that column pruning cannot drop it.
    """
    complaint = F.concat(
        F.lit("record of unexpected topic "), F.coalesce("topic", F.lit("NULL"))
    )
    return log.where(
        F.when(F.col("topic").eqNullSafe(topic), F.lit(True)).otherwise(
            F.raise_error(complaint).cast("boolean")
        )
    )


def route_topics(log: DataFrame, routes: DataFrame) -> DataFrame:
    """Rename ``topic`` to its target topic; drop records without a route.

    Adds source_topic, source_partition, source_offset and target_partition
    (NULL where the route pins none). A source topic has one route; several are refused. A few routes
    are written into the plan, where they also let the scan skip other topics;
    many are looked up.
    """
    rows = bounded_rows(routes, LITERAL_ROWS)
    refuse_repeats(routes, ["source_topic"], rows)
    if rows is not None:
        log = log.where(F.col("topic").isin([row.source_topic for row in rows]))
    renamed = log.withColumnsRenamed(
        {"topic": "source_topic", "partition": "source_partition", "offset": "source_offset"}
    )
    if rows is None:
        return lookup_join(
            renamed, routes, ["source_topic"], spread="source_offset"
        ).withColumnRenamed("target_topic", "topic")
    topic, partition = F.lit(None).cast("string"), F.lit(None).cast("int")
    for row in rows:
        routed = F.col("source_topic") == row.source_topic
        topic = F.when(routed, F.lit(row.target_topic)).otherwise(topic)
        if row.target_partition is not None:
            partition = F.when(routed, F.lit(row.target_partition)).otherwise(partition)
    return renamed.withColumn("topic", topic).withColumn("target_partition", partition)


def route_partition(
    routed: DataFrame, mode: str = "source", partitions: int | None = None
) -> DataFrame:
    """Decide ``partition`` of routed records; a pinned route always wins.

    ``source``: the partition the record came from. ``pinned``: every route must
    pin one. ``auto``: the hash of the key over ``partitions`` (records without
    a key spread by source offset), or NULL, leaving it to the sink, when
    ``partitions`` is not given.
    """
    pinned = F.col("target_partition")
    if mode == "source":
        chosen = F.coalesce(pinned, F.col("source_partition"))
    elif mode == "pinned":
        chosen = F.when(pinned.isNotNull(), pinned).otherwise(
            F.raise_error(
                F.concat(F.lit("no partition pinned for topic "), F.col("source_topic"))
            ).cast("int")
        )
    elif mode == "auto":
        if partitions is None:
            hashed = F.lit(None)
        else:
            spread = F.when(F.col("key").isNotNull(), F.xxhash64("key")).otherwise(
                F.xxhash64("source_partition", "source_offset")
            )
            hashed = F.pmod(spread, F.lit(partitions))
        chosen = F.coalesce(pinned, hashed.cast("int"))
    else:
        raise ValueError(f"mode must be one of {PARTITION_MODES}, not {mode!r}")
    return routed.withColumn("partition", chosen.cast("int")).drop("target_partition")


def stamp_source_time(log: DataFrame, name: str = SOURCE_TIME_HEADER) -> DataFrame:
    """Put the record's own time in front of its headers."""
    stamp = single_header(name, epoch_ns_text("timestamp"))
    return log.withColumn("headers", append_headers(stamp, "headers"))


def to_message(
    log: DataFrame,
    routes: DataFrame,
    mode: str = "source",
    partitions: int | None = None,
) -> DataFrame:
    """Source records as messages for the target, source coordinates kept."""
    stamped = stamp_source_time(log)
    placed = route_partition(route_topics(stamped, routes), mode, partitions)
    return placed.withColumnRenamed("timestamp", "source_timestamp").select(*MESSAGE_COLUMNS)


def validate_routes(routes: DataFrame, catalog: DataFrame) -> DataFrame:
    """Routes whose target topic, or pinned target partition, does not exist."""
    columns = ["source_topic", "target_topic", "target_partition"]
    topics = catalog.select(F.col("topic").alias("target_topic")).distinct()
    known = catalog.select(
        F.col("topic").alias("target_topic"),
        F.col("partition").alias("target_partition"),
    )
    no_topic = routes.join(topics, "target_topic", "left_anti").select(
        *columns, F.lit("topic missing").alias("reason")
    )
    no_partition = (
        routes.where(F.col("target_partition").isNotNull())
        .join(topics, "target_topic", "left_semi")
        .join(known, ["target_topic", "target_partition"], "left_anti")
        .select(*columns, F.lit("partition missing").alias("reason"))
    )
    return no_topic.unionByName(no_partition)
