"""End offsets, resume and stop bounds, remaining work and gaps."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .intervals import PARTITION_KEYS, runs_of, stretches_of
from .lookup import (
    BROADCAST_ROWS,
    LITERAL_ROWS,
    bounded_rows,
    local_table,
    lookup_join,
    refuse_repeats,
)


def high_watermarks(log: DataFrame) -> DataFrame:
    """End offset (last offset + 1) of every topic-partition."""
    return log.groupBy(*PARTITION_KEYS).agg((F.max("offset") + 1).alias("next_offset"))


def source_progress(target_log: DataFrame) -> DataFrame:
    """Next source offset still to copy, from a target's source coordinates.

    Right whenever batches reach the target whole: remapped partitions, filtered
    rows and foreign writes do not disturb it, unlike the target's own offsets.
    """
    return (
        target_log.where(F.col("source_offset").isNotNull())
        .groupBy(
            F.col("source_topic").alias("topic"),
            F.col("source_partition").alias("partition"),
        )
        .agg((F.max("source_offset") + 1).alias("next_offset"))
    )


# Records without topic or partition belong nowhere and are left out.
_PLACED = "topic IS NOT NULL AND partition IS NOT NULL"


def after_offsets(
    log: DataFrame,
    offsets: DataFrame,
    missing: str = "start",
    literal_rows: int = LITERAL_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows at or beyond the next offset of their partition.

    Partitions absent from ``offsets`` are read from the start, or left out with
    ``missing="skip"``. The offsets are captured when this is called. A few of
    them become literals that reach the Parquet scan; more are broadcast, next
    to the lowest bound as a literal; too many for that are joined salted.
    """
    if missing not in ("start", "skip"):
        raise ValueError(f"missing must be start or skip, not {missing!r}")
    table = offsets.select(*PARTITION_KEYS, "next_offset")
    rows = bounded_rows(table, broadcast_rows)
    refuse_repeats(table, PARTITION_KEYS, rows)
    log = log.where(_PLACED)
    if rows is not None and len(rows) <= literal_rows:
        return log.where(_from_literals(rows, missing))
    if rows is not None:
        table = local_table(log.sparkSession, rows, table.schema)
        if missing == "skip":
            log = log.where(F.col("offset") >= min(row.next_offset for row in rows))
    how = "left" if missing == "start" else "inner"
    return (
        lookup_join(log, table, PARTITION_KEYS, how, limit=broadcast_rows)
        .where(F.col("offset") >= F.coalesce("next_offset", F.lit(0)))
        .select(*log.columns)
    )


def until_offsets(
    log: DataFrame,
    ends: DataFrame,
    literal_rows: int = LITERAL_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """Rows below the end offset of their partition, as captured by this call.

    A partition without an end did not exist then and is left out.
    """
    table = ends.select(*PARTITION_KEYS, "next_offset")
    rows = bounded_rows(table, broadcast_rows)
    refuse_repeats(table, PARTITION_KEYS, rows)
    log = log.where(_PLACED)
    if rows is not None and len(rows) <= literal_rows:
        kept = [_is_partition(row) & (F.col("offset") < row.next_offset) for row in rows]
        return log.where(_any(kept))
    if rows is not None:
        table = local_table(log.sparkSession, rows, table.schema)
        log = log.where(F.col("offset") < max(row.next_offset for row in rows))
    return (
        lookup_join(log, table, PARTITION_KEYS, limit=broadcast_rows)
        .where(F.col("offset") < F.col("next_offset"))
        .select(*log.columns)
    )


def between_offsets(
    log: DataFrame,
    start: DataFrame,
    ends: DataFrame,
    missing: str = "start",
    literal_rows: int = LITERAL_ROWS,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """``after_offsets`` and ``until_offsets`` as one range per partition.

    The partitions are those with an end, so nothing is open-ended and the scan
    of a log laid out by partition gets offset bounds too.
    """
    if missing not in ("start", "skip"):
        raise ValueError(f"missing must be start or skip, not {missing!r}")
    ranges = ends.select(*PARTITION_KEYS, F.col("next_offset").alias("_end")).join(
        start.select(*PARTITION_KEYS, F.col("next_offset").alias("_start")),
        PARTITION_KEYS,
        "left" if missing == "start" else "inner",
    )
    ranges = ranges.withColumn("_start", F.coalesce("_start", F.lit(0))).where(
        F.col("_start") < F.col("_end")
    )
    rows = bounded_rows(ranges, broadcast_rows)
    refuse_repeats(ranges, PARTITION_KEYS, rows)
    log = log.where(_PLACED)
    if rows is not None and len(rows) <= literal_rows:
        kept = [
            _is_partition(row) & (F.col("offset") >= row._start) & (F.col("offset") < row._end)
            for row in rows
        ]
        return log.where(_any(kept))
    if rows is not None:
        ranges = local_table(log.sparkSession, rows, ranges.schema)
        log = log.where(
            (F.col("offset") >= min(row._start for row in rows))
            & (F.col("offset") < max(row._end for row in rows))
        )
    return (
        lookup_join(log, ranges, PARTITION_KEYS, limit=broadcast_rows)
        .where((F.col("offset") >= F.col("_start")) & (F.col("offset") < F.col("_end")))
        .select(*log.columns)
    )


def _is_partition(row: Row) -> Column:
    return (F.col("topic") == row.topic) & (F.col("partition") == row.partition)


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def _from_literals(rows: list[Row], missing: str) -> Column:
    if missing == "skip":
        return _any([_is_partition(r) & (F.col("offset") >= r.next_offset) for r in rows])
    # Kept unless below its partition's bound; each factor is a pushable OR.
    factors = [
        (F.col("topic") != r.topic)
        | (F.col("partition") != r.partition)
        | (F.col("offset") >= r.next_offset)
        for r in rows
    ]
    return reduce(lambda a, b: a & b, factors, F.lit(True))


def remaining_offsets(source_ends: DataFrame, target_ends: DataFrame) -> DataFrame:
    """Messages still to copy per source partition.

    A partition the target lacks counts in full; one only the target has is
    ignored. Both tables have one row per topic-partition.
    """
    done = target_ends.select(*PARTITION_KEYS, F.col("next_offset").alias("_done"))
    return source_ends.join(done, PARTITION_KEYS, "left").select(
        *PARTITION_KEYS,
        (F.col("next_offset") - F.coalesce("_done", F.lit(0))).alias("remaining"),
    )


def reached_end(remaining: DataFrame) -> DataFrame:
    """One row: is nothing left to copy? True when there are no partitions."""
    return remaining.agg(
        F.coalesce(F.bool_and(F.col("remaining") <= 0), F.lit(True)).alias("reached")
    )


def gap_report(log: DataFrame) -> DataFrame:
    """Ranges of missing offsets inside each partition, bounds included.

    A bitmap per stretch of 32,768 offsets, combined map-side, tells which
    stretches are incomplete, whatever repeats the log holds, and which offsets
    they lack. The log is read once, and none of its rows is shuffled.
    """
    stretches = stretches_of(log)
    by_stretch = W.partitionBy(*PARTITION_KEYS).orderBy("_stretch")
    linked = stretches.withColumn("_next", F.lead("_low").over(by_stretch))

    incomplete = linked.where(F.col("_seen") < F.col("_high") - F.col("_low") + 1)
    bounds = incomplete.select(*PARTITION_KEYS, "_stretch", "_low", "_high")
    inside = (
        runs_of(incomplete)
        .where(~F.col("present"))
        .join(bounds, [*PARTITION_KEYS, "_stretch"])
        .where((F.col("low") > F.col("_low")) & (F.col("high") <= F.col("_high")))
    )
    between = linked.where(F.col("_next") > F.col("_high") + 1).select(
        *PARTITION_KEYS, (F.col("_high") + 1).alias("low"), F.col("_next").alias("high")
    )
    return inside.select(*PARTITION_KEYS, "low", "high").unionByName(between).select(
        *PARTITION_KEYS, F.col("low").alias("gap_start"), (F.col("high") - 1).alias("gap_end")
    )
