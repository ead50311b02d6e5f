"""Comparing source and target, and counting what was copied."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.headers import SOURCE_TIME_HEADER, header_text
from ..functions.payload import payload_fingerprint
from ..schemas import SOURCE_COORDINATES


def reconcile(source: DataFrame, target_log: DataFrame) -> DataFrame:
    """Source coordinates where source and target disagree, with a status.

    ``missing`` from the target, ``unexpected`` in it, ``repeated`` in it, or
    ``different`` in key or value. Payloads are reduced to a hash before the one
    shuffle, whose keys include the offset and whose counts are combined
    map-side, so neither a hot partition nor a hot coordinate reaches one task.
    """
    wanted = source.select(
        F.col("topic").alias("source_topic"),
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        payload_fingerprint("key", "value").alias("_print"),
        F.lit(True).alias("_wanted"),
    )
    found = target_log.where(F.col("source_offset").isNotNull()).select(
        *SOURCE_COORDINATES,
        payload_fingerprint("key", "value").alias("_print"),
        F.lit(False).alias("_wanted"),
    )
    sides = (
        wanted.unionByName(found)
        .groupBy(*SOURCE_COORDINATES)
        .agg(
            F.count_if("_wanted").alias("_in_source"),
            F.count_if(~F.col("_wanted")).alias("_in_target"),
            F.min("_print").alias("_least"),
            F.max("_print").alias("_most"),
        )
    )
    status = (
        F.when(F.col("_in_target") == 0, "missing")
        .when(F.col("_in_source") == 0, "unexpected")
        .when(F.col("_least") != F.col("_most"), "different")
        .when(F.col("_in_target") > 1, "repeated")
    )
    return sides.select(*SOURCE_COORDINATES, status.alias("status")).where(
        F.col("status").isNotNull()
    )


def relayed_counts(messages: DataFrame) -> DataFrame:
    """Messages per source and target topic-partition; -1 for an open partition."""
    return messages.groupBy(
        "source_topic",
        "source_partition",
        F.col("topic").alias("target_topic"),
        F.coalesce("partition", F.lit(-1)).alias("target_partition"),
    ).agg(F.count(F.lit(1)).alias("n"))


def replication_lag(
    target_log: DataFrame, window: str = "1 hour", watermark: str | None = None
) -> DataFrame:
    """Arrival minus source time, per arrival window and target partition.

    ``watermark`` bounds the state of a streaming query; batches need none.
    """
    source_ns = header_text("headers", SOURCE_TIME_HEADER).cast("bigint")
    timed = target_log.select(
        "topic",
        "partition",
        "timestamp",
        ((F.unix_micros("timestamp") * 1000 - source_ns) / 1_000_000).alias("_lag_ms"),
    )
    if watermark is not None:
        timed = timed.withWatermark("timestamp", watermark)
    return (
        timed.groupBy(F.window("timestamp", window).alias("_window"), "topic", "partition")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.avg("_lag_ms").alias("avg_lag_ms"),
            F.percentile_approx("_lag_ms", 0.5).alias("p50_lag_ms"),
            F.percentile_approx("_lag_ms", 0.95).alias("p95_lag_ms"),
            F.max("_lag_ms").alias("max_lag_ms"),
        )
        .select(
            F.col("_window.start").alias("window_start"),
            "topic",
            "partition",
            "n",
            "avg_lag_ms",
            "p50_lag_ms",
            "p95_lag_ms",
            "max_lag_ms",
        )
    )
