"""Message logs, mirrors, targets and health samples derived from ``events``."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logsync.functions import header_text
from logsync.functions.headers import single_header
from logsync.operators import local_table, number_rows, stamp_source_time
from logsync.schemas import LOG_COLUMNS, ROUTE_SCHEMA, TARGET_LOG_COLUMNS

TOPIC = "events"
COPY = "events_copy"
# Share of the log, in percent, that each mirror node and the target hold.
NODE_SHARES = (90, 100, 95)
TARGET_SHARE = 60

HOUR_US = 3_600_000_000
# Every tick minus every node's delay falls on this grid.
GRID_US = 3 * HOUR_US
FIRST_TICK = "2024-01-01 06:00:00"
LAST_TICK = "2024-01-31 00:00:00"
NODE_DELAY_HOURS = (0, 9, 48)


def _records(spark: SparkSession, sf_dir: str, topic: Column) -> DataFrame:
    # The tables hold UTC times without a zone.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    return events.select(
        topic.alias("topic"),
        (F.col("user_id") % 4).cast("int").alias("partition"),
        "event_id",
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("user_id").cast("string").cast("binary").alias("key"),
        F.col("props").cast("binary").alias("value"),
        single_header("event_type", F.col("event_type")).alias("headers"),
    )


def event_log(spark: SparkSession, sf_dir: str, with_id: bool = False) -> DataFrame:
    """All events as one topic of four partitions."""
    records = _records(spark, sf_dir, F.lit(TOPIC))
    log = number_rows(records, ["topic", "partition"], "event_id", "offset")
    return log.select(*LOG_COLUMNS, *(["event_id"] if with_id else []))


def typed_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One topic per event type, four partitions each."""
    records = _records(spark, sf_dir, F.col("event_type"))
    return number_rows(records, ["topic", "partition"], "event_id", "offset").select(*LOG_COLUMNS)


def gappy_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A compacted log: some records are gone, offsets stay."""
    log = event_log(spark, sf_dir, with_id=True)
    return log.where(F.col("event_id") % 10 != 3).drop("event_id")


def _with_size(spark: SparkSession, sf_dir: str, log: DataFrame) -> DataFrame:
    sizes = (
        _records(spark, sf_dir, F.lit(TOPIC))
        .groupBy("topic", "partition")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Four rows, as the partition is a remainder modulo four.
    return log.join(F.broadcast(sizes), ["topic", "partition"])


def log_share(spark: SparkSession, sf_dir: str, percent: int) -> DataFrame:
    """The first ``percent`` of every partition."""
    sized = _with_size(spark, sf_dir, event_log(spark, sf_dir))
    return sized.where(F.col("offset") * 100 < F.col("n") * percent).select(*LOG_COLUMNS)


def mirrors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the three nodes hold, in one pass over the log."""
    nodes = F.array(
        *[
            F.struct(F.lit(i).alias("node_id"), F.lit(share).alias("share"))
            for i, share in enumerate(NODE_SHARES)
        ]
    )
    return (
        _with_size(spark, sf_dir, event_log(spark, sf_dir))
        .withColumn("node", F.explode(nodes))
        .where(F.col("offset") * 100 < F.col("n") * F.col("node.share"))
        .select(*LOG_COLUMNS, "node.node_id")
    )


def target_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target's copy of the first part; arrival lags by offset % 60 s."""
    arrival = F.unix_micros("timestamp") + (F.col("offset") % 60) * 1_000_000
    return (
        stamp_source_time(log_share(spark, sf_dir, TARGET_SHARE))
        .withColumn("source_topic", F.col("topic"))
        .withColumn("source_partition", F.col("partition"))
        .withColumn("source_offset", F.col("offset"))
        .withColumn("topic", F.lit(COPY))
        .withColumn("timestamp", F.timestamp_micros(arrival))
        .select(*TARGET_LOG_COLUMNS)
    )


def bad_target_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target with records missing and values spoilt."""
    place = F.col("source_offset") % 50
    return (
        target_log(spark, sf_dir)
        .where(place != 7)
        .withColumn("value", F.when(place == 9, F.lit(b"{}")).otherwise(F.col("value")))
    )


def copy_routes(spark: SparkSession) -> DataFrame:
    return local_table(spark, [(TOPIC, COPY, None)], ROUTE_SCHEMA)


def typed_routes(spark: SparkSession) -> DataFrame:
    """Routes of the typed log; ``error`` has none."""
    return local_table(
        spark,
        [
            ("click", "web", None),
            ("view", "web", None),
            ("purchase", "orders", 0),
            ("signup", "orders", 1),
        ],
        ROUTE_SCHEMA,
    )


def filters() -> Mapping[str, Column]:
    return {
        "not_error": header_text("headers", "event_type") != "error",
        "small_k": F.get_json_object(F.col("value").cast("string"), "$.k").cast("int") < 50,
    }


def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End offsets polled every six hours from nodes with different delays.

    Events are counted once per partition and three hours, and running totals
    answer every (tick, node); events are not paired with ticks.
    """
    records = _records(spark, sf_dir, F.lit(TOPIC))
    epoch = F.unix_micros(F.to_timestamp(F.lit(FIRST_TICK)))
    first = (epoch / GRID_US).cast("bigint") - 48 // 3
    last = (F.unix_micros(F.to_timestamp(F.lit(LAST_TICK))) / GRID_US).cast("bigint")
    slot = F.greatest(F.expr(f"(unix_micros(timestamp) + {GRID_US - 1}) div {GRID_US}"), first)
    counts = records.groupBy("partition", slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    grid = records.select("partition").distinct().withColumn(
        "slot", F.explode(F.sequence(first, last))
    )
    running = W.partitionBy("partition").orderBy("slot")
    ends = grid.join(counts, ["partition", "slot"], "left").select(
        "partition", "slot", F.coalesce(F.sum("n").over(running), F.lit(0)).alias("end_offset")
    )

    nodes = F.array(
        *[
            F.struct(F.lit(i).alias("node_id"), F.lit(hours).alias("delay"))
            for i, hours in enumerate(NODE_DELAY_HOURS)
        ]
    )
    ticks = F.sequence(
        F.to_timestamp(F.lit(FIRST_TICK)), F.to_timestamp(F.lit(LAST_TICK)), F.expr("INTERVAL 6 HOURS")
    )
    frozen = F.to_timestamp(F.lit("2024-01-14 00:00:00"))
    seen_at = F.when(
        (F.col("node.node_id") == 1)
        & (F.col("tick") >= frozen)
        & (F.col("tick") < F.to_timestamp(F.lit("2024-01-18 00:00:00"))),
        frozen,
    ).otherwise(F.col("tick"))
    down = (
        (F.col("node.node_id") == 0)
        & (F.col("tick") >= F.to_timestamp(F.lit("2024-01-06 00:00:00")))
        & (F.col("tick") < F.to_timestamp(F.lit("2024-01-08 00:00:00")))
    )
    polls = (
        records.select("topic", "partition")
        .distinct()
        .withColumn("tick", F.explode(ticks))
        .withColumn("node", F.explode(nodes))
        .withColumn(
            "slot",
            (F.unix_micros(seen_at) / GRID_US).cast("bigint")
            - (F.col("node.delay") / 3).cast("bigint"),
        )
    )
    return polls.join(ends, ["partition", "slot"]).select(
        "tick",
        "topic",
        "node.node_id",
        "partition",
        F.when(~down, F.col("end_offset")).alias("end_offset"),
        (~down).alias("ok"),
    )


def lag_threshold(spark: SparkSession, sf_dir: str) -> int:
    """Two percent of the events."""
    return spark.read.parquet(f"{sf_dir}/events.parquet").count() // 50
