"""One query per operator, each over the whole of the test tables."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from logsync.functions import append_headers, epoch_ns_text, header_text
from logsync.functions.headers import single_header
from logsync.operators import (
    active_history,
    after_offsets,
    assign_target_offsets,
    attribute_filters,
    between_offsets,
    candidate_history,
    elect_source,
    expect_topic,
    filter_messages,
    filtered_counts,
    gap_report,
    high_watermarks,
    lag_breaches,
    merge_mirrors,
    node_health_summary,
    node_weights,
    opaque_filter,
    reached_end,
    reconcile,
    relayed_counts,
    remaining_offsets,
    replication_lag,
    route_topics,
    source_progress,
    stamp_source_time,
    switch_counts,
    tag_mirrors,
    to_message,
    validate_routes,
)
from logsync.operators.intervals import offset_intervals
from logsync.plans import captured, outstanding_messages, relay_bounded, relay_with_failover
from logsync.schemas import HEALTH_SCHEMA
from logsync.session import run_folder
from logsync.sinks import (
    CommittedTarget,
    RowTarget,
    TableTarget,
    order_for_write,
    staged_rounds,
    write_batch_idempotent,
    write_log,
    write_options,
)
from logsync.sinks.targets import source_coordinates
from logsync.sources import TableLog, end_offsets, read_log_stream, read_mirrors
from logsync.streaming import (
    ActiveHistory,
    active_history_stream,
    denied_totals,
    merge_mirrors_stream,
    progress_metrics,
    relay_until_end,
)

from . import views
from .sinks import FailsOnce, FileBroker

Query = Callable[[SparkSession, str], DataFrame]

# Offsets of a partition in a batch of a committed write.
ROUND_OFFSETS = 250_000


def _ntz(name: str):
    return F.col(name).cast("timestamp_ntz").alias(name)


# --- replication plans ------------------------------------------------------


def relay_resume_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the full node still owes the target, filtered, routed and stamped."""
    messages = outstanding_messages(
        views.event_log(spark, sf_dir),
        source_progress(views.target_log(spark, sf_dir)),
        views.copy_routes(spark),
        views.filters(),
    )
    return messages.select(
        F.col("topic").alias("target_topic"),
        F.col("partition").alias("target_partition"),
        "source_partition",
        "source_offset",
        F.col("key").cast("string").alias("key"),
        F.col("value").cast("string").alias("value"),
        header_text("headers", "_t").alias("t_ns"),
    )


def relay_multi_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    messages = to_message(views.typed_log(spark, sf_dir), views.typed_routes(spark))
    return messages.select(
        "source_topic",
        F.col("topic").alias("target_topic"),
        F.col("partition").alias("target_partition"),
        "source_partition",
        "source_offset",
    )


def relay_until_end_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Between the target's progress and the ends a lagging node showed at start."""
    log = views.event_log(spark, sf_dir)
    start = source_progress(views.target_log(spark, sf_dir))
    ends = high_watermarks(views.log_share(spark, sf_dir, views.NODE_SHARES[0]))
    bounded = between_offsets(log, start, ends)
    return bounded.select(
        F.col("partition").alias("source_partition"), F.col("offset").alias("source_offset")
    )


def failover_round(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One round over three table logs: the most advanced node is copied from."""
    folder = run_folder(spark, "failover-round")
    sources = [TableLog(f"{folder}/node{i}") for i in range(len(views.NODE_SHARES))]
    for source, share in zip(sources, views.NODE_SHARES):
        source.append(views.log_share(spark, sf_dir, share))
    target = TableTarget(f"{folder}/target")
    routes = views.copy_routes(spark)
    write_log(to_message(views.log_share(spark, sf_dir, views.TARGET_SHARE), routes), target)
    before = high_watermarks(
        target.read(spark).select(
            F.col("source_topic").alias("topic"),
            F.col("source_partition").alias("partition"),
            F.col("source_offset").alias("offset"),
        )
    )
    before = captured(spark, before)
    history = relay_with_failover(spark, sources, routes, target, rounds=1)
    copied = target.read(spark).select(
        F.col("source_topic").alias("topic"),
        F.col("source_partition").alias("partition"),
        F.col("source_offset").alias("offset"),
    )
    return after_offsets(copied, before).select(
        F.col("partition").alias("source_partition"),
        F.col("offset").alias("source_offset"),
        F.lit(history[-1][views.TOPIC]).alias("node_id"),
    )


# --- records and headers ----------------------------------------------------


def message_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headers after stamping and appending: the stamp comes first."""
    log = expect_topic(stamp_source_time(views.event_log(spark, sf_dir)), views.TOPIC)
    extra = single_header("event_type", F.lit("again"))
    headers = append_headers("headers", extra)
    return log.select(
        "partition",
        "offset",
        F.try_element_at(headers, F.lit(1))["key"].alias("first_name"),
        header_text(headers, "_t").alias("t_ns"),
        header_text(headers, "event_type").alias("event_type"),
        header_text(headers, "event_type", 2).alias("second_event_type"),
        (epoch_ns_text("timestamp").cast("string") == header_text(headers, "_t")).alias("same"),
    )


def target_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offsets in targets fed by several sources; ``web`` holds the log already."""
    messages = to_message(views.typed_log(spark, sf_dir), views.typed_routes(spark))
    base = high_watermarks(views.event_log(spark, sf_dir)).withColumn("topic", F.lit("web"))
    return assign_target_offsets(messages, base).select(
        "topic",
        "partition",
        "source_topic",
        "source_partition",
        "source_offset",
        F.col("offset").alias("target_offset"),
    )


# --- offsets ----------------------------------------------------------------


def full_high_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return high_watermarks(views.event_log(spark, sf_dir))


def gappy_high_watermarks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return end_offsets(spark, views.gappy_log(spark, sf_dir), [views.TOPIC])


def _remaining(spark: SparkSession, sf_dir: str, share: int) -> DataFrame:
    return remaining_offsets(
        high_watermarks(views.log_share(spark, sf_dir, share)),
        source_progress(views.target_log(spark, sf_dir)),
    )


def remaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _remaining(spark, sf_dir, 100).select("partition", "remaining")


def reached(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not for the full node, but for one that holds what the target holds."""
    full = reached_end(_remaining(spark, sf_dir, 100))
    level = reached_end(_remaining(spark, sf_dir, views.TARGET_SHARE))
    return full.select(F.lit("full").alias("node"), "reached").unionByName(
        level.select(F.lit("level").alias("node"), "reached")
    )


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gap_report(views.gappy_log(spark, sf_dir))


# --- filters and counts -----------------------------------------------------


def filter_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = attribute_filters(views.event_log(spark, sf_dir), views.filters())
    return judged.select("partition", "offset", "denied_by")


def denied_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filtered_counts(attribute_filters(views.event_log(spark, sf_dir), views.filters()))


def opaque(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The field test as user code over the value bytes."""

    def below(value, bound):
        return value is not None and json.loads(value)["k"] < bound

    log = views.event_log(spark, sf_dir)
    rules = {"small_k": opaque_filter(below, bound=50)}
    return filter_messages(log, rules).select("partition", "offset")


def copied_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relayed_counts(to_message(views.typed_log(spark, sf_dir), views.typed_routes(spark)))


def open_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As above with the partition left to the sink where no route pins one."""
    return relayed_counts(
        to_message(views.typed_log(spark, sf_dir), views.typed_routes(spark), "auto")
    )


# --- mirrors and audits -----------------------------------------------------


def mirror_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = [views.log_share(spark, sf_dir, share) for share in views.NODE_SHARES]
    return tag_mirrors(logs).select("node_id", "partition", "offset")


def merged_mirrors(spark: SparkSession, sf_dir: str) -> DataFrame:
    merged = merge_mirrors(views.mirrors(spark, sf_dir), prefer=2)
    return merged.select("partition", "offset", "node_id", F.col("value").cast("string").alias("value"))


def route_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes of all event types against the partitions the log has filled."""
    log = views.typed_log(spark, sf_dir)
    planned = views.typed_routes(spark)
    routes = (
        log.select(F.col("topic").alias("source_topic"))
        .distinct()
        .join(F.broadcast(planned), "source_topic", "left")
        .withColumn("target_topic", F.coalesce("target_topic", F.lit("alerts")))
    )
    filled = route_topics(log.where(F.col("topic") != "signup"), planned)
    catalog = filled.select(
        "topic", F.coalesce("target_partition", "source_partition").alias("partition")
    ).distinct()
    return validate_routes(routes, catalog)


def differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A damaged target against the part of the source it should hold."""
    source = views.log_share(spark, sf_dir, views.TARGET_SHARE)
    return reconcile(source, views.bad_target_log(spark, sf_dir)).select(
        "source_partition", "source_offset", "status"
    )


def lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replication_lag(views.target_log(spark, sf_dir), "1 day").select(
        _ntz("window_start"),
        "partition",
        "n",
        F.col("max_lag_ms").cast("bigint").alias("max_lag_ms"),
        F.round("avg_lag_ms", 3).alias("avg_lag_ms"),
    )


# --- source election --------------------------------------------------------


def weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return node_weights(views.health(spark, sf_dir)).select(_ntz("tick"), "node_id", "weight")


def elected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return elect_source(views.health(spark, sf_dir)).select(_ntz("tick"), "node_id", "weight")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidate_history(views.health(spark, sf_dir)).select(_ntz("tick"), "node_id", "weight")


def _active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return active_history(views.health(spark, sf_dir), views.lag_threshold(spark, sf_dir))


def active(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _active(spark, sf_dir).select(_ntz("tick"), "node_id", "previous_node")


def _breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lag_breaches(
        node_weights(views.health(spark, sf_dir)),
        _active(spark, sf_dir),
        views.lag_threshold(spark, sf_dir),
    )


def breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _breaches(spark, sf_dir).select(_ntz("tick"), "active_node", "node_id", "lead")


def switches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return switch_counts(_active(spark, sf_dir))


def health_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return node_health_summary(views.health(spark, sf_dir), _breaches(spark, sf_dir)).select(
        "node_id", "last_weight", "failed", "breaches", "polls"
    )


# --- sinks and streams ------------------------------------------------------


def write_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = TableTarget(run_folder(spark, "write-read-back"))
    write_log(to_message(views.event_log(spark, sf_dir), views.copy_routes(spark)), target)
    return target.read(spark).select(
        "partition", "offset", "source_offset", F.col("value").cast("string").alias("value")
    )


def idempotent_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first part as batch 0, twice, then the rest as batch 1, twice."""
    folder = run_folder(spark, "idempotent-batch")
    routes = views.copy_routes(spark)
    first = to_message(views.log_share(spark, sf_dir, views.TARGET_SHARE), routes)
    rest = outstanding_messages(
        views.event_log(spark, sf_dir), source_progress(views.target_log(spark, sf_dir)), routes
    )
    for batch_id, messages in ((0, first), (0, first), (1, rest), (1, rest)):
        write_batch_idempotent(messages, batch_id, folder)
    return TableTarget(folder).read(spark).select("partition", "offset", "source_offset")


def stream_relay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A filtered stream up to the present end, a few files per batch."""
    folder = run_folder(spark, "stream-relay")
    source, target = TableLog(f"{folder}/source"), TableTarget(f"{folder}/target")
    source.append(views.event_log(spark, sf_dir))
    relay_until_end(
        spark, source, views.copy_routes(spark), target, f"{folder}/checkpoint",
        filters=views.filters(), max_per_trigger=2,
    ).awaitTermination()
    return target.read(spark).select("partition", "offset", "source_offset")


def stream_merge_mirrors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three mirrors streamed at once into one target."""
    folder = run_folder(spark, "stream-merge-mirrors")
    sources = [TableLog(f"{folder}/node{i}") for i in range(len(views.NODE_SHARES))]
    for source, share in zip(sources, views.NODE_SHARES):
        source.append(views.log_share(spark, sf_dir, share))
    streams = [read_log_stream(spark, s, [views.TOPIC], max_per_trigger=2) for s in sources]
    target = TableTarget(f"{folder}/target")
    merge_mirrors_stream(
        tag_mirrors(streams), views.copy_routes(spark), target, f"{folder}/checkpoint",
        trigger={"availableNow": True},
    ).awaitTermination()
    return target.read(spark).select(F.col("source_partition").alias("partition"), F.col("source_offset").alias("offset"))


def stored_mirrors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mirrors kept as table logs, read back and merged."""
    folder = run_folder(spark, "stored-mirrors")
    sources = [TableLog(f"{folder}/node{i}") for i in range(len(views.NODE_SHARES))]
    for source, share in zip(sources, views.NODE_SHARES):
        source.append(views.log_share(spark, sf_dir, share))
    merged = merge_mirrors(read_mirrors(spark, sources, [views.TOPIC]))
    return merged.select("partition", "offset", "node_id")


def stream_active_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The source in use, followed through a week of health samples per batch."""
    folder = run_folder(spark, "stream-active-history")
    samples = views.health(spark, sf_dir)
    weeks = samples.withColumn("week", F.date_trunc("week", F.col("tick"))).persist()
    # One file per week, oldest first: files are streamed in that order.
    for row in weeks.select("week").distinct().orderBy("week").collect():
        week = weeks.where(F.col("week") == F.lit(row.week)).select(*samples.columns)
        week.coalesce(1).write.mode("append").parquet(f"{folder}/health")
    weeks.unpersist()
    history = ActiveHistory(f"{folder}/active", views.lag_threshold(spark, sf_dir))
    active_history_stream(
        spark.readStream.schema(HEALTH_SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{folder}/health"),
        history, f"{folder}/checkpoint", trigger={"availableNow": True},
    ).awaitTermination()
    return history.read(spark).select(_ntz("tick"), "node_id", "previous_node")


def stream_progress(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the batches of a filtered stream add up to."""
    folder = run_folder(spark, "stream-progress")
    source, target = TableLog(f"{folder}/source"), TableTarget(f"{folder}/target")
    source.append(views.event_log(spark, sf_dir))
    query = relay_until_end(
        spark, source, views.copy_routes(spark), target, f"{folder}/checkpoint",
        filters=views.filters(), max_per_trigger=2,
    )
    query.awaitTermination()
    return progress_metrics(target.metrics(spark)).select("rows", "relayed", "filtered", "retries")


def stream_filter_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Denied records per filter, as the batches of a stream have kept them."""
    folder = run_folder(spark, "stream-filter-counts")
    source, target = TableLog(f"{folder}/source"), TableTarget(f"{folder}/target")
    source.append(views.event_log(spark, sf_dir))
    relay_until_end(
        spark, source, views.copy_routes(spark), target, f"{folder}/checkpoint",
        filters=views.filters(), max_per_trigger=2,
    ).awaitTermination()
    return denied_totals(target.metrics(spark))


def stream_multi_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many topics through one stream into one target, some pinned to a partition."""
    folder = run_folder(spark, "stream-multi-topic")
    source, target = TableLog(f"{folder}/source"), TableTarget(f"{folder}/target")
    source.append(views.typed_log(spark, sf_dir))
    relay_until_end(
        spark, source, views.typed_routes(spark), target, f"{folder}/checkpoint", max_per_trigger=8
    ).awaitTermination()
    return target.read(spark).select(
        "topic", "partition", "source_topic", "source_partition", "source_offset"
    )


def mirrors_then_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mirrors with holes streamed first; then what they lacked, from the whole log."""
    folder = run_folder(spark, "mirrors-then-copy")
    log = views.event_log(spark, sf_dir)
    # Each mirror lacks runs of its own, and some runs are in neither.
    run = F.floor(F.col("offset") / 7) % 5
    nodes = [TableLog(f"{folder}/node{i}") for i in range(2)]
    for node, lacks in zip(nodes, ((0, 1), (1, 2))):
        node.append(log.where(~run.isin(*lacks)))
    whole, target = TableLog(f"{folder}/whole"), TableTarget(f"{folder}/target")
    whole.append(log)
    routes = views.copy_routes(spark)
    merge_mirrors_stream(
        tag_mirrors([read_log_stream(spark, n, [views.TOPIC], max_per_trigger=2) for n in nodes]),
        routes, target, f"{folder}/checkpoint", trigger={"availableNow": True},
    ).awaitTermination()
    relay_bounded(spark, whole, routes, target)
    return target.read(spark).select(F.col("source_partition").alias("partition"), F.col("source_offset").alias("offset"))


def covered_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offsets of a log with gaps as intervals."""
    return offset_intervals(views.gappy_log(spark, sf_dir))


def row_target_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two rounds into a broker that knows nothing of sources: progress is read back from its tail."""
    folder = run_folder(spark, "row-target-resume")
    source, broker = TableLog(f"{folder}/source"), TableLog(f"{folder}/broker")
    target = RowTarget(FileBroker(broker.path), reader=broker)
    source.append(views.log_share(spark, sf_dir, views.TARGET_SHARE))
    relay_bounded(spark, source, views.copy_routes(spark), target)
    source.append(after_offsets(views.event_log(spark, sf_dir), end_offsets(spark, source, [views.TOPIC])))
    relay_bounded(spark, source, views.copy_routes(spark), target)
    return source_coordinates(broker.scan(spark, [views.COPY])).select(
        "partition", "offset", "source_partition", "source_offset"
    )


def committed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches whose tasks are lost half-way the first time, then written again."""
    folder = run_folder(spark, "committed-write")
    sink = FailsOnce(f"{folder}/sink")
    messages = to_message(views.event_log(spark, sf_dir), views.copy_routes(spark))
    # A partition goes to one task, in order, so a batch has a bounded part of each.
    target = CommittedTarget(sink, max_per_round=ROUND_OFFSETS)
    for batch_id, some in enumerate(staged_rounds(messages, f"{folder}/messages", target.max_per_round)):
        try:
            target.write_batch(some, batch_id)
        except PySparkException:
            # What a relay does when a batch fails: the same one again.
            target.write_batch(some, batch_id)
    return sink.read(spark).select("partition", "source_partition", "source_offset")


def ordered_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each partition, and how many stand before an earlier one in their file."""
    path = f"{run_folder(spark, 'ordered-write')}/files"
    messages = to_message(views.event_log(spark, sf_dir), views.copy_routes(spark))
    order_for_write(messages).write.parquet(path)
    rows = spark.read.parquet(path).select(
        "partition", "source_offset", "_metadata.file_path", "_metadata.row_index"
    )
    # A file holds what one task has written.
    along = Window.partitionBy("file_path", "partition").orderBy("row_index")
    earlier = F.lag("source_offset").over(along)
    return (
        rows.withColumn("late", (earlier > F.col("source_offset")).cast("int"))
        .groupBy("partition")
        .agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("late"), F.lit(0)).alias("out_of_order"))
    )


def write_codecs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log written with every codec and read back."""
    folder = run_folder(spark, "write-codecs")
    messages = to_message(views.event_log(spark, sf_dir), views.copy_routes(spark))
    read = []
    for codec in ("gzip", "snappy", "lz4", "zstd", "none"):
        target = TableTarget(f"{folder}/{codec}", compression=write_options(codec, table=True)["compression"])
        write_log(messages, target)
        read.append(target.read(spark).withColumn("codec", F.lit(codec)))
    return (
        reduce(lambda a, b: a.unionByName(b), read)
        .groupBy("codec", "partition")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("source_offset").alias("offsets"),
            F.sum(F.length("value")).alias("value_bytes"),
        )
    )


QUERIES: dict[str, Query] = {
    "relay_resume_filtered": relay_resume_filtered,
    "relay_multi_topic": relay_multi_topic,
    "relay_until_end": relay_until_end_bounds,
    "failover_round": failover_round,
    "message_headers": message_headers,
    "target_offsets": target_offsets,
    "high_watermarks": full_high_watermarks,
    "gappy_high_watermarks": gappy_high_watermarks,
    "remaining_offsets": remaining,
    "reached_end": reached,
    "gap_report": gaps,
    "filter_attribution": filter_attribution,
    "filtered_counts": denied_counts,
    "opaque_filter": opaque,
    "relayed_counts": copied_counts,
    "relayed_counts_auto": open_partition_counts,
    "read_mirrors": mirror_records,
    "merge_mirrors": merged_mirrors,
    "stored_mirrors": stored_mirrors,
    "validate_routes": route_problems,
    "reconcile": differences,
    "replication_lag": lag,
    "node_weights": weights,
    "elect_source": elected,
    "candidate_history": candidates,
    "active_history": active,
    "lag_breaches": breaches,
    "switch_counts": switches,
    "node_health_summary": health_summary,
    "write_read_back": write_read_back,
    "idempotent_batch": idempotent_batch,
    "stream_relay": stream_relay,
    "stream_merge_mirrors": stream_merge_mirrors,
    "stream_active_history": stream_active_history,
    "stream_progress": stream_progress,
    "stream_filter_counts": stream_filter_counts,
    "stream_multi_topic": stream_multi_topic,
    "mirrors_then_copy": mirrors_then_copy,
    "covered_offsets": covered_offsets,
    "row_target_resume": row_target_resume,
    "committed_write": committed_write,
    "ordered_write": ordered_write,
    "write_codecs": write_codecs,
}
