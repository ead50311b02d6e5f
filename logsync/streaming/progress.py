"""What a running copy did, as rows of a table."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping, Sequence
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.lookup import local_table
from ..schemas import PROGRESS_SCHEMA

OBSERVATION = "relay"


def observe_relay(judged: DataFrame, filters: Sequence[str]) -> DataFrame:
    """Count passed and denied records on the way, the latter per filter."""
    denied = [
        F.count_if(F.col("denied_by") == name).alias(f"denied_by_{name}") for name in filters
    ]
    return judged.observe(
        OBSERVATION,
        F.count_if(F.col("denied_by").isNull()).alias("relayed"),
        F.count_if(F.col("denied_by").isNotNull()).alias("filtered"),
        *denied,
    )


def progress_row(report: Mapping[str, Any]) -> tuple:
    """A streaming progress report as a row of PROGRESS_SCHEMA."""
    counts = report.get("observedMetrics", {}).get(OBSERVATION) or {}
    if hasattr(counts, "asDict"):
        counts = counts.asDict()
    return (
        int(report["batchId"]),
        datetime.fromisoformat(report["timestamp"].replace("Z", "+00:00")),
        int(report["durationMs"].get("triggerExecution", 0)),
        int(report.get("numInputRows", 0)),
        int(counts.get("relayed") or 0),
        int(counts.get("filtered") or 0),
        0,
    )


def progress_rows(query: StreamingQuery) -> DataFrame:
    """The reports a query still keeps, one row per batch."""
    reports: Iterable[Mapping[str, Any]] = [json.loads(p.json) for p in query.recentProgress]
    spark = SparkSession.active()
    return local_table(spark, [progress_row(r) for r in reports], PROGRESS_SCHEMA)


def batch_metrics(judged: DataFrame) -> DataFrame:
    """What a batch of records with ``denied_by`` adds up to: one row.

    Sketches of the sizes of values and of the time that copied records waited
    can be merged over batches; each takes a few kilobytes.
    """
    denied = F.col("denied_by").isNotNull()
    waited = F.unix_millis(F.current_timestamp()) - F.unix_millis("timestamp")
    counts = judged.groupBy("denied_by").agg(
        F.count(F.lit(1)).alias("n"),
        F.kll_sketch_agg_bigint(F.coalesce(F.length("value"), F.lit(0)).cast("bigint")).alias("sizes"),
        F.kll_sketch_agg_bigint(F.coalesce(waited, F.lit(0))).alias("lags"),
    )
    # A row for each filter at most.
    listed = F.collect_list(F.when(denied, F.struct("denied_by", "n")))
    return counts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(~denied, F.col("n"))), F.lit(0)).alias("relayed"),
        F.coalesce(F.sum(F.when(denied, F.col("n"))), F.lit(0)).alias("filtered"),
        F.map_from_entries(listed).alias("denied"),
        F.kll_merge_agg_bigint(F.when(~denied, F.col("sizes"))).alias("size_sketch"),
        F.kll_merge_agg_bigint(F.when(~denied, F.col("lags"))).alias("lag_ms_sketch"),
    )


def denied_totals(metrics: DataFrame) -> DataFrame:
    """Denied records per filter over all batches."""
    return (
        metrics.select(F.explode("denied").alias("filter", "n"))
        .groupBy("filter")
        .agg(F.sum("n").alias("n"))
    )


def metrics_over_time(metrics: DataFrame, window: str) -> DataFrame:
    """Counts and quantiles of value sizes, lag and durations for each stretch of time.

    Sketches of the batches are merged; quantiles are near, not exact, once a
    stretch holds more than some hundred records.
    """
    grouped = metrics.groupBy(F.window("started", window).alias("window")).agg(
        F.count(F.lit(1)).alias("batches"),
        *(F.sum(c).alias(c) for c in ("rows", "relayed", "filtered", "retries")),
        F.kll_sketch_agg_bigint("duration_ms").alias("duration_ms"),
        F.kll_merge_agg_bigint("size_sketch").alias("size"),
        F.kll_merge_agg_bigint("lag_ms_sketch").alias("lag_ms"),
    )
    quantiles = [
        F.when(
            F.kll_sketch_get_n_bigint(sketch) > 0, F.kll_sketch_get_quantile_bigint(sketch, F.lit(share / 100))
        ).alias(f"p{share}_{sketch}")
        for sketch in ("duration_ms", "size", "lag_ms")
        for share in (50, 95)
    ]
    return grouped.select("window.start", "batches", "rows", "relayed", "filtered", "retries", *quantiles)


class ProgressListener(StreamingQueryListener):
    """Appends a row to the table at ``path`` after every batch of a query."""

    def __init__(self, spark: SparkSession, path: str, name: str | None = None) -> None:
        self.spark, self.path, self.name = spark, path, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        report = json.loads(event.progress.json)
        if self.name is not None and report.get("name") != self.name:
            return
        row = local_table(self.spark, [progress_row(report)], PROGRESS_SCHEMA)
        row.coalesce(1).write.mode("append").parquet(self.path)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def progress_metrics(progress: DataFrame) -> DataFrame:
    """One row over all batches: totals, distributions, repeated batches.

    A batch id reported again was retried; its last report counts.
    """
    batches = progress.groupBy("batch_id").agg(
        F.max_by(F.struct("duration_ms", "rows", "relayed", "filtered"), "started").alias("last"),
        (F.count(F.lit(1)) - 1 + F.sum("retries")).alias("retries"),
    )
    return batches.select("last.*", "retries").agg(
        F.count(F.lit(1)).alias("batches"),
        F.sum("rows").alias("rows"),
        F.sum("relayed").alias("relayed"),
        F.sum("filtered").alias("filtered"),
        F.sum("retries").alias("retries"),
        F.percentile_approx("rows", 0.5).alias("p50_rows"),
        F.percentile_approx("rows", 0.95).alias("p95_rows"),
        F.max("rows").alias("max_rows"),
        F.percentile_approx("duration_ms", 0.5).alias("p50_ms"),
        F.percentile_approx("duration_ms", 0.95).alias("p95_ms"),
        F.max("duration_ms").alias("max_ms"),
    )
