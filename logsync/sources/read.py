"""Reading logs, whatever they are kept in."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.mirrors import tag_mirrors
from ..operators.offsets import high_watermarks
from ..session import run_folder
from .kafka import KafkaLog
from .table import TableLog

LogSource = TableLog | KafkaLog


def read_log(
    spark: SparkSession,
    source: LogSource,
    topics: Sequence[str],
    start: DataFrame | None = None,
    end: DataFrame | None = None,
    missing: str = "start",
) -> DataFrame:
    """Records of ``topics`` with start <= offset < end, per partition."""
    return source.scan(spark, topics, start, end, missing)


def read_log_stream(
    spark: SparkSession,
    source: LogSource,
    topics: Sequence[str],
    start: DataFrame | None = None,
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Unbounded scan; the query's checkpoint holds its progress."""
    return source.stream(spark, topics, start, max_per_trigger)


def read_mirrors(
    spark: SparkSession, sources: Sequence[LogSource], topics: Sequence[str]
) -> DataFrame:
    """The same topics from identical nodes, ``node_id`` by place in the list."""
    return tag_mirrors([read_log(spark, source, topics) for source in sources])


def end_offsets(
    spark: SparkSession, source: LogSource | DataFrame, topics: Sequence[str] | None = None
) -> DataFrame:
    """Current end offset of every topic-partition, as an offsets table."""
    if isinstance(source, KafkaLog):
        if topics is None:
            raise ValueError("name the topics to ask a cluster about")
        return source.end_offsets(spark, topics, run_folder(spark, "end-offsets"))
    if isinstance(source, TableLog):
        if topics is None:
            raise ValueError("name the topics to look up")
        return source.end_offsets(spark, topics)
    log = source if topics is None else source.where(F.col("topic").isin(list(topics)))
    return high_watermarks(log)
