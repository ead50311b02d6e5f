"""Progress of a target that has no columns for it: read back from its last messages.

A relay leaves the source coordinates of a message in its headers. The newest
message of a source partition is near the end of the target partition it goes to,
so the ends are read first, and further back only for source partitions not met.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.lookup import local_table
from ..schemas import OFFSETS_SCHEMA
from ..sinks.targets import Target, source_coordinates
from ..sources.read import LogSource, end_offsets, read_log

FIRST_WIDTH = 1_000
GROWTH = 8


def tail_progress(
    spark: SparkSession,
    log: LogSource,
    topics: Sequence[str],
    expected: DataFrame,
    first_width: int = FIRST_WIDTH,
    growth: int = GROWTH,
    margin: int = 0,
) -> DataFrame:
    """Next source offset of each source partition found in the target's ``topics``.

    ``expected`` (topic, partition) lists the source partitions to be met. Each
    step reads the stretch before the last one, ``growth`` times as wide, until
    all are met or the beginning is reached; so what is read is a fixed multiple
    of what had to be. Source partitions that are not there are left out.

    Messages of one source partition must stand in order in one target
    partition. Where they go to several, the last round may have reached some of
    them only: ``margin`` offsets, those of a round, are then handed out again.
    """
    wanted = {(r.topic, r.partition) for r in expected.select("topic", "partition").distinct().collect()}
    try:
        # A row for each partition of the target.
        upper = {(r.topic, r.partition): r.next_offset for r in end_offsets(spark, log, topics).collect()}
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        upper = {}  # nothing was written yet
    found: dict[tuple[str, int], int] = {}
    width = first_width
    while wanted - set(found) and any(upper.values()):
        open_ends = {pair: end for pair, end in upper.items() if end > 0}
        lower = {pair: max(0, end - width) for pair, end in open_ends.items()}
        stretch = read_log(
            spark, log, sorted({t for t, _ in open_ends}), _offsets(spark, lower), _offsets(spark, open_ends), "skip"
        )
        coordinates = source_coordinates(stretch).where(
            "source_topic IS NOT NULL AND source_partition IS NOT NULL AND source_offset IS NOT NULL"
        )
        newest = coordinates.groupBy("source_topic", "source_partition").agg(F.max("source_offset").alias("last"))
        # A row for each source partition; those met before have later messages.
        for row in newest.collect():
            found.setdefault((row.source_topic, row.source_partition), row["last"] + 1)
        upper, width = lower, width * growth
    rows = [(*pair, max(0, offset - margin)) for pair, offset in found.items()]
    return local_table(spark, rows, OFFSETS_SCHEMA)


def progress_of(spark: SparkSession, target: Target, routes: DataFrame, expected: DataFrame) -> DataFrame:
    """Where a target stands: by its own account, or read back from its last messages."""
    reader = getattr(target, "reader", None)
    if reader is None:
        return target.high_watermarks(spark)
    # As many as there are routes, which are counted before they are used.
    topics = sorted(r.target_topic for r in routes.select("target_topic").distinct().collect())
    return tail_progress(spark, reader, topics, expected, margin=target.margin)


def _offsets(spark: SparkSession, offsets: dict[tuple[str, int], int]) -> DataFrame:
    return local_table(spark, [(*pair, offset) for pair, offset in offsets.items()], OFFSETS_SCHEMA)
