"""Progress of a table target as snapshots: each commit writes the whole of it anew.

A snapshot is a small table: a row for each pair of target and source partition,
the batch ids that each writer has committed, and the source offsets that the
target has dealt with, both as intervals, which grow together. The newest is
found by its name, so a commit costs the same however many there were; the last
few are kept for readers under way. A snapshot is one file, and counts once that
file is there.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.intervals import INTERVAL_SCHEMA, merged_intervals
from ..operators.lookup import local_table

KEPT = 16
PAIR, WRITER, COVERED = "pair", "writer", "covered"

# ``low`` to ``high``, not included: batch ids of a writer, or source offsets.
SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("next_offset", T.LongType()),
        T.StructField("source_topic", T.StringType()),
        T.StructField("source_partition", T.IntegerType()),
        T.StructField("source_next_offset", T.LongType()),
        T.StructField("rows", T.LongType()),
        T.StructField("writer", T.StringType()),
        T.StructField("low", T.LongType()),
        T.StructField("high", T.LongType()),
    ]
)
_NAME = "snapshot-"


def _listed(spark: SparkSession, folder: str):
    """The file system, and the snapshots that are whole, newest first."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return files, []
    found = [status.getPath() for status in files.listStatus(path)]
    return files, sorted((p for p in found if p.getName().startswith(_NAME)), key=lambda p: p.getName(), reverse=True)


def tries(spark: SparkSession, folder: str) -> int:
    """Leaves a mark in ``folder`` and returns how many there are."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{uuid.uuid4().hex}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    return len(files.listStatus(path.getParent()))


def _whole(files, path) -> bool:
    return any(s.getPath().getName().startswith("part-") for s in files.listStatus(path))


def newest(spark: SparkSession, folder: str) -> tuple[int, str | None]:
    """Number and place of the newest whole snapshot; -1 and nothing before the first."""
    files, paths = _listed(spark, folder)
    for path in paths:
        if _whole(files, path):
            return int(path.getName().removeprefix(_NAME)), path.toString()
    return -1, None


def read_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    _, path = newest(spark, folder)
    if path is None:
        return local_table(spark, [], SNAPSHOT_SCHEMA)
    return spark.read.schema(SNAPSHOT_SCHEMA).parquet(path)


def changes(rows: DataFrame, kind: str) -> DataFrame:
    """``rows`` in the form of a snapshot; columns they lack are NULL."""
    return rows.withColumn("kind", F.lit(kind)).select(
        *(
            (F.col(f.name) if f.name in (*rows.columns, "kind") else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in SNAPSHOT_SCHEMA
        )
    )


def commit(spark: SparkSession, folder: str, state: DataFrame, changed: DataFrame) -> None:
    """The newest snapshot, as it was read, and what has changed since, as the next one."""
    number, _ = newest(spark, folder)
    rows = state.unionByName(changed)
    pairs = (
        rows.where(F.col("kind") == PAIR)
        .groupBy("topic", "partition", "source_topic", "source_partition")
        .agg(
            F.max("next_offset").alias("next_offset"),
            F.max("source_next_offset").alias("source_next_offset"),
            F.sum("rows").alias("rows"),
        )
    )
    keys = ["kind", "writer", "source_topic", "source_partition"]
    sets = merged_intervals(rows.where(F.col("kind") != PAIR), keys)
    merged = changes(pairs, PAIR).unionByName(
        sets.select(
            *(
                (F.col(f.name) if f.name in sets.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in SNAPSHOT_SCHEMA
            )
        )
    )
    # A row for each pair and each gap: one file, which is there or is not.
    merged.coalesce(1).write.mode("overwrite").parquet(f"{folder}/{_NAME}{number + 1:012d}")
    files, paths = _listed(spark, folder)
    for old in paths[KEPT:]:
        files.delete(old, True)


def covered_of(snapshot: DataFrame) -> DataFrame:
    """Source offsets dealt with, as intervals of each partition."""
    return snapshot.where(F.col("kind") == COVERED).select(
        F.col("source_topic").alias("topic"), F.col("source_partition").alias("partition"), "low", "high"
    )


def as_covered(intervals: DataFrame) -> DataFrame:
    rows = intervals.select(*INTERVAL_SCHEMA.fieldNames()).where(F.col("low") < F.col("high"))
    return changes(rows.withColumnsRenamed({"topic": "source_topic", "partition": "source_partition"}), COVERED)
