"""Where messages go: a table, a Kafka cluster, or a sink of the user's own."""

from __future__ import annotations

import time
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import reduce
from typing import Any, Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.headers import append_headers, single_header
from ..operators.lookup import LITERAL_ROWS, bounded_rows, local_table, lookup_join
from ..operators.numbering import SLICE_WIDTH, assign_target_offsets
from ..schemas import (
    CATALOG_SCHEMA,
    MESSAGE_COLUMNS,
    MESSAGE_SCHEMA,
    METRICS_SCHEMA,
    OFFSETS_SCHEMA,
    SOURCE_COORDINATES,
    TARGET_LOG_COLUMNS,
    TARGET_LOG_SCHEMA,
)
from .order import order_for_write
from .snapshots import PAIR, SNAPSHOT_SCHEMA, WRITER, as_covered, changes, commit, covered_of, read_snapshot, tries

# Headers that carry source coordinates where a target has no
# columns for them.
SOURCE_TOPIC_HEADER = "_st"
SOURCE_PARTITION_HEADER = "_sp"
SOURCE_OFFSET_HEADER = "_so"

# Offsets of a source partition that a target which must take a partition from
# one task, in order, is handed at a time.
ORDERED_ROWS = 1_000_000
# Rows of a snapshot that are taken to the driver; each batch does so, and logs with
# many gaps have many more.
SNAPSHOT_ROWS = 2_000

_BATCH_SCHEMA = T.StructType(
    [
        T.StructField("writer", T.StringType()),
        T.StructField("low", T.LongType()),
        T.StructField("high", T.LongType()),
    ]
)
class Target(Protocol):
    """What a relay needs of a sink.

    ``write_batch`` may be called again with the same ``batch_id`` and the same
    messages. ``high_watermarks`` returns the next *source* offset per source
    topic-partition (topic, partition, next_offset); an empty table means the
    sink cannot tell, and copying starts at the beginning.
    """

    def write_batch(self, messages: DataFrame, batch_id: int) -> None: ...

    def high_watermarks(self, spark: SparkSession) -> DataFrame: ...


@dataclass(frozen=True)
class TableTarget:
    """A Parquet table log with snapshots of its progress beside it.

    A batch is written to a folder of its own and counts once a snapshot has its
    id, so a batch that failed half-way is invisible and is replaced by its
    retry, and a batch that arrives twice is written once. Snapshots also spare
    a scan of the log to find its end offsets, and tell which source offsets were
    dealt with. ``writer`` names the job, as batch ids are only unique within
    one. One job writes at a time.

    Numbering goes over a batch twice, which asks for filters that answer the
    same each time. ``stage`` writes the messages down first, for filters that
    are costly or may change their mind.
    """

    path: str
    writer: str = "main"
    compression: str = "zstd"
    slice_width: int = SLICE_WIDTH
    stage: bool = False

    def _label(self, batch_id: int, writer: str | None = None) -> str:
        return f"{writer or self.writer}-{batch_id:012d}"

    def snapshot(self, spark: SparkSession) -> DataFrame:
        """The newest snapshot, at the driver where it is small."""
        state = read_snapshot(spark, f"{self.path}/progress")
        rows = bounded_rows(state, SNAPSHOT_ROWS)
        return state if rows is None else local_table(spark, rows, SNAPSHOT_SCHEMA)

    def _batches(self, snapshot: DataFrame) -> DataFrame:
        """Batch ids committed by each writer, as intervals."""
        return snapshot.where(F.col("kind") == WRITER).select("writer", "low", "high")

    def write_batch(
        self,
        messages: DataFrame,
        batch_id: int,
        covered: DataFrame | None = None,
        counts: DataFrame | None = None,
    ) -> None:
        """Write a batch unless it is there.

        ``covered`` lists the source offsets that the batch has dealt with,
        denied ones included, as intervals (topic, partition, low, high). Without
        it a batch has dealt with all up to its highest offset. ``counts`` is one
        row of METRICS_SCHEMA but for the columns that are known here; it is
        written beside the batch and counts when the batch does.
        """
        spark, label, began = messages.sparkSession, self._label(batch_id), time.time()
        own = (F.col("writer") == self.writer) & (F.col("low") <= batch_id) & (F.col("high") > batch_id)
        state = self.snapshot(spark)
        if not self._batches(state).where(own).isEmpty():
            return
        # Tries that failed are known by their marks.
        tried = 0 if counts is None else tries(spark, f"{self.path}/tries/{label}")
        if self.stage:
            staged = f"{self.path}/staged/batch={label}"
            messages.select(*MESSAGE_COLUMNS).write.mode("overwrite").parquet(staged)
            messages = spark.read.schema(MESSAGE_SCHEMA).parquet(staged)
        numbered = assign_target_offsets(messages, _end_offsets(state), width=self.slice_width)
        folder = f"{self.path}/log/batch={label}"
        # Numbering has brought whole slices together, so sorting needs no
        # further shuffle for files to cover narrow offset ranges.
        (
            numbered.withColumn("timestamp", F.current_timestamp())
            .select(*TARGET_LOG_COLUMNS)
            .sortWithinPartitions("topic", "partition", "offset")
            .write.mode("overwrite")
            .option("compression", self.compression)
            .partitionBy("topic", "partition")
            .parquet(folder)
        )
        # Thin columns of what was just written, so both always agree.
        written = spark.read.schema(TARGET_LOG_SCHEMA).parquet(folder)
        pairs = written.groupBy("topic", "partition", "source_topic", "source_partition").agg(
            (F.max("offset") + 1).alias("next_offset"),
            (F.max("source_offset") + 1).alias("source_next_offset"),
            F.count(F.lit(1)).alias("rows"),
        )
        if covered is None:
            covered = pairs.where("source_topic IS NOT NULL AND source_partition IS NOT NULL").select(
                F.col("source_topic").alias("topic"),
                F.col("source_partition").alias("partition"),
                F.lit(0).cast("long").alias("low"),
                F.col("source_next_offset").alias("high"),
            )
        if counts is not None:
            self._write_metrics(counts, batch_id, began, tried - 1)
        done = local_table(spark, [(self.writer, batch_id, batch_id + 1)], _BATCH_SCHEMA)
        changed = changes(pairs, PAIR).unionByName(as_covered(covered)).unionByName(changes(done, WRITER))
        commit(spark, f"{self.path}/progress", state, changed)

    def _write_metrics(self, counts: DataFrame, batch_id: int, began: float, retries: int) -> None:
        label = self._label(batch_id)
        known = {
            "batch_id": F.lit(batch_id).cast("long"),
            "started": F.timestamp_millis(F.lit(int(began * 1000))),
            "duration_ms": F.lit(int((time.time() - began) * 1000)).cast("long"),
            "retries": F.lit(retries).cast("int"),
        }
        row = counts.withColumns(known).select(*METRICS_SCHEMA.fieldNames())
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/metrics/batch={label}")

    def metrics(self, spark: SparkSession) -> DataFrame:
        """What each batch that counted reported, one row of METRICS_SCHEMA for each."""
        schema = T.StructType([*METRICS_SCHEMA.fields, T.StructField("batch", T.StringType())])
        table = read_or_empty(spark, f"{self.path}/metrics", schema)
        return self._counted(table).select(*METRICS_SCHEMA.fieldNames())

    def read(self, spark: SparkSession) -> DataFrame:
        """Records of all batches that counted."""
        schema = T.StructType([*TARGET_LOG_SCHEMA.fields, T.StructField("batch", T.StringType())])
        return self._counted(read_or_empty(spark, f"{self.path}/log", schema)).select(*TARGET_LOG_COLUMNS)

    def _counted(self, table: DataFrame) -> DataFrame:
        """Rows of a table laid out by batch whose batch is committed."""
        batches = self._batches(self.snapshot(table.sparkSession))
        rows = bounded_rows(batches, LITERAL_ROWS)
        if rows is not None:
            # Labels of a writer sort as its batch ids do.
            counted = [
                F.col("batch").between(self._label(r.low, r.writer), self._label(r.high - 1, r.writer)) for r in rows
            ]
            return table.where(reduce(lambda a, b: a | b, counted, F.lit(False)))
        number = F.regexp_extract("batch", "([0-9]+)$", 1).cast("long")
        of_writers = lookup_join(
            table.withColumn("writer", F.regexp_replace("batch", "-[0-9]+$", "")), batches, ["writer"], spread="batch"
        )
        return of_writers.where((number >= F.col("low")) & (number < F.col("high")))

    def declare(self, partitions: DataFrame) -> None:
        """Name the partitions (topic, partition) that there are; copies to others are then refused."""
        rows = partitions.select("topic", "partition").distinct().orderBy("topic", "partition")
        rows.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/catalog")

    def catalog(self, spark: SparkSession) -> DataFrame | None:
        """The declared partitions; nothing where any may be written."""
        declared = read_or_empty(spark, f"{self.path}/catalog", CATALOG_SCHEMA)
        return None if declared.isEmpty() else declared

    def end_offsets(self, spark: SparkSession) -> DataFrame:
        """The table's own end offsets."""
        return _end_offsets(self.snapshot(spark))

    def covered(self, spark: SparkSession) -> DataFrame:
        """Source offsets that were dealt with, as intervals of each partition."""
        return covered_of(self.snapshot(spark))

    def high_watermarks(self, spark: SparkSession) -> DataFrame:
        """For each source partition the first offset that was not dealt with."""
        return (
            self.covered(spark)
            .groupBy("topic", "partition")
            .agg(F.coalesce(F.max(F.when(F.col("low") <= 0, F.col("high"))), F.lit(0)).alias("next_offset"))
        )

    def next_batch_id(self, spark: SparkSession) -> int:
        """First batch id this writer has not completed."""
        own = self._batches(self.snapshot(spark)).where(F.col("writer") == self.writer)
        return own.agg(F.coalesce(F.max("high"), F.lit(0)).alias("id")).first().id


def _end_offsets(snapshot: DataFrame) -> DataFrame:
    ends = F.max("next_offset").alias("next_offset")
    return snapshot.where(F.col("kind") == PAIR).groupBy("topic", "partition").agg(ends)


@dataclass(frozen=True)
class KafkaTarget:
    """Topics of a cluster; needs Spark's Kafka connector at run time.

    Delivery is at least once. Source coordinates travel as headers behind the
    message's own, so that progress can be read back through ``reader``, a log
    source over the same cluster. ``margin`` as in ``tail_progress``.
    """

    servers: str
    options: Mapping[str, str] = field(default_factory=dict)
    carry_source: bool = True
    max_per_round: int = ORDERED_ROWS
    reader: Any = None
    margin: int = 0

    def rows(self, messages: DataFrame) -> DataFrame:
        if self.carry_source:
            messages = with_source_headers(messages)
        return order_for_write(messages, single_writer=True).select(
            "topic", "partition", "key", "value", "headers"
        )

    def writer_options(self) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, "includeHeaders": "true", **self.options}

    def write_batch(self, messages: DataFrame, batch_id: int) -> None:
        self.rows(messages).write.format("kafka").options(**self.writer_options()).save()

    def high_watermarks(self, spark: SparkSession) -> DataFrame:
        """Empty: a stream's checkpoint, or ``tail_progress`` by the reader, tells."""
        return local_table(spark, [], OFFSETS_SCHEMA)


def with_source_headers(messages: DataFrame) -> DataFrame:
    """Source coordinates as headers behind the message's own."""
    coordinates = append_headers(
        "headers",
        single_header(SOURCE_TOPIC_HEADER, F.col("source_topic")),
        single_header(SOURCE_PARTITION_HEADER, F.col("source_partition").cast("string")),
        single_header(SOURCE_OFFSET_HEADER, F.col("source_offset").cast("string")),
    )
    return messages.withColumn("headers", coordinates)


def source_coordinates(target_log: DataFrame) -> DataFrame:
    """Restore source columns of a Kafka target's log from its headers.

    The last header of each name counts, as a relay appends its own; records
    without them, which others wrote, get NULL.
    """

    def last(name: str) -> Column:
        named = F.filter("headers", lambda header: header["key"] == name)
        return F.try_element_at(named, F.lit(-1))["value"].cast("string")

    return target_log.withColumns(
        {
            "source_topic": last(SOURCE_TOPIC_HEADER),
            "source_partition": last(SOURCE_PARTITION_HEADER).try_cast("int"),
            "source_offset": last(SOURCE_OFFSET_HEADER).try_cast("bigint"),
        }
    )


def missing_from(messages: DataFrame, target_log: DataFrame) -> DataFrame:
    """Messages whose source coordinates the target does not hold yet.

    The target is read within the messages' own offset ranges only, and just its
    coordinates. Unlike a comparison with the highest offset copied, this sees
    holes.
    """
    pair = ["source_topic", "source_partition"]
    ranges = messages.groupBy(*pair).agg(
        F.min("source_offset").alias("_low"), F.max("source_offset").alias("_high")
    )
    known = target_log.select(*SOURCE_COORDINATES)
    rows = bounded_rows(ranges, LITERAL_ROWS)
    if rows is not None:
        within = [
            (F.col("source_topic") == row.source_topic)
            & (F.col("source_partition") == row.source_partition)
            & F.col("source_offset").between(row._low, row._high)
            for row in rows
        ]
        known = known.where(reduce(lambda a, b: a | b, within, F.lit(False)))
    else:
        known = (
            lookup_join(known, ranges, pair, spread="source_offset")
            .where(F.col("source_offset").between(F.col("_low"), F.col("_high")))
            .select(*SOURCE_COORDINATES)
        )
    return messages.join(known, SOURCE_COORDINATES, "left_anti").select(*messages.columns)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The Parquet table at ``path``, without rows while nothing is there."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as problem:
        if problem.getCondition() != "PATH_NOT_FOUND":
            raise
        return local_table(spark, [], schema)
