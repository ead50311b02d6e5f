"""Following the source in use while health samples arrive."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.health import active_history
from ..plans.failover import STATE_SCHEMA
from ..sinks.targets import read_or_empty

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("tick", T.TimestampType()),
        T.StructField("topic", T.StringType()),
        T.StructField("node_id", T.IntegerType()),
        T.StructField("previous_node", T.IntegerType()),
        T.StructField("candidate", T.IntegerType()),
        T.StructField("record", T.LongType()),
    ]
)
BATCH = T.StructField("batch", T.LongType())


@dataclass(frozen=True)
class ActiveHistory:
    """The history of the source in use, kept as a table below ``path``.

    Batches of health samples arrive in time order, every tick within one of
    them. Each batch continues from the state the batch before it left, one row
    per topic, and both its folders are replaced when it is run again.
    """

    path: str
    threshold: int
    initial_weight: int = 0

    def read(self, spark: SparkSession) -> DataFrame:
        schema = T.StructType([*HISTORY_SCHEMA.fields, BATCH])
        return read_or_empty(spark, f"{self.path}/history", schema).drop("batch")

    def _state_before(self, spark: SparkSession, batch_id: int) -> DataFrame:
        states = read_or_empty(
            spark, f"{self.path}/state", T.StructType([*STATE_SCHEMA.fields, BATCH])
        )
        columns = [name for name in STATE_SCHEMA.fieldNames() if name != "topic"]
        return (
            states.where(F.col("batch") < batch_id)
            .groupBy("topic")
            .agg(F.max_by(F.struct(*columns), "batch").alias("last"))
            .select("topic", "last.*")
        )

    def add(self, health: DataFrame, batch_id: int) -> None:
        spark = health.sparkSession
        before = self._state_before(spark, batch_id)
        folder = f"{self.path}/history/batch={batch_id}"
        settled = active_history(health, self.threshold, self.initial_weight, before)
        settled.write.mode("overwrite").parquet(folder)
        # Topics without a sample in this batch keep an older state row.
        (
            spark.read.schema(HISTORY_SCHEMA)
            .parquet(folder)
            .groupBy("topic")
            .agg(F.max_by(F.struct("candidate", "record", "node_id"), "tick").alias("last"))
            .select(
                "topic", "last.candidate", "last.record", F.col("last.node_id").alias("active")
            )
            .coalesce(1)
            .write.mode("overwrite")
            .parquet(f"{self.path}/state/batch={batch_id}")
        )


def active_history_stream(
    health: DataFrame,
    history: ActiveHistory,
    checkpoint: str,
    trigger: dict | None = None,
    name: str = "active-history",
) -> StreamingQuery:
    """Keep ``history`` up to date with a stream of health samples."""
    return (
        health.writeStream.foreachBatch(history.add)
        .option("checkpointLocation", checkpoint)
        .queryName(name)
        .trigger(**(trigger or {"processingTime": "3 seconds"}))
        .start()
    )
