"""Kafka topics through Spark's own connector, which must be on the class path.

Everything here builds reader options; the connector does the reading.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Row, SparkSession

from ..operators.lookup import BROADCAST_ROWS, bounded_rows, local_table
from ..schemas import LOG_COLUMNS, OFFSETS_SCHEMA

# Fixed value: the connector's mark for "from the earliest offset".
EARLIEST = -2
# Bounds a micro-batch, also the first one over a long topic.
RECORDS_PER_TRIGGER = 10_000_000


def offsets_json(
    offsets: Iterable[Row], partitions: Mapping[str, Iterable[int]] | None = None
) -> str:
    """Offsets as the connector's JSON; ``partitions`` not among them: earliest."""
    by_topic: dict[str, dict[str, int]] = defaultdict(dict)
    for topic, numbers in (partitions or {}).items():
        for number in numbers:
            by_topic[topic][str(number)] = EARLIEST
    for row in offsets:
        by_topic[row.topic][str(row.partition)] = int(row.next_offset)
    return json.dumps(by_topic, sort_keys=True)


def offsets_from_json(spark: SparkSession, text: str) -> DataFrame:
    """An offsets table from that JSON, e.g. of a streaming progress report."""
    rows = [
        (topic, int(partition), int(offset))
        for topic, partitions in json.loads(text).items()
        for partition, offset in partitions.items()
    ]
    return local_table(spark, rows, OFFSETS_SCHEMA)


@dataclass(frozen=True)
class KafkaLog:
    """Topics of one cluster.

    ``options`` pass through, security (``kafka.security.protocol``,
    ``kafka.sasl.mechanism``, ``kafka.ssl.*`` …) included. ``partitions`` lists
    the known partitions per topic; explicit start offsets must cover them all.
    ``min_partitions`` lets Spark split large topic-partitions over tasks.
    """

    servers: str
    options: Mapping[str, str] = field(default_factory=dict)
    partitions: Mapping[str, Sequence[int]] | None = None
    min_partitions: int | None = None

    def reader_options(
        self,
        topics: Sequence[str],
        start: Sequence[Row] | None = None,
        end: Sequence[Row] | None = None,
        missing: str = "start",
        max_per_trigger: int | None = None,
    ) -> dict[str, str]:
        options = {"kafka.bootstrap.servers": self.servers, "includeHeaders": "true"}
        if start is not None and missing == "skip":
            assigned: dict[str, list[int]] = defaultdict(list)
            for row in start:
                assigned[row.topic].append(row.partition)
            options["assign"] = json.dumps({t: sorted(p) for t, p in sorted(assigned.items())})
        else:
            options["subscribe"] = ",".join(topics)
        if start is None:
            options["startingOffsets"] = "earliest"
        else:
            known = self.partitions if missing == "start" else None
            options["startingOffsets"] = offsets_json(start, known)
        if end is not None:
            options["endingOffsets"] = offsets_json(end)
        if self.min_partitions is not None:
            options["minPartitions"] = str(self.min_partitions)
        if max_per_trigger is not None:
            options["maxOffsetsPerTrigger"] = str(max_per_trigger)
        return {**options, **self.options}

    def scan(
        self,
        spark: SparkSession,
        topics: Sequence[str],
        start: DataFrame | None = None,
        end: DataFrame | None = None,
        missing: str = "start",
    ) -> DataFrame:
        options = self.reader_options(topics, _rows(start), _rows(end), missing)
        return spark.read.format("kafka").options(**options).load().select(*LOG_COLUMNS)

    def stream(
        self,
        spark: SparkSession,
        topics: Sequence[str],
        start: DataFrame | None = None,
        max_per_trigger: int | None = None,
    ) -> DataFrame:
        """Unbounded scan; ``max_per_trigger`` counts records."""
        records = RECORDS_PER_TRIGGER if max_per_trigger is None else max_per_trigger
        options = self.reader_options(topics, _rows(start), max_per_trigger=records)
        return spark.readStream.format("kafka").options(**options).load().select(*LOG_COLUMNS)

    def end_offsets(self, spark: SparkSession, topics: Sequence[str], scratch: str) -> DataFrame:
        """End offsets as the connector reports them; no record is read."""
        options = {**self.reader_options(topics), "startingOffsets": "latest"}
        query = (
            spark.readStream.format("kafka")
            .options(**options)
            .load()
            .writeStream.format("noop")
            .option("checkpointLocation", scratch)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
        reported = query.lastProgress["sources"][0]["endOffset"]
        text = reported if isinstance(reported, str) else json.dumps(reported)
        return offsets_from_json(spark, text)


def _rows(offsets: DataFrame | None) -> list[Row] | None:
    if offsets is None:
        return None
    rows = bounded_rows(offsets, BROADCAST_ROWS)
    if rows is None:
        raise ValueError("more offsets than a cluster has partitions")
    return rows
