"""What must stay bounded while tables grow: rows in memory, files, rows at the driver."""

from glob import glob
from types import SimpleNamespace

import pyarrow.parquet as pq
import pytest
from helpers import EPOCH, SF_DIR
from pyspark.sql import functions as F

from logsync.operators import local_table
from logsync.operators.intervals import INTERVAL_SCHEMA, outside_intervals
from logsync.schemas import LOG_SCHEMA, MESSAGE_SCHEMA
from logsync.sinks import CommittedTarget, TableTarget, staged_rounds
from logsync.sources import TableLog
from workload import queries
from workload.sinks import FileBroker


@pytest.fixture
def spread_out(spark):
    """Each key in a task of its own."""
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_a_broker_holds_few_rows_at_a_time(tmp_path):
    alive = most = 0

    class Message(SimpleNamespace):
        def __init__(self, **fields):
            nonlocal alive, most
            super().__init__(**fields)
            alive += 1
            most = max(most, alive)

        def __del__(self):
            nonlocal alive
            alive -= 1

    def rows(partition, n):
        for i in range(n):
            headers = None if i % 3 else [SimpleNamespace(key="h", value=b"%d" % i)]
            yield Message(
                topic="t", partition=partition, source_timestamp=EPOCH, key=None, value=b"%d" % i, headers=headers
            )

    def both():
        yield from rows(0, 35_000)
        yield from rows(1, 5)

    FileBroker(str(tmp_path))(both())
    FileBroker(str(tmp_path))(rows(1, 2))
    # Those that are written, and the next.
    assert most <= 20_002
    names = sorted(p.removeprefix(f"{tmp_path}/topic=t/") for p in glob(f"{tmp_path}/topic=t/*/*.parquet"))
    assert names == [
        "partition=0/000000000000-000000034999.parquet",
        "partition=1/000000000000-000000000004.parquet",
        "partition=1/000000000005-000000000006.parquet",
    ]
    table = pq.ParquetFile(f"{tmp_path}/topic=t/{names[0]}").read()
    assert table["offset"].to_pylist() == list(range(35_000))
    assert table["value"].to_pylist() == [b"%d" % i for i in range(35_000)]
    assert table["headers"][3].as_py() == [{"key": "h", "value": b"3"}] and table["headers"][4].as_py() == []


def test_a_table_log_is_kept_in_few_files_of_several_row_groups(spark, tmp_path, spread_out):
    n = 300_000
    columns = {
        "topic": F.lit("t"), "partition": F.lit(0), "offset": F.col("id"),
        "timestamp": F.timestamp_millis("id"), "key": F.lit(None).cast("binary"),
        "value": F.sha2(F.col("id").cast("string"), 256).cast("binary"), "headers": F.array().cast(LOG_SCHEMA["headers"].dataType),
    }
    log = TableLog(str(tmp_path))
    log.append(spark.range(n).select(*(c.alias(name) for name, c in columns.items())))
    (file,) = glob(f"{tmp_path}/*/*/*.parquet")
    assert pq.ParquetFile(file).num_row_groups > 1
    assert log.scan(spark, ["t"]).agg(F.count("offset"), F.sum("offset")).first() == (n, n * (n - 1) // 2)


def test_a_record_is_compared_with_few_of_many_intervals(spark):
    n = 150_000
    log = spark.range(n).select(F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("id").alias("offset"))
    # Every third offset is left.
    low = F.col("id") * 3
    intervals = spark.range(n // 3).select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), low.alias("low"), (low + 2).alias("high")
    )
    left = outside_intervals(log, intervals)
    assert "div cast(1024 as bigint)" in left._jdf.queryExecution().analyzed().toString()
    assert left.agg(F.count("offset"), F.min(F.col("offset") % 3)).first() == (n // 3, 2)


def test_a_long_snapshot_is_not_taken_to_the_driver(spark, tmp_path):
    target = TableTarget(str(tmp_path))
    judged = local_table(spark, [("a", 0, 3 * i, 3 * i + 1) for i in range(3_000)], INTERVAL_SCHEMA)
    row = (None, b"v", None, "x", 0, "a", 0, 0, EPOCH)
    messages = spark.createDataFrame([row], MESSAGE_SCHEMA)
    target.write_batch(messages, 0, judged)
    assert not target.snapshot(spark).isLocal()
    target.write_batch(messages, 0, judged)
    target.write_batch(messages, 1, judged)
    assert target.covered(spark).count() == 3_000
    assert [r.offset for r in target.read(spark).orderBy("offset").collect()] == [0, 1]


def test_rounds_of_messages_hold_a_part_of_each_partition(spark, tmp_path):
    rows = [(None, b"%d" % i, None, "x", p, "a", p, i, EPOCH) for p in (0, 1) for i in range(25)]
    rows += [(None, None, None, "x", None, "a", None, None, None)] * 2 + rows[:1]
    messages = spark.createDataFrame(rows, MESSAGE_SCHEMA)
    parts = [part.collect() for part in staged_rounds(messages, f"{tmp_path}/m", 10)]
    assert [sorted({r.source_offset for r in part}, key=str) for part in parts[:1]] == [[None]]
    assert [(min(r.source_offset for r in p), max(r.source_offset for r in p)) for p in parts[1:]] == [
        (0, 9), (10, 19), (20, 24),
    ]
    assert [len(p) for p in parts] == [2, 21, 20, 10]
    assert sorted(map(str, (r for p in parts for r in p))) == sorted(map(str, messages.collect()))


def test_a_committed_write_hands_over_bounded_batches(spark, monkeypatch):
    seen = []

    class Watched(CommittedTarget):
        def write_batch(self, messages, batch_id):
            per = messages.groupBy("partition").count().agg(F.max("count").alias("n"))
            seen.append((batch_id, per.first().n))
            super().write_batch(messages, batch_id)

    monkeypatch.setattr(queries, "CommittedTarget", Watched)
    monkeypatch.setattr(queries, "ROUND_OFFSETS", 100)
    result = queries.committed_write(spark, SF_DIR)
    assert result.count() == result.distinct().count() == 1_000
    assert {b for b, _ in seen} == {0, 1, 2} and max(n for _, n in seen) == 100
