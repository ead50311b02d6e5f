from pathlib import Path

import pytest
from helpers import pairs
from pyspark.sql import functions as F

from logsync.operators import high_watermarks, to_message
from logsync.sinks import (
    KafkaTarget,
    RowTarget,
    TableTarget,
    ack_policy,
    compression_codec,
    missing_from,
    order_for_write,
    write_batch_idempotent,
    write_log,
    write_options,
)
from logsync.sinks.targets import source_coordinates
from logsync.sources import TableLog, end_offsets, read_log, read_mirrors


@pytest.fixture
def messages(make_log, make_routes):
    def make(*offsets, partition=0):
        log = make_log(*[("a", partition, o, b"k", f"v{o}".encode()) for o in offsets])
        return to_message(log, make_routes(("a", "x", None)))

    return make


def test_table_log_round_trip_with_bounds(spark, make_log, make_offsets, tmp_path):
    source = TableLog(f"{tmp_path}/log")
    source.append(make_log(*[("a", p, o, b"k", b"v", [("h", b"1")]) for p in (0, 1) for o in range(5)]))
    source.append(make_log(("b", 0, 0, b"k", None, None)))
    assert read_log(spark, source, ["a"]).count() == 10
    row = read_log(spark, source, ["b"]).first()
    assert row.value is None and row.headers is None
    part = read_log(spark, source, ["a"], make_offsets(("a", 0, 3)), make_offsets(("a", 0, 4), ("a", 1, 1)))
    assert pairs(part, "partition", "offset") == [(0, 3), (1, 0)]
    ends = end_offsets(spark, source, ["a", "b"])
    assert pairs(ends, "topic", "partition", "next_offset") == [("a", 0, 5), ("a", 1, 5), ("b", 0, 1)]


def test_mirrors_are_read_in_list_order(spark, make_log, tmp_path):
    sources = [TableLog(f"{tmp_path}/{i}") for i in range(2)]
    for i, source in enumerate(sources):
        source.append(make_log(*[("a", 0, o, b"k", b"v") for o in range(i + 1)]))
    assert pairs(read_mirrors(spark, sources, ["a"]), "node_id", "offset") == [(0, 0), (1, 0), (1, 1)]


def test_bounds_reach_the_files(spark, make_log, make_offsets, tmp_path):
    source = TableLog(f"{tmp_path}/log")
    source.append(make_log(*[("a", p, o, b"k", b"v") for p in (0, 1) for o in range(5)]))
    scan = read_log(spark, source, ["a"], make_offsets(("a", 0, 3)), make_offsets(("a", 0, 9)))
    plan = scan.select("offset")._jdf.queryExecution().executedPlan().toString()
    assert "LessThan(offset,9)" in plan and "GreaterThanOrEqual(offset,3)" in plan
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert "value" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_write_and_read_back(spark, messages, tmp_path):
    target = TableTarget(f"{tmp_path}/t")
    assert target.read(spark).count() == 0
    assert target.next_batch_id(spark) == 0
    assert write_log(messages(3, 4, 9), target) == 0
    assert write_log(messages(11), target) == 1
    read = target.read(spark)
    assert pairs(read, "offset", "source_offset") == [(0, 3), (1, 4), (2, 9), (3, 11)]
    assert pairs(target.end_offsets(spark), "topic", "partition", "next_offset") == [("x", 0, 4)]
    assert pairs(target.high_watermarks(spark), "topic", "partition", "next_offset") == [("a", 0, 12)]
    assert high_watermarks(read).first().next_offset == 4


def test_a_batch_written_twice_counts_once(spark, messages, tmp_path):
    for _ in range(2):
        write_batch_idempotent(messages(1, 2), 0, f"{tmp_path}/t")
    assert pairs(TableTarget(f"{tmp_path}/t").read(spark), "source_offset") == [(1,), (2,)]


def test_a_batch_that_failed_half_way_is_replaced(spark, messages, tmp_path):
    target = TableTarget(f"{tmp_path}/t")
    target.write_batch(messages(0, 1), 0)
    # Rows of batch 1 are on disk, its progress is not.
    orphan = messages(2, 99, partition=7).withColumn("offset", F.lit(0).cast("long"))
    orphan.withColumn("timestamp", F.current_timestamp()).drop("source_timestamp").write.partitionBy(
        "topic", "partition"
    ).parquet(f"{tmp_path}/t/log/batch=main-{1:012d}")
    assert pairs(target.read(spark), "source_offset") == [(0,), (1,)]
    assert target.next_batch_id(spark) == 1
    target.write_batch(messages(2, 3), 1)
    assert pairs(target.read(spark), "offset", "source_offset") == [(0, 0), (1, 1), (2, 2), (3, 3)]


def test_staged_batches(spark, messages, tmp_path):
    target = TableTarget(f"{tmp_path}/t", stage=True)
    # A filter that answers at random would upset numbering otherwise.
    write_log(messages(*range(200)).where(F.rand() < 0.5), target)
    offsets = [offset for (offset,) in pairs(target.read(spark), "offset")]
    assert 0 < len(offsets) < 200 and offsets == list(range(len(offsets)))


def test_end_offsets_come_from_footers(spark, make_log, tmp_path):
    source = TableLog(f"{tmp_path}/log")
    source.append(make_log(*[("a", p, o, b"k", b"v") for p in (0, 1) for o in range(5 + p)]))
    source.append(make_log(("a", 0, 9, b"k", b"v"), ("b", 0, 0, b"k", b"v")))
    ends = source.end_offsets(spark, ["a"])
    assert pairs(ends, "partition", "next_offset") == [(0, 10), (1, 6)]


def test_end_offsets_of_files_without_statistics(spark, make_log, tmp_path):
    source = TableLog(f"{tmp_path}/log")
    log = make_log(*[("a", 0, o, b"k", b"v") for o in range(5)])
    (
        log.write.option("parquet.column.statistics.enabled", "false")
        .partitionBy("topic", "partition")
        .parquet(source.path)
    )
    assert pairs(end_offsets(spark, source, ["a"]), "partition", "next_offset") == [(0, 5)]


def test_files_cover_narrow_ranges(spark, messages, tmp_path):
    target = TableTarget(f"{tmp_path}/t", slice_width=16)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        write_log(messages(*range(199, -1, -1)), target)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [
        [r.offset for r in spark.read.parquet(name).select("offset").collect()]
        for name in target.read(spark).inputFiles()
    ]
    assert len(files) > 1 and all(offsets == sorted(offsets) for offsets in files)


def test_writers_do_not_share_batch_ids(spark, messages, tmp_path):
    one, two = (TableTarget(f"{tmp_path}/t", writer=w) for w in ("one", "two"))
    one.write_batch(messages(0), 0)
    two.write_batch(messages(1), 0)
    assert pairs(one.read(spark), "offset", "source_offset") == [(0, 0), (1, 1)]


def test_an_open_partition_is_refused_by_a_table(spark, make_log, make_routes, tmp_path):
    log = make_log(("a", 0, 0, b"k", b"v"))
    open_ended = to_message(log, make_routes(("a", "x", None)), "auto")
    with pytest.raises(Exception, match="needs a target partition"):
        TableTarget(f"{tmp_path}/t").write_batch(open_ended, 0)


def test_missing_from_sees_holes(spark, messages, tmp_path):
    target = TableTarget(f"{tmp_path}/t")
    target.write_batch(messages(0, 1, 5), 0)
    assert pairs(missing_from(messages(0, 1, 2, 5, 6), target.read(spark)), "source_offset") == [(2,), (6,)]


@pytest.mark.parametrize("single_writer", [True, False])
def test_order_within_a_partition(messages, single_writer):
    mixed = messages(*range(40, 0, -1)).unionByName(messages(*range(30, 0, -1), partition=1))
    ordered = order_for_write(mixed, width=8, single_writer=single_writer)
    tasks = ordered.withColumn("task", F.spark_partition_id()).collect()
    for task in {r.task for r in tasks}:
        mine = [(r.topic, r.partition, r.source_partition, r.source_offset) for r in tasks if r.task == task]
        assert mine == sorted(mine)
    if single_writer:
        for partition in (0, 1):
            assert len({r.task for r in tasks if r.partition == partition}) == 1


def test_a_hot_partition_is_written_by_several_tasks(spark, messages):
    # Tiny partitions would be put together again otherwise.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = order_for_write(messages(*range(200)), width=8)
        sizes = [r["count"] for r in ordered.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes) < 200


def test_a_sink_of_the_users_own(spark, messages, tmp_path):
    folder = str(tmp_path)

    def write_rows(rows):
        import uuid

        lines = [f"{row.source_offset} {bytes(row.value).decode()}" for row in rows]
        if lines:
            Path(folder, uuid.uuid4().hex).write_text("\n".join(lines))

    target = RowTarget(write_rows)
    target.write_batch(messages(2, 0, 1), 0)
    written = [f.read_text().split("\n") for f in Path(folder).iterdir()]
    assert written == [["0 v0", "1 v1", "2 v2"]]
    assert target.high_watermarks(spark).count() == 0


def test_codecs_and_acknowledgements():
    assert [compression_codec(c) for c in ("gzip", "snappy", "lz4", "zstd", "none", "other", None)] == [
        "gzip", "snappy", "lz4", "zstd", "none", "none", "none",
    ]
    assert [ack_policy(a) for a in ("tcp", "leader", "cluster", "other", None)] == ["0", "1", "all", "all", "all"]
    assert write_options("zstd", "leader", idempotent=False, max_bytes=10) == {
        "kafka.compression.type": "zstd",
        "kafka.acks": "1",
        "kafka.enable.idempotence": "false",
        "kafka.max.request.size": "10",
    }
    with pytest.raises(ValueError):
        write_options(acks="tcp", idempotent=True)


@pytest.mark.parametrize("codec", ["gzip", "snappy", "lz4", "zstd", "none"])
def test_all_codecs_write_tables(spark, messages, tmp_path, codec):
    options = write_options(codec, table=True)
    messages(0).write.options(**options).parquet(f"{tmp_path}/{codec}")
    assert spark.read.parquet(f"{tmp_path}/{codec}").count() == 1


def test_kafka_rows_carry_source_coordinates(messages):
    rows = KafkaTarget("host:9092", write_options()).rows(messages(7))
    assert rows.columns == ["topic", "partition", "key", "value", "headers"]
    assert [(h.key, bytes(h.value)) for h in rows.first().headers][1:] == [
        ("_st", b"a"), ("_sp", b"0"), ("_so", b"7"),
    ]
    restored = source_coordinates(rows).first()
    assert (restored.source_topic, restored.source_partition, restored.source_offset) == ("a", 0, 7)


def test_kafka_writer_options():
    options = KafkaTarget("host:9092", write_options("lz4")).writer_options()
    assert options["kafka.bootstrap.servers"] == "host:9092"
    assert options["kafka.compression.type"] == "lz4"
