import pytest
from helpers import pairs
from pyspark.sql import functions as F

from logsync.operators import local_table, reconcile, replication_lag, tag_mirrors
from logsync.plans import relay_bounded, relay_with_failover
from logsync.schemas import CATALOG_SCHEMA, HEALTH_SCHEMA
from logsync.sinks import RowTarget, TableTarget
from logsync.sources import TableLog, read_log_stream
from logsync.streaming import (
    ProgressListener,
    dedupe_mirrors,
    merge_mirrors_stream,
    progress_metrics,
    progress_rows,
    relay_stream,
    relay_until_end,
)

NOW = {"availableNow": True}


@pytest.fixture
def world(spark, make_log, make_routes, tmp_path):
    class World:
        source = TableLog(f"{tmp_path}/source")
        target = TableTarget(f"{tmp_path}/target")
        checkpoint = f"{tmp_path}/checkpoint"
        routes = make_routes(("a", "x", None), ("b", "y", 0))

        def produce(self, topic, partition, *offsets, source=None):
            rows = [(topic, partition, o, b"k", f"v{o}".encode()) for o in offsets]
            (source or self.source).append(make_log(*rows))

        def copied(self):
            return pairs(self.target.read(spark), "source_topic", "source_partition", "source_offset")

    return World()


def test_stream_resumes_without_loss_or_repeats(spark, world):
    world.produce("a", 0, 0, 1, 2)
    world.produce("b", 1, 0)
    world.produce("c", 0, 0)
    for expected in (4, 6):
        relay_stream(
            spark, world.source, world.routes, world.target, world.checkpoint, trigger=NOW
        ).awaitTermination()
        assert len(world.copied()) == expected
        world.produce("a", 0, 3, 4)
    assert world.copied() == [("a", 0, o) for o in range(5)] + [("b", 1, 0)]
    read = world.target.read(spark)
    assert pairs(read.where("topic = 'x'"), "offset", "source_offset") == [(o, o) for o in range(5)]


def test_a_batch_redelivered_after_its_commit_adds_nothing(spark, world, tmp_path):
    world.produce("a", 0, 0, 1)
    for checkpoint in ("one", "two"):
        # A lost checkpoint delivers batch 0 again.
        relay_stream(
            spark, world.source, world.routes, world.target, f"{tmp_path}/{checkpoint}", trigger=NOW
        ).awaitTermination()
    assert world.copied() == [("a", 0, 0), ("a", 0, 1)]


def test_until_end_equals_its_bounded_twin(spark, world, tmp_path):
    for o in range(0, 9, 3):
        world.produce("a", 0, o, o + 1, o + 2)
    filters = {"even": (F.substring(F.col("value").cast("string"), 2, 9).cast("int") % 2) == 0}
    relay_until_end(
        spark, world.source, world.routes, world.target, world.checkpoint,
        filters=filters, max_per_trigger=1,
    ).awaitTermination()
    twin = TableTarget(f"{tmp_path}/twin")
    relay_bounded(spark, world.source, world.routes, twin, filters)
    expected = pairs(twin.read(spark), "source_offset", "offset")
    assert expected == [(o, i) for i, o in enumerate(range(0, 9, 2))]
    assert pairs(world.target.read(spark), "source_offset", "offset") == expected


def test_relaying_twice_adds_nothing(spark, world):
    world.produce("a", 0, 0, 1)
    relay_bounded(spark, world.source, world.routes, world.target)
    relay_bounded(spark, world.source, world.routes, world.target)
    assert world.copied() == [("a", 0, 0), ("a", 0, 1)]
    world.produce("a", 1, 0)
    relay_bounded(spark, world.source, world.routes, world.target, missing="skip")
    assert world.copied() == [("a", 0, 0), ("a", 0, 1)]
    relay_bounded(spark, world.source, world.routes, world.target)
    assert world.copied() == [("a", 0, 0), ("a", 0, 1), ("a", 1, 0)]
    differing = reconcile(world.source.scan(spark, ["a"]), world.target.read(spark))
    assert differing.count() == 0


def test_rounds_keep_order_and_resume(spark, world, tmp_path):
    world.produce("a", 0, *range(7))
    world.produce("a", 1, 0, 1)
    folder = tmp_path / "rows"
    folder.mkdir()

    def write_rows(rows, folder=str(folder)):
        import os
        import time

        lines = [f"{row.source_partition} {row.source_offset}" for row in rows]
        if lines:
            with open(os.path.join(folder, str(time.time_ns())), "w") as out:
                out.write("\n".join(lines))

    rows = RowTarget(write_rows, max_per_round=3)
    assert relay_bounded(spark, world.source, world.routes, rows) == 3
    written = [
        line for name in sorted(folder.iterdir()) for line in name.read_text().split("\n")
    ]
    for partition, size in (("0", 7), ("1", 2)):
        mine = [line for line in written if line.startswith(partition)]
        assert mine == [f"{partition} {o}" for o in range(size)]
    assert relay_bounded(spark, world.source, world.routes, world.target, max_per_round=4) == 2
    assert len(world.copied()) == 9
    read = world.target.read(spark).where("partition = 0")
    assert pairs(read, "offset", "source_offset") == [(o, o) for o in range(7)]


def test_bad_routes_stop_the_start(spark, world):
    world.produce("a", 0, 0)
    catalog = local_table(spark, [("x", 0)], CATALOG_SCHEMA)
    with pytest.raises(ValueError, match="y:0"):
        relay_stream(
            spark, world.source, world.routes, world.target, world.checkpoint, catalog=catalog
        )


def test_mirror_stream_copies_each_coordinate_once(spark, world, tmp_path):
    nodes = [TableLog(f"{tmp_path}/n{i}") for i in range(2)]
    world.produce("a", 0, 0, 1, source=nodes[0])
    world.produce("a", 0, 0, 1, 2, 3, source=nodes[1])

    def run():
        mirrors = tag_mirrors([read_log_stream(spark, n, ["a"], max_per_trigger=1) for n in nodes])
        merge_mirrors_stream(
            mirrors, world.routes, world.target, world.checkpoint, trigger=NOW
        ).awaitTermination()

    run()
    assert world.copied() == [("a", 0, o) for o in range(4)]
    # The slow node catches up and overtakes.
    world.produce("a", 0, 2, 3, 4, source=nodes[0])
    run()
    assert world.copied() == [("a", 0, o) for o in range(5)]


def test_mirror_stream_with_bounded_lag(spark, world, tmp_path):
    nodes = [TableLog(f"{tmp_path}/n{i}") for i in range(2)]
    for node in nodes:
        world.produce("a", 0, 0, 1, source=node)
    mirrors = tag_mirrors([read_log_stream(spark, n, ["a"]) for n in nodes])
    assert dedupe_mirrors(mirrors, "1 hour").isStreaming
    merge_mirrors_stream(
        mirrors, world.routes, world.target, world.checkpoint, delay="1 hour", trigger=NOW
    ).awaitTermination()
    assert world.copied() == [("a", 0, 0), ("a", 0, 1)]


def test_progress_counts(spark, world, tmp_path):
    world.produce("a", 0, 0, 1, 2, 3)
    world.produce("a", 1, 0, 1)
    table = f"{tmp_path}/progress"
    listener = ProgressListener(spark, table, name="counted")
    spark.streams.addListener(listener)
    try:
        query = relay_until_end(
            spark, world.source, world.routes, world.target, world.checkpoint,
            filters={"not_v1": F.col("value") != b"v1"}, max_per_trigger=1, name="counted",
        )
        query.awaitTermination()
        totals = progress_metrics(progress_rows(query)).first()
        assert (totals.rows, totals.relayed, totals.filtered, totals.retries) == (6, 4, 2, 0)
        assert totals.batches == 2 and totals.max_rows == 4
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        stored = progress_metrics(spark.read.parquet(table)).first()
        assert (stored.rows, stored.relayed, stored.filtered) == (6, 4, 2)
    finally:
        spark.streams.removeListener(listener)


def test_lag_of_a_stream(spark, world, tmp_path):
    world.produce("a", 0, 0, 1)
    relay_bounded(spark, world.source, world.routes, world.target)
    schema = world.target.read(spark).withColumn("batch", F.lit("")).schema
    stream = spark.readStream.schema(schema).parquet(f"{world.target.path}/log")
    query = (
        replication_lag(stream, "1 hour", "1 hour")
        .writeStream.format("memory").queryName("lags").outputMode("complete")
        .option("checkpointLocation", f"{tmp_path}/lag").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert spark.table("lags").first().n == 2


# --- rounds over several sources --------------------------------------------


def test_failover_to_the_second_node_copies_only_what_is_new(spark, world, tmp_path):
    """Node 1 delivers one message and dies; node 2 holds it and one more."""
    nodes = [TableLog(f"{tmp_path}/n{i}") for i in range(2)]
    routes = world.routes
    world.produce("a", 0, 1, source=nodes[0])
    first = relay_with_failover(spark, nodes, routes.where("source_topic = 'a'"), world.target, rounds=1)
    assert first == [{"a": 0}]
    assert world.copied() == [("a", 0, 1)]
    world.produce("a", 0, 1, 2, source=nodes[1])
    gone = [TableLog(f"{tmp_path}/gone"), nodes[1]]
    second = relay_with_failover(spark, gone, routes.where("source_topic = 'a'"), world.target, rounds=1)
    assert second == [{"a": 1}]
    values = [bytes(r.value) for r in world.target.read(spark).orderBy("source_offset").collect()]
    assert values == [b"v1", b"v2"]


def test_rapid_switching_between_nodes(spark, world, make_health, tmp_path):
    """k1..k7 written to whichever node is up, one round after each."""
    nodes = [TableLog(f"{tmp_path}/n{i}") for i in range(2)]
    routes = world.routes.where("source_topic = 'a'")
    up = [(True, True), (False, True), (True, True), (True, False), (True, True), (False, True), (True, True)]
    held = [0, 0]
    samples = []
    for step, alive in enumerate(up):
        for node, is_up in enumerate(alive):
            if is_up:
                # A node that comes back catches up with everything so far.
                world.produce("a", 0, *range(held[node], step + 1), source=nodes[node])
                held[node] = step + 1
        samples.append([held[n] if alive[n] else None for n in range(2)])

    def poll(number):
        return make_health(samples[number], topic="a")

    history = relay_with_failover(
        spark, nodes, routes, world.target, rounds=len(up), poll=poll, threshold=0
    )
    assert [round["a"] for round in history] == [0, 1, 1, 0, 0, 1, 1]
    assert world.copied() == [("a", 0, o) for o in range(7)]


def test_identical_messages_from_all_nodes_arrive_once(spark, world, tmp_path):
    nodes = [TableLog(f"{tmp_path}/n{i}") for i in range(2)]
    for node in nodes:
        world.produce("a", 0, 0, 1, 2, source=node)
    routes = world.routes.where("source_topic = 'a'")
    relay_with_failover(spark, nodes, routes, world.target, rounds=2)
    assert world.copied() == [("a", 0, o) for o in range(3)]


def test_rounds_without_a_source_end(spark, world, tmp_path):
    nodes = [TableLog(f"{tmp_path}/none")]
    with pytest.raises(RuntimeError, match="no healthy source"):
        relay_with_failover(
            spark, nodes, world.routes, world.target, rounds=5, max_rounds_without_source=1
        )


def test_the_record_rule_waits_for_a_node_beyond_the_target(spark, world, tmp_path):
    node = TableLog(f"{tmp_path}/n0")
    world.produce("a", 0, 0, 1, source=node)
    routes = world.routes.where("source_topic = 'a'")
    relay_bounded(spark, node, routes, world.target)
    level = relay_with_failover(spark, [node], routes, world.target, rounds=1, documented_rule=False)
    assert level == [{"a": None}]
    world.produce("a", 0, 2, source=node)
    ahead = relay_with_failover(spark, [node], routes, world.target, rounds=1, documented_rule=False)
    assert ahead == [{"a": 0}]
    assert world.copied() == [("a", 0, o) for o in range(3)]


def test_a_health_sample_without_rows_of_a_topic(spark, world):
    health = local_table(spark, [], HEALTH_SCHEMA)
    history = relay_with_failover(
        spark, [world.source], world.routes, world.target, rounds=1, poll=lambda _: health
    )
    assert history == [{}]
