"""Intervals of offsets: found, merged, left out; and holes that a target still lacks."""

from __future__ import annotations

from pathlib import Path

import pytest
from helpers import pairs
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logsync.operators import local_table, tag_mirrors, to_message
from logsync.operators.intervals import (
    INTERVAL_SCHEMA,
    merged_intervals,
    offset_intervals,
    outside_intervals,
)
from logsync.plans import relay_bounded
from logsync.plans.replicate import rounds
from logsync.sinks import TableTarget, write_log
from logsync.sinks.snapshots import KEPT, newest
from logsync.sources import TableLog, read_log_stream
from logsync.streaming import merge_mirrors_stream, relay_until_end
from logsync.streaming.progress import denied_totals, metrics_over_time, progress_metrics


def log_of(spark, offsets, partition=0):
    frame = spark.createDataFrame([(o,) for o in offsets], "offset long")
    return frame.select(F.lit("t").alias("topic"), F.lit(partition).alias("partition"), "offset")


def brute_intervals(offsets):
    out = []
    for offset in sorted(set(offsets)):
        if out and out[-1][1] == offset:
            out[-1][1] = offset + 1
        else:
            out.append([offset, offset + 1])
    return [tuple(x) for x in out]


EDGES = [0, 1, 2, 32_766, 32_767, 32_768, 32_769, 65_535, 65_536, 98_303, 98_304, 200_000]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(st.integers(0, 70), st.sampled_from(EDGES)), min_size=1, max_size=60))
def test_intervals_of_a_log(spark, offsets):
    assert pairs(offset_intervals(log_of(spark, offsets)), "low", "high") == brute_intervals(offsets)


def test_long_runs_across_stretches(spark):
    log = spark.range(100_000).where("id NOT IN (5, 40000, 40001, 99998)").select(
        F.lit("t").alias("topic"), F.lit(1).alias("partition"), F.col("id").alias("offset")
    )
    assert pairs(offset_intervals(log.unionByName(log)), "low", "high") == [
        (0, 5), (6, 40_000), (40_002, 99_998), (99_999, 100_000),
    ]
    nowhere = log.withColumn("topic", F.lit(None).cast("string"))
    assert offset_intervals(nowhere).count() == 0


def test_merging_takes_touching_and_nested_ones(spark):
    rows = [("t", 0, 5, 9), ("t", 0, 0, 3), ("t", 0, 3, 4), ("t", 0, 6, 7), ("t", 1, 0, 1), ("t", 0, 20, 20), (None, 0, 1, 2)]
    merged = merged_intervals(local_table(spark, rows, INTERVAL_SCHEMA))
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(
        [(None, 0, 1, 2), ("t", 0, 0, 4), ("t", 0, 5, 9), ("t", 1, 0, 1)], key=str
    )


@pytest.mark.parametrize("literals, broadcast", [(64, None), (0, None), (0, 0)])
def test_outside_intervals_at_every_size(spark, literals, broadcast):
    log = log_of(spark, range(200)).unionByName(log_of(spark, range(50), 1))
    intervals = local_table(spark, [("t", 0, 10, 90), ("t", 0, 95, 96), ("t", 1, 0, 50), ("u", 0, 0, 999)], INTERVAL_SCHEMA)
    left = outside_intervals(log, intervals, literals, broadcast, width=16)
    expected = [(0, o) for o in range(200) if not 10 <= o < 90 and o != 95]
    assert pairs(left, "partition", "offset") == expected
    assert outside_intervals(log, intervals.where("false"), literals, broadcast).count() == 250


def test_rounds_end_together_and_are_not_listed(spark, make_offsets):
    start, ends = make_offsets(("a", 0, 10), ("b", 0, 0)), make_offsets(("a", 0, 20_000_010), ("b", 0, 100), ("c", 0, 7))
    planned = rounds(start, ends, "start", 2_000)
    at = {}
    for number, (low, high) in enumerate(planned):
        assert all(at.get(pair, low[pair]) == low[pair] for pair in low)
        assert all(0 < high[pair] - low[pair] <= 2_000 for pair in low)
        at.update(high)
    assert number == 9_999 and at == {("a", 0): 20_000_010, ("b", 0): 100, ("c", 0): 7}
    only = list(rounds(start, ends, "skip", None))
    assert len(only) == 1 and ("c", 0) not in only[0][0]


def records(make_log, offsets, topic="a"):
    return make_log(*((topic, 0, o, b"k", f"v{o}".encode()) for o in offsets))


def test_a_mirror_stream_then_a_bounded_copy_gives_the_whole_log(spark, make_log, make_routes, tmp_path):
    """The stream meets mirrors with holes; what none of them had then is copied later."""
    nodes = [TableLog(f"{tmp_path}/n{i}") for i in range(2)]
    nodes[0].append(records(make_log, [*range(0, 20), *range(50, 70)]))
    nodes[1].append(records(make_log, [*range(10, 30), *range(60, 80)]))
    target, routes = TableTarget(f"{tmp_path}/target"), make_routes(("a", "x", None))
    streams = tag_mirrors([read_log_stream(spark, n, ["a"]) for n in nodes])
    merge_mirrors_stream(
        streams, routes, target, f"{tmp_path}/checkpoint", trigger={"availableNow": True}
    ).awaitTermination()
    assert pairs(target.covered(spark), "low", "high") == [(0, 30), (50, 80)]
    assert pairs(target.high_watermarks(spark), "next_offset") == [(30,)]
    whole = TableLog(f"{tmp_path}/whole")
    whole.append(records(make_log, range(100)))
    assert relay_bounded(spark, whole, routes, target) == 1
    assert sorted(o for (o,) in pairs(target.read(spark), "source_offset")) == list(range(100))
    assert pairs(target.covered(spark), "low", "high") == [(0, 100)]
    assert relay_bounded(spark, whole, routes, target) == 0


def test_denied_ranges_are_not_judged_again(spark, make_log, make_routes, tmp_path):
    source, target = TableLog(f"{tmp_path}/log"), TableTarget(f"{tmp_path}/target")
    source.append(records(make_log, range(10)))
    routes, nothing = make_routes(("a", "x", None)), {"none": F.lit(False)}
    assert relay_bounded(spark, source, routes, target, nothing) == 1
    assert target.read(spark).count() == 0
    assert relay_bounded(spark, source, routes, target, nothing) == 0
    source.append(records(make_log, range(10, 12)))
    assert relay_bounded(spark, source, routes, target) == 1
    assert pairs(target.read(spark), "source_offset") == [(10,), (11,)]


def test_a_filtered_stream_then_a_bounded_copy(spark, make_log, make_routes, tmp_path):
    source, target = TableLog(f"{tmp_path}/log"), TableTarget(f"{tmp_path}/target")
    source.append(records(make_log, range(40)))
    routes = make_routes(("a", "x", None))
    odd = {"odd": lambda v: F.substring(v.cast("string"), 2, 9).cast("int") % 2 == 1}
    relay_until_end(spark, source, routes, target, f"{tmp_path}/c", filters=odd).awaitTermination()
    assert pairs(target.covered(spark), "low", "high") == [(0, 40)]
    assert relay_bounded(spark, source, routes, target) == 0
    assert target.read(spark).count() == 20


def test_a_stream_that_starts_late_leaves_no_hole(spark, make_log, make_routes, make_offsets, tmp_path):
    source, target = TableLog(f"{tmp_path}/log"), TableTarget(f"{tmp_path}/target")
    source.append(records(make_log, range(40)))
    routes = make_routes(("a", "x", None))
    relay_until_end(
        spark, source, routes, target, f"{tmp_path}/c", start=make_offsets(("a", 0, 25))
    ).awaitTermination()
    assert relay_bounded(spark, source, routes, target) == 0
    assert pairs(target.read(spark), "source_offset") == [(o,) for o in range(25, 40)]


def test_progress_does_not_grow_with_batches(spark, make_log, make_routes, tmp_path):
    target, routes = TableTarget(f"{tmp_path}/t"), make_routes(("a", "x", None))
    for k in range(KEPT + 4):
        write_log(to_message(records(make_log, [k]), routes), target)
    folder = Path(tmp_path, "t", "progress")
    assert len(list(folder.iterdir())) == KEPT
    snapshot = target.snapshot(spark).collect()
    # One pair of partitions, one writer, one interval of offsets.
    assert sorted(r.kind for r in snapshot) == ["covered", "pair", "writer"]
    assert {r.kind: (r.low, r.high) for r in snapshot if r.kind != "pair"} == {
        "covered": (0, KEPT + 4), "writer": (0, KEPT + 4),
    }
    assert [r.rows for r in snapshot if r.kind == "pair"] == [KEPT + 4]
    assert target.read(spark).count() == KEPT + 4


def test_a_snapshot_without_its_file_does_not_count(spark, make_log, make_routes, tmp_path):
    target, routes = TableTarget(f"{tmp_path}/t"), make_routes(("a", "x", None))
    write_log(to_message(records(make_log, [0]), routes), target)
    Path(tmp_path, "t", "progress", f"snapshot-{1:012d}", "_temporary").mkdir(parents=True)
    assert newest(spark, f"{tmp_path}/t/progress")[0] == 0
    assert target.next_batch_id(spark) == 1
    write_log(to_message(records(make_log, [1]), routes), target)
    assert newest(spark, f"{tmp_path}/t/progress")[0] == 1
    assert pairs(target.read(spark), "offset", "source_offset") == [(0, 0), (1, 1)]


def test_batches_may_come_out_of_order(spark, make_log, make_routes, tmp_path):
    routes = make_routes(("a", "x", None))
    one, two = (TableTarget(f"{tmp_path}/t", writer=w) for w in ("one", "two-2"))
    for target, batch_id, offset in ((one, 5, 0), (one, 3, 1), (two, 0, 2), (one, 5, 9), (one, 4, 3)):
        target.write_batch(to_message(records(make_log, [offset]), routes), batch_id)
    assert pairs(one.read(spark), "source_offset") == [(0,), (1,), (2,), (3,)]
    assert one.next_batch_id(spark) == 6 and two.next_batch_id(spark) == 1


def test_many_writers_are_joined(spark, make_log, make_routes, tmp_path, monkeypatch):
    from logsync.sinks import targets

    routes = make_routes(("a", "x", None))
    for k in range(3):
        TableTarget(f"{tmp_path}/t", writer=f"w-{k}").write_batch(to_message(records(make_log, [k]), routes), 0)
    orphan = TableTarget(f"{tmp_path}/t").read(spark).drop("source_timestamp")
    orphan.write.partitionBy("topic", "partition").parquet(f"{tmp_path}/t/log/batch=w-0-{1:012d}")
    monkeypatch.setattr(targets, "LITERAL_ROWS", 0)
    assert pairs(TableTarget(f"{tmp_path}/t").read(spark), "source_offset") == [(0,), (1,), (2,)]


def test_metrics_are_kept_with_the_batches(spark, make_log, make_routes, tmp_path):
    source, target = TableLog(f"{tmp_path}/log"), TableTarget(f"{tmp_path}/target")
    for low in range(0, 60, 20):
        source.append(records(make_log, range(low, low + 20)))
    number = lambda v: F.substring(v.cast("string"), 2, 9).cast("int")
    filters = {"odd": lambda v: number(v) % 2 == 1, "low": lambda v: number(v) < 50}
    relay_until_end(
        spark, source, make_routes(("a", "x", None)), target, f"{tmp_path}/c", filters=filters, max_per_trigger=1
    ).awaitTermination()
    metrics = target.metrics(spark)
    assert metrics.count() == 3
    total = progress_metrics(metrics).first()
    assert (total.batches, total.rows, total.relayed, total.filtered, total.retries) == (3, 60, 25, 35, 0)
    assert dict(pairs(denied_totals(metrics), "filter", "n")) == {"odd": 30, "low": 5}
    over = metrics_over_time(metrics, "1 day").first()
    # Values are v1 to v49: two to three bytes.
    assert (over.batches, over.relayed, over.p50_size, over.p95_size) == (3, 25, 3, 3)
    assert over.p50_lag_ms > 0 and over.p95_duration_ms >= over.p50_duration_ms


def test_a_batch_that_is_tried_again_counts_its_tries(spark, make_log, make_routes, tmp_path):
    from logsync.streaming.progress import batch_metrics

    target, routes = TableTarget(f"{tmp_path}/t"), make_routes(("a", "x", None))
    log = records(make_log, range(4)).withColumn("denied_by", F.lit(None).cast("string"))
    bad = to_message(log.drop("denied_by"), routes).withColumn("partition", F.lit(None).cast("int"))
    with pytest.raises(Exception, match="needs a target partition"):
        target.write_batch(bad, 0, counts=batch_metrics(log))
    assert target.metrics(spark).count() == 0
    target.write_batch(to_message(log.drop("denied_by"), routes), 0, counts=batch_metrics(log))
    row = target.metrics(spark).first()
    assert (row.batch_id, row.rows, row.relayed, row.filtered, row.retries, row.denied) == (0, 4, 4, 0, 1, {})


def test_metrics_of_an_empty_batch(spark, make_log):
    from logsync.streaming.progress import batch_metrics

    empty = make_log(("a", 0, 0, None, None)).where("false").withColumn("denied_by", F.lit(None).cast("string"))
    row = batch_metrics(empty).first()
    assert (row.rows, row.relayed, row.filtered, row.denied) == (0, 0, 0, {})
