"""What streams, lookups and failover must not lose or double."""

from __future__ import annotations

import os
import time
from pathlib import Path

import pytest

from logsync.operators import after_offsets, local_table, route_topics, until_offsets
from logsync.plans import relay_with_failover
from logsync.schemas import ROUTE_SCHEMA
from logsync.sinks import TableTarget, order_for_write
from logsync.sinks.targets import source_coordinates
from logsync.sources import TableLog
from logsync.streaming import relay_until_end

CONDITIONS = ((64, 200_000), (0, 200_000), (0, 0))


def rows(make_log, topic, low, high):
    return make_log(*((topic, 0, k, b"k", str(k).encode()) for k in range(low, high)))


def copied(spark, target):
    log = target.read(spark).select("source_topic", "source_offset").collect()
    return sorted((r[0], r[1]) for r in log)


def run(spark, source, routes, target, folder):
    relay_until_end(spark, source, routes, target, str(folder)).awaitTermination()


def test_reruns_lose_neither_late_old_nor_added(spark, make_log, make_routes, tmp_path):
    source, target = TableLog(str(tmp_path / "log")), TableTarget(str(tmp_path / "target"))
    one = make_routes(("a", "a_copy", None))
    source.append(rows(make_log, "a", 0, 10))
    source.append(rows(make_log, "b", 0, 4))
    run(spark, source, one, target, tmp_path / "checkpoint")
    known = set(Path(source.path).rglob("*.parquet"))
    source.append(rows(make_log, "a", 10, 15))
    past = time.time() - 40 * 86_400
    for file in set(Path(source.path).rglob("*.parquet")) - known:
        os.utime(file, (past, past))
    run(spark, source, one, target, tmp_path / "checkpoint")
    assert copied(spark, target) == [("a", k) for k in range(15)]
    both = make_routes(("a", "a_copy", None), ("b", "b_copy", None))
    source.append(rows(make_log, "b", 4, 6))
    run(spark, source, both, target, tmp_path / "checkpoint")
    assert copied(spark, target) == [("a", k) for k in range(15)] + [("b", k) for k in range(6)]


@pytest.mark.parametrize("literals, broadcast", CONDITIONS)
def test_offsets_act_alike_at_every_size(make_log, make_offsets, literals, broadcast):
    log = make_log(("a", 0, 1, None, None), ("a", 0, 5, None, None), ("b", 0, 2, None, None), (None, 0, 3, None, None))
    limits = {"literal_rows": literals, "broadcast_rows": broadcast}
    found = after_offsets(log, make_offsets(("a", 0, 3)), **limits).collect()
    assert sorted((r["topic"], r["offset"]) for r in found) == [("a", 5), ("b", 2)]
    found = until_offsets(log, make_offsets(("a", 0, 3)), **limits).collect()
    assert [(r["topic"], r["offset"]) for r in found] == [("a", 1)]
    twice = make_offsets(("a", 0, 3), ("a", 0, 4))
    for operator in (after_offsets, until_offsets):
        with pytest.raises(ValueError, match="several rows"):
            operator(log, twice, **limits)


@pytest.mark.parametrize("n", [2, 65])
def test_repeated_routes_are_refused(spark, make_log, n):
    routes = [(f"t{k}", "x", None) for k in range(n - 1)] + [("t0", "y", 1)]
    with pytest.raises(ValueError, match="several rows"):
        route_topics(rows(make_log, "t0", 0, 2), local_table(spark, routes, ROUTE_SCHEMA))


def test_failover_survives_a_damaged_source(spark, make_log, make_routes, tmp_path):
    sources = [TableLog(str(tmp_path / f"node{k}")) for k in range(2)]
    for source in sources:
        source.append(rows(make_log, "a", 0, 8))
    for file in Path(sources[0].path).rglob("*.parquet"):
        file.write_bytes(b"not a table")
        file.with_name(f".{file.name}.crc").unlink(missing_ok=True)
    target = TableTarget(str(tmp_path / "target"))
    history = relay_with_failover(spark, sources, make_routes(("a", "a_copy", None)), target, 2)
    assert history == [{"a": 1}, {"a": 1}]
    assert copied(spark, target) == [("a", k) for k in range(8)]


def test_source_coordinates_go_by_name(make_log):
    own = [("_st", b"t"), ("_sp", b"3"), ("_so", b"9")]
    log = make_log(
        ("c", 0, 0, None, None, [("_so", b"1"), *own]),
        ("c", 0, 1, None, None, [("x", b"1"), ("y", b"2"), ("z", b"3")]),
        ("c", 0, 2, None, None, None),
    )
    found = source_coordinates(log).orderBy("offset").collect()
    got = [(r["source_topic"], r["source_partition"], r["source_offset"]) for r in found]
    assert got == [("t", 3, 9), (None, None, None), (None, None, None)]


def test_records_without_partition_use_several_tasks(spark):
    messages = spark.range(4_000).selectExpr(
        "'t' AS topic", "cast(NULL AS int) AS partition", "cast(id % 50 AS string) AS text",
        "0 AS source_partition", "id AS source_offset",
    ).selectExpr("*", "cast(text AS binary) AS key")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        spread = order_for_write(messages, single_writer=True).selectExpr("key", "spark_partition_id() AS task")
        tasks = spread.distinct().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r["task"] for r in tasks}) > 1 and len(tasks) == 50
