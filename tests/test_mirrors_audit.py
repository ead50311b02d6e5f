import random

import pytest
from helpers import pairs
from pyspark.sql import functions as F

from logsync.operators import merge_mirrors, reconcile, replication_lag, tag_mirrors, to_message
from logsync.schemas import TARGET_LOG_COLUMNS


def mirror(make_log, node, *coordinates):
    return make_log(*[("t", p, o, b"k", f"{node}".encode()) for p, o in coordinates])


def brute_merge(nodes, ranks):
    best = {}
    for node in sorted(nodes, key=lambda n: ranks[n], reverse=True):
        for coordinate in nodes[node]:
            best[coordinate] = node
    return sorted((p, o, n) for (p, o), n in best.items())


def test_tagging_follows_the_list(make_log):
    tagged = tag_mirrors([mirror(make_log, 0, (0, 0)), mirror(make_log, 1, (0, 0), (0, 1))])
    assert pairs(tagged, "node_id", "offset") == [(0, 0), (1, 0), (1, 1)]


# Widely spread offsets: several blocks, some held whole by one node.
@pytest.mark.parametrize("prefer", [None, 1, [2, 0]])
@pytest.mark.parametrize("seed", range(3))
def test_merge_equals_brute_force(make_log, prefer, seed):
    rng = random.Random(seed)
    universe = [(p, o) for p in (0, 1) for o in (0, 1, 32_767, 32_768, 65_536, 65_537, 200_000)]
    nodes = {
        0: rng.sample(universe, 9),
        1: list(universe),
        2: [c for c in universe if c[1] < 65_537],
    }
    logs = [mirror(make_log, n, *nodes[n]) for n in range(3)]
    order = [] if prefer is None else [prefer] if isinstance(prefer, int) else prefer
    ranks = {n: (order.index(n) if n in order else 10 + n) for n in range(3)}
    expected = brute_merge(nodes, ranks)
    mirrors = tag_mirrors(logs)
    for options in ({}, {"block_stretches": 4}, {"broadcast_rows": 5}, {"broadcast_rows": 0}):
        merged = merge_mirrors(mirrors, prefer, **options)
        assert merged.columns == mirrors.columns
        assert pairs(merged, "partition", "offset", "node_id") == expected
        values = merged.select(F.col("value").cast("string").cast("int") == F.col("node_id"))
        assert all(row[0] for row in values.collect())


def test_a_whole_node_is_not_shuffled(make_log):
    full = mirror(make_log, 0, *[(0, o) for o in range(50)])
    part = mirror(make_log, 1, *[(0, o) for o in range(40)])
    merged = merge_mirrors(tag_mirrors([full, part]))
    assert merged.count() == 50
    plan = merged._jdf.queryExecution().toString()
    assert "Exchange hashpartitioning" not in plan


def test_many_blocks_are_looked_up(make_log, monkeypatch):
    from logsync.operators import mirrors as module

    monkeypatch.setattr(module, "LITERAL_ROWS", 0)
    offsets = [0, 1, 32_768, 65_536, 98_304, 98_305]
    logs = [mirror(make_log, 0, *[(0, o) for o in offsets[:3]]), mirror(make_log, 1, *[(0, o) for o in offsets])]
    logs[0] = logs[0].unionByName(mirror(make_log, 0, (0, 98_304)))
    merged = merge_mirrors(tag_mirrors(logs))
    assert pairs(merged, "offset", "node_id") == [
        (0, 0), (1, 0), (32_768, 0), (65_536, 1), (98_304, 0), (98_305, 1),
    ]


def test_logs_of_other_nodes_are_not_scanned(spark, make_log, tmp_path):
    from logsync.sources import TableLog, read_mirrors

    nodes = [TableLog(f"{tmp_path}/{i}") for i in range(2)]
    for node in nodes:
        node.append(make_log(*[("t", 0, o, b"k", b"v") for o in range(9)]))
    merged = merge_mirrors(read_mirrors(spark, nodes, ["t"]), prefer=1)
    assert pairs(merged, "offset", "node_id") == [(o, 1) for o in range(9)]
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_repeats_within_a_node_are_merged(make_log):
    log = mirror(make_log, 0, (0, 0), (0, 0), (0, 1))
    assert pairs(merge_mirrors(tag_mirrors([log])), "offset") == [(0,), (1,)]


def test_merging_any_subset_with_the_full_node_gives_the_log(make_log):
    full = [(0, o) for o in range(20)]
    logs = [mirror(make_log, 0, *full[:7]), mirror(make_log, 1, *full), mirror(make_log, 2, *full[3:9])]
    for subset in ([1], [0, 1], [1, 2], [0, 1, 2]):
        merged = merge_mirrors(tag_mirrors([logs[i] for i in subset]), block_stretches=1)
        assert pairs(merged, "partition", "offset") == full


def copy_of(source, make_routes):
    return (
        to_message(source, make_routes(("t", "x", None)))
        .withColumn("offset", F.col("source_offset"))
        .withColumn("timestamp", F.col("source_timestamp") + F.expr("INTERVAL 2 SECONDS"))
        .select(*TARGET_LOG_COLUMNS)
    )


def test_reconcile_statuses(make_log, make_routes):
    source = make_log(*[("t", 0, o, b"k", b"v") for o in range(6)])
    target = copy_of(source, make_routes)
    assert reconcile(source, target).count() == 0
    spoilt = (
        target.where("source_offset <> 1")
        .withColumn("value", F.when(F.col("source_offset") == 2, F.lit(None)).otherwise(F.col("value")))
        .unionByName(target.where("source_offset = 3"))
        .unionByName(target.where("source_offset = 5").withColumn("source_offset", F.lit(99).cast("long")))
    )
    assert pairs(reconcile(source, spoilt), "source_offset", "status") == [
        (1, "missing"),
        (2, "different"),
        (3, "repeated"),
        (99, "unexpected"),
    ]


def test_reconcile_of_nothing(make_log, make_routes):
    source = make_log(("t", 0, 0, b"k", b"v"))
    nothing = copy_of(make_log(), make_routes)
    assert pairs(reconcile(source, nothing), "status") == [("missing",)]


def test_replication_lag(make_log, make_routes):
    source = make_log(*[("t", 0, o, b"k", b"v") for o in range(4)])
    row = replication_lag(copy_of(source, make_routes)).first()
    assert (row.topic, row.n, row.avg_lag_ms, row.p50_lag_ms, row.max_lag_ms) == ("x", 4, 2000, 2000, 2000)
