import random

import pytest
from helpers import EPOCH, pairs
from pyspark.sql import functions as F

from logsync.operators import (
    active_history,
    candidate_history,
    elect_source,
    lag_breaches,
    local_table,
    node_health_summary,
    node_weights,
    switch_counts,
)
from logsync.plans.failover import STATE_SCHEMA
from logsync.schemas import HEALTH_SCHEMA
from logsync.streaming import ActiveHistory


def by_tick(df, column):
    return [row[0] for row in df.orderBy("tick").select(column).collect()]


def fold(ticks, threshold, initial=0):
    """The rules, one tick after the other."""
    record, candidate, active = initial, None, None
    candidates, actives = [], []
    for weights in ticks:
        alive = {n: w for n, w in enumerate(weights) if w is not None}
        if alive:
            best = max(alive, key=lambda n: (alive[n], -n))
            if alive[best] > record:
                record, candidate = alive[best], best
        breached = active in alive and max(alive.values()) - alive[active] > threshold
        if active not in alive or breached:
            active = candidate if candidate in alive else None
        candidates.append(candidate)
        actives.append(active)
    return candidates, actives


def test_weights_sum_partitions_and_fail_as_a_whole(spark):
    rows = [
        (EPOCH, "t", 0, 0, 5, True),
        (EPOCH, "t", 0, 1, 7, True),
        (EPOCH, "t", 1, 0, 9, True),
        (EPOCH, "t", 1, 1, None, False),
        (EPOCH, "t", 2, None, None, False),
    ]
    weights = node_weights(local_table(spark, rows, HEALTH_SCHEMA))
    assert pairs(weights, "node_id", "weight") == [(0, 12), (1, -1), (2, -1)]


def test_election(make_health):
    assert pairs(elect_source(make_health([1, 5, 3])), "node_id", "weight") == [(1, 5)]
    assert pairs(elect_source(make_health([4, 4, None])), "node_id") == [(0,)]
    assert pairs(elect_source(make_health([9, 1], [None, 1])), "node_id") == [(1,)]
    # Only the latest tick counts.
    assert elect_source(make_health([9, 1], [None, None])).count() == 0
    assert pairs(elect_source(make_health([9, 1], [None, None]), at=EPOCH), "node_id") == [(0,)]


def test_a_candidate_must_exceed_the_record(make_health):
    ticks = [[5, 3], [None, 5], [None, 6], [9, 6]]
    assert by_tick(candidate_history(make_health(*ticks)), "node_id") == [0, 0, 1, 0]
    assert by_tick(candidate_history(make_health(*ticks)), "weight") == [5, 5, 6, 9]


def test_the_target_sets_the_first_record(make_health):
    ticks = [[5, 3], [6, 3]]
    assert by_tick(candidate_history(make_health(*ticks), initial_weight=5), "node_id") == [None, 0]


def test_a_lead_equal_to_the_threshold_is_no_breach(make_health):
    health = make_health([5, 1], [5, 15], [5, 16])
    active = active_history(health, 10)
    assert by_tick(active, "node_id") == [0, 0, 1]
    found = lag_breaches(node_weights(health), active, 10)
    assert pairs(found, "active_node", "node_id", "lead") == [(0, 1, 11)]


def test_all_nodes_down(make_health):
    active = active_history(make_health([5, 4], [None, None], [None, 6]), 10)
    assert by_tick(active, "node_id") == [0, None, 1]
    assert by_tick(active, "previous_node") == [None, 0, None]
    assert switch_counts(active).first().switches == 2


@pytest.mark.parametrize("slice_by", ["hour", "day", "year"])
@pytest.mark.parametrize("seed", range(4))
def test_history_equals_the_sequential_fold(make_health, slice_by, seed):
    rng = random.Random(seed)
    level = [0, 0, 0]
    ticks = []
    for _ in range(60):
        level = [w + rng.randint(0, 9) for w in level]
        ticks.append([w if rng.random() > 0.25 else None for w in level])
    candidates, actives = fold(ticks, threshold=12, initial=6)
    health = make_health(*ticks, hours=5)
    active = active_history(health, 12, initial_weight=6, slice_by=slice_by)
    assert by_tick(active, "candidate") == candidates
    assert by_tick(active, "node_id") == actives
    assert by_tick(active, "previous_node") == [None, *actives[:-1]]


def test_history_continues_from_a_state(spark, make_health):
    ticks = [[5, 3], [None, 9], [20, 9], [20, None]]
    whole = active_history(make_health(*ticks), 5)
    first = active_history(make_health(*ticks[:2]), 5)
    last = first.orderBy(F.desc("tick")).first()
    state = local_table(spark, [("t", last.candidate, last.record, last.node_id)], STATE_SCHEMA)
    rest = active_history(make_health(*ticks[2:]), 5, state=state)
    assert by_tick(first, "node_id") + by_tick(rest, "node_id") == by_tick(whole, "node_id")


def test_history_in_batches(spark, make_health, tmp_path):
    ticks = [[5, 3], [None, 9], [20, 9], [20, None], [20, 31], [None, None]]
    health = make_health(*ticks)
    history = ActiveHistory(str(tmp_path), threshold=5)
    ids = [r.tick for r in health.select("tick").distinct().orderBy("tick").collect()]
    # The middle batch runs twice, as after a failure.
    for batch, (first, last) in ((0, (0, 2)), (1, (2, 4)), (1, (2, 4)), (2, (4, 6))):
        history.add(health.where(F.col("tick").isin(ids[first:last])), batch)
    whole = active_history(health, 5)
    for column in ("node_id", "previous_node", "candidate", "record"):
        assert by_tick(history.read(spark), column) == by_tick(whole, column)


def test_topics_are_kept_apart(make_health):
    health = make_health([5, 3]).unionByName(make_health([1, 3], topic="u"))
    assert pairs(active_history(health, 5), "topic", "node_id") == [("t", 0), ("u", 1)]


def test_summary(make_health):
    health = make_health([5, 1], [5, 16], [None, 17])
    breaches = lag_breaches(node_weights(health), active_history(health, 10), 10)
    summary = node_health_summary(health, breaches)
    assert pairs(summary, "node_id", "last_weight", "polls", "failed", "breaches") == [
        (0, -1, 3, 1, 0),
        (1, 17, 3, 0, 1),
    ]


def test_negative_threshold_is_refused(make_health):
    with pytest.raises(ValueError):
        active_history(make_health([1]), -1)
