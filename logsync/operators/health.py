"""Choosing among mirrored sources by their polled end offsets.

The history operators look back over all earlier ticks of a topic. They work on
slices of time (an hour by default): each slice is reduced on its own, the few
slice results are run through in order, and the answer enters the slices again.
No task ever holds more than one slice of a topic's ticks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLICE = "hour"
NONE = -1  # stands for "no node" inside the folds below


def node_weights(health: DataFrame) -> DataFrame:
    """Sum of end offsets per tick, topic and node; -1 if any part failed."""
    return health.groupBy("tick", "topic", "node_id").agg(
        F.when(
            F.bool_and(F.coalesce("ok", F.lit(False))),
            F.coalesce(F.sum("end_offset"), F.lit(0)),
        )
        .otherwise(F.lit(-1))
        .cast("bigint")
        .alias("weight")
    )


def _healthy() -> Column:
    return F.col("weight") >= 0


def elect_source(health: DataFrame, at=None) -> DataFrame:
    """Per topic, at the latest tick, the healthy node with the largest weight.

    Ties go to the lowest id; a topic without a healthy node has no row. ``at``
    elects as of that time. One pass: no join back to the latest tick.
    """
    if at is not None:
        health = health.where(F.col("tick") <= F.lit(at))
    standing = F.struct("tick", "weight", (-F.col("node_id")).alias("lowest"), "node_id")
    return (
        node_weights(health)
        .groupBy("topic")
        .agg(F.max("tick").alias("tick"), F.max(F.when(_healthy(), standing)).alias("best"))
        .where(F.col("best.tick") == F.col("tick"))
        .select("tick", "topic", "best.node_id", "best.weight")
    )


def best_per_tick(weights: DataFrame) -> DataFrame:
    """The healthy node with the largest weight at every tick, if any."""
    standing = F.struct("weight", (-F.col("node_id")).alias("lowest"), "node_id")
    return (
        weights.groupBy("tick", "topic")
        .agg(F.max(F.when(_healthy(), standing)).alias("best"))
        .select("tick", "topic", "best.node_id", "best.weight")
    )


def _ticks(health: DataFrame, slice_by: str) -> DataFrame:
    """One row per tick, laid out by slice: its nodes, and the best if any.

    Everything below groups by topic and slice, so this is the only shuffle of
    ticks; later ones move slice results.
    """
    standing = F.struct("weight", (-F.col("node_id")).alias("lowest"), "node_id")
    return (
        node_weights(health)
        .withColumn("_slice", F.date_trunc(slice_by, F.col("tick")))
        .repartition("topic", "_slice")
        .groupBy("topic", "_slice", "tick")
        .agg(
            F.collect_list(F.struct("node_id", "weight")).alias("_nodes"),
            F.max("weight").alias("_most"),
            F.max(F.when(_healthy(), standing)).alias("_best"),
        )
    )


def _with_candidates(
    ticks: DataFrame, initial_weight: int, state: DataFrame | None
) -> DataFrame:
    """Add ``candidate`` and ``record`` by the record-high rule.

    The last record of a slice is the first tick at its highest weight, so a
    slice is summed up by that weight and node.
    """
    weight = F.col("_best.weight")
    slices = ticks.groupBy("topic", "_slice").agg(
        F.max(weight).alias("_high"),
        F.max_by("_best.node_id", F.struct(weight, -F.unix_micros("tick"))).alias("_high_node"),
    )
    if state is None:
        slices = slices.withColumn("_record0", F.lit(initial_weight).cast("bigint"))
        slices = slices.withColumn("_candidate0", F.lit(None).cast("int"))
    else:
        known = state.select(
            "topic", F.col("record").alias("_record0"), F.col("candidate").alias("_candidate0")
        )
        slices = slices.join(known, "topic", "left").withColumn(
            "_record0", F.coalesce("_record0", F.lit(initial_weight))
        )
    earlier = W.partitionBy("topic").orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    entered = (
        slices.withColumn("_record", F.greatest(F.max("_high").over(earlier), "_record0"))
        .withColumn("_taken", F.when(F.col("_high") > F.col("_record"), F.col("_high_node")))
        .select(
            "topic",
            "_slice",
            "_record",
            F.coalesce(
                F.last("_taken", ignorenulls=True).over(earlier), "_candidate0"
            ).alias("_candidate"),
        )
    )
    inside = W.partitionBy("topic", "_slice").orderBy("tick")
    before = F.max(weight).over(inside.rowsBetween(W.unboundedPreceding, -1))
    latest = F.last("_taken", ignorenulls=True).over(inside.rowsBetween(W.unboundedPreceding, 0))
    return (
        ticks.join(entered, ["topic", "_slice"])
        .withColumn("_record", F.greatest(before, "_record"))
        .withColumn("_taken", F.when(weight > F.col("_record"), F.col("_best.node_id")))
        .withColumn("candidate", F.coalesce(latest, "_candidate"))
        .withColumn("record", F.greatest(weight, "_record"))
    )


def candidate_history(
    health: DataFrame,
    initial_weight: int = 0,
    state: DataFrame | None = None,
    slice_by: str = SLICE,
) -> DataFrame:
    """The candidate at every tick by the record-high rule.

    A node becomes candidate only when its weight strictly exceeds the weight
    remembered for the present one. That weight starts at ``initial_weight``
    (the sum of the target's offsets) with no candidate, and never drops; a
    failing candidate stays. ``state`` (topic, candidate, record) replaces the
    start values of its topics. Returns tick, topic, node_id and weight, which
    is the remembered one.
    """
    return _with_candidates(_ticks(health, slice_by), initial_weight, state).select(
        "tick", "topic", F.col("candidate").alias("node_id"), F.col("record").alias("weight")
    )


def active_history(
    health: DataFrame,
    threshold: int,
    initial_weight: int = 0,
    state: DataFrame | None = None,
    slice_by: str = SLICE,
) -> DataFrame:
    """The node in use after every tick, and the one in use before it.

    The active node stays unless there is none, it failed at this tick, or some
    node leads it by more than ``threshold``. Then this tick's candidate takes
    over if it is healthy now, else no node does until the next tick. ``state``
    (topic, candidate, record, active) continues from an earlier history.

    Returns tick, topic, node_id, previous_node, candidate and record.
    """
    if threshold < 0:
        raise ValueError("threshold must not be negative")
    # The nodes that may stay if active, and who follows else.
    ticks = _with_candidates(_ticks(health, slice_by), initial_weight, state).select(
        "topic",
        "_slice",
        "tick",
        F.transform(
            F.filter(
                "_nodes",
                lambda n: (n["weight"] >= 0) & (F.col("_most") - n["weight"] <= threshold),
            ),
            lambda n: n["node_id"],
        ).alias("stay"),
        F.when(
            F.exists(
                "_nodes",
                lambda n: (n["node_id"] == F.col("candidate")) & (n["weight"] >= 0),
            ),
            F.col("candidate"),
        )
        .otherwise(F.lit(NONE))
        .alias("follow"),
        "candidate",
        "record",
    )
    slices = ticks.groupBy("topic", "_slice").agg(
        F.array_sort(
            F.collect_list(F.struct("tick", "stay", "follow", "candidate", "record"))
        ).alias("_steps")
    )
    trail = F.aggregate(
        "_steps",
        F.struct(F.col("_start").alias("node"), F.array().cast("array<int>").alias("nodes")),
        lambda seen, step: F.struct(
            _next_node(seen["node"], step).alias("node"),
            F.concat(seen["nodes"], F.array(_next_node(seen["node"], step))).alias("nodes"),
        ),
    )["nodes"]
    replayed = (
        slices.join(_slice_starts(slices, state, slice_by), ["topic", "_slice"])
        .withColumn("_after", trail)
        .withColumn(
            "_before",
            F.concat(F.array("_start"), F.slice("_after", 1, F.size("_after") - 1)),
        )
        .select("topic", F.explode(F.arrays_zip("_steps", "_before", "_after")).alias("_at"))
    )
    return replayed.select(
        "_at._steps.tick",
        "topic",
        _node("_at._after").alias("node_id"),
        _node("_at._before").alias("previous_node"),
        "_at._steps.candidate",
        "_at._steps.record",
    )


def _next_node(node: Column, step: Column) -> Column:
    return F.when(F.array_contains(step["stay"], node), node).otherwise(step["follow"])


def _node(name: str) -> Column:
    return F.nullif(F.col(name), F.lit(NONE))


# Stretches of time that hold a bounded number of the one before.
COARSER = {"second": "minute", "minute": "hour", "hour": "day", "day": "month", "week": "year", "month": "year", "quarter": "year"}


def _slice_starts(slices: DataFrame, state: DataFrame | None, slice_by: str) -> DataFrame:
    """The active node on entry to every slice.

    A slice maps the node active before it to the one active after it. Nodes
    that may not stay at its first tick all end like "no node", so the map has
    one entry for those and one for each node that may. Maps of neighbouring
    slices are composed to those of days, months and years, a few dozen at a
    time; then the node on entry is handed down the same way. No array holds
    more than the years of a topic.
    """
    enter = F.concat(F.array(F.lit(NONE)), F.col("_steps")[0]["stay"])
    leave = F.transform(
        enter, lambda node: F.struct(node.alias("key"), F.aggregate("_steps", node, _next_node).alias("value"))
    )
    maps = slices.select("topic", "_slice", leave.alias("_leave"))
    levels, unit = [], COARSER.get(slice_by)
    while unit is not None:
        levels.append(_composed(maps, F.date_trunc(unit, "_slice")))
        maps = levels[-1].select("topic", F.col("_group").alias("_slice"), "_leave")
        unit = COARSER.get(unit)
    top = _composed(maps, F.lit(None).cast("timestamp"))
    initial = F.lit(NONE)
    if state is not None:
        known = state.select("topic", F.col("active").alias("_initial"))
        top = top.join(known, "topic", "left")
        initial = F.coalesce("_initial", F.lit(NONE))
    starts = _entered(top.withColumn("_start", initial))
    for level in reversed(levels):
        starts = _entered(level.join(starts.withColumnRenamed("_slice", "_group"), ["topic", "_group"]))
    return starts


def _leaving(node: Column, one: Column) -> Column:
    found = F.filter(one["_leave"], lambda entry: entry["key"] == node)
    return F.coalesce(F.try_element_at(found, F.lit(1))["value"], one["_leave"][0]["value"])


def _composed(maps: DataFrame, group: Column) -> DataFrame:
    """For each group of neighbours their maps in order, and the map through all of them."""
    ordered = F.array_sort(F.collect_list(F.struct("_slice", "_leave")))
    grouped = maps.groupBy("topic", group.alias("_group")).agg(ordered.alias("_maps"))
    rest = F.slice("_maps", 2, F.size("_maps"))
    through = F.transform(
        F.col("_maps")[0]["_leave"],
        lambda e: F.struct(e["key"].alias("key"), F.aggregate(rest, e["value"], _leaving).alias("value")),
    )
    return grouped.withColumn("_leave", through)


def _entered(groups: DataFrame) -> DataFrame:
    """The node on entry to each member of groups with ``_start``."""
    nodes = F.aggregate(
        "_maps",
        F.struct(F.col("_start").alias("node"), F.array().cast("array<int>").alias("nodes")),
        lambda seen, one: F.struct(
            _leaving(seen["node"], one).alias("node"),
            F.concat(seen["nodes"], F.array(seen["node"])).alias("nodes"),
        ),
    )["nodes"]
    return groups.select("topic", F.explode(F.arrays_zip("_maps", nodes.alias("_start"))).alias("_at")).select(
        "topic", "_at._maps._slice", "_at._start"
    )


def lag_breaches(weights: DataFrame, active: DataFrame, threshold: int) -> DataFrame:
    """Nodes that lead the node in use by more than ``threshold``, per tick.

    The node in use is the one active before the tick; ticks at which it failed
    are skipped, and failed nodes never lead. ``active`` is an active_history.
    """
    in_use = active.where(F.col("previous_node").isNotNull()).select(
        "tick", "topic", F.col("previous_node").alias("active_node")
    )
    # The active weight is picked by an aggregate, not by joining weights twice.
    ticks = weights.join(in_use, ["tick", "topic"])
    active_weight = F.max(F.when(F.col("node_id") == F.col("active_node"), F.col("weight")))
    per_tick = ticks.groupBy("tick", "topic", "active_node").agg(
        active_weight.alias("_active_weight"),
        F.collect_list(F.struct("node_id", "weight")).alias("_nodes"),
    )
    return (
        per_tick.where(F.col("_active_weight") >= 0)
        .select("tick", "topic", "active_node", "_active_weight", F.explode("_nodes").alias("_n"))
        .select(
            "tick",
            "topic",
            "active_node",
            "_n.node_id",
            (F.col("_n.weight") - F.col("_active_weight")).alias("lead"),
        )
        .where((F.col("node_id") != F.col("active_node")) & (F.col("lead") > threshold))
    )


def switch_counts(active: DataFrame) -> DataFrame:
    """How often each topic's source changed, the first connection included."""
    changed = F.col("node_id").isNotNull() & ~F.col("node_id").eqNullSafe(F.col("previous_node"))
    return active.groupBy("topic").agg(F.count_if(changed).alias("switches"))


def node_health_summary(health: DataFrame, breaches: DataFrame | None = None) -> DataFrame:
    """Per topic and node: last weight, polls, failed polls, lag breaches.

    A breach is counted under the node that led.
    """
    summary = (
        node_weights(health)
        .groupBy("topic", "node_id")
        .agg(
            F.max_by("weight", "tick").alias("last_weight"),
            F.count(F.lit(1)).alias("polls"),
            F.count_if(~_healthy()).alias("failed"),
        )
    )
    if breaches is None:
        return summary.withColumn("breaches", F.lit(0).cast("bigint"))
    counts = breaches.groupBy("topic", "node_id").agg(F.count(F.lit(1)).alias("breaches"))
    return summary.join(counts, ["topic", "node_id"], "left").withColumn(
        "breaches", F.coalesce("breaches", F.lit(0))
    )
