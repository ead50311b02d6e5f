"""Dense numbering of rows within a key, without one task per key.

A plain ``row_number()`` over a topic-partition sorts that whole partition in
one task. Here rows are grouped by key and by a fixed-width slice of the order
column: slice sizes come from a map-side combined count, their running totals
give each slice its first number, and ``row_number()`` runs inside slices only.
The order column is unique within a key, so a slice never exceeds its width.
Slices depend on values alone, hence a recomputed task yields the same numbers.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SLICE_WIDTH = 1 << 16


def slice_of(column: str, width: int = SLICE_WIDTH) -> Column:
    """Number of the slice of ``width`` values that ``column`` falls into."""
    # Integer division: offsets may exceed what a double holds exactly.
    return F.expr(f"`{column}` div {width}")


def number_rows(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    name: str,
    then: Sequence[str] = (),
    width: int = SLICE_WIDTH,
    base: DataFrame | None = None,
) -> DataFrame:
    """Add ``name``: 0, 1, 2 … within ``keys`` by (``then``, ``order``).

    ``order`` is an integer column, unique within (``keys``, ``then``); the key
    columns hold no NULL. ``base`` (``keys``, next_offset) has the first number
    of keys that do not start at 0.
    """
    keys, then = list(keys), list(then)
    slice_keys = [*keys, *then, "_slice"]
    rows = df.withColumn("_slice", slice_of(order, width))
    sizes = rows.groupBy(*slice_keys).agg(F.count(F.lit(1)).alias("_size"))
    earlier = (
        W.partitionBy(*keys)
        .orderBy(*then, "_slice")
        .rowsBetween(W.unboundedPreceding, -1)
    )
    starts = sizes.select(
        *slice_keys,
        F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"),
    )
    if base is not None:
        starts = starts.join(base.select(*keys, "next_offset"), keys, "left").select(
            *slice_keys,
            (F.col("_start") + F.coalesce("next_offset", F.lit(0))).alias("_start"),
        )
    # The window and the join share one hash partitioning of the rows. Every row
    # finds its start; a left join keeps the optimizer from moving the rows.
    inside = W.partitionBy(*slice_keys).orderBy(order)
    return (
        rows.withColumn("_number", F.row_number().over(inside))
        .join(starts, slice_keys, "left")
        .withColumn(name, F.col("_start") + F.col("_number") - F.lit(1))
        .drop("_slice", "_number", "_start")
    )


def assign_target_offsets(
    messages: DataFrame, base: DataFrame | None = None, width: int = SLICE_WIDTH
) -> DataFrame:
    """Give messages dense target offsets that continue from ``base``.

    ``base`` is an offsets table of the target (topic, partition, next_offset);
    partitions it lacks start at 0. Within a target partition messages keep the
    order of their source partitions.
    """
    checked = messages.withColumn(
        "partition",
        F.when(F.col("partition").isNotNull(), F.col("partition")).otherwise(
            F.raise_error(F.lit("a table target needs a target partition")).cast("int")
        ),
    )
    return number_rows(
        checked,
        ["topic", "partition"],
        "source_offset",
        "offset",
        then=["source_topic", "source_partition"],
        width=width,
        base=base,
    )
