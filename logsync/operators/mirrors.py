"""Identical logs on several nodes: tagging and merging their copies."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .intervals import offset_bitmap, stretch_of
from .lookup import BROADCAST_ROWS, LITERAL_ROWS, bounded_rows, local_table
from .numbering import slice_of

COORDINATES = ["topic", "partition", "offset"]
STRETCH = 32_768
BLOCK_STRETCHES = (1, 1_024)
BLOCK_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("_block", T.LongType()),
        T.StructField("_owner", T.LongType()),
    ]
)


def tag_mirrors(logs: Sequence[DataFrame]) -> DataFrame:
    """Union of the nodes' logs, ``node_id`` being the place in the list."""
    tagged = [log.withColumn("node_id", F.lit(i).cast("int")) for i, log in enumerate(logs)]
    return reduce(lambda a, b: a.unionByName(b), tagged)


def _rank(prefer: Sequence[int]) -> Column:
    """Preferred nodes in the order given, then the others by id."""
    rank = F.col("node_id").cast("long") + len(prefer)
    for place, node in reversed(list(enumerate(prefer))):
        rank = F.when(F.col("node_id") == node, F.lit(place).cast("long")).otherwise(rank)
    return rank


def merge_mirrors(
    mirrors: DataFrame,
    prefer: int | Sequence[int] | None = None,
    block_stretches: int | None = None,
    broadcast_rows: int = BROADCAST_ROWS,
) -> DataFrame:
    """One copy of every (topic, partition, offset): the best ranked node's.

    Copies of whole logs are not shuffled against each other. A first pass over
    the coordinates finds, per block of offsets, whether the best ranked node
    there holds every offset any node holds, and each once. Such a block is
    taken from that node by a plain filter. Only rows of the other blocks, in
    practice those around the ends of lagging nodes, are grouped by coordinate.
    """
    order = [] if prefer is None else [prefer] if isinstance(prefer, int) else list(prefer)
    ranked = mirrors.withColumn("_rank", _rank(order))
    # Coarse blocks where fine ones are too many to broadcast.
    sizes = BLOCK_STRETCHES if block_stretches is None else (block_stretches,)
    for stretches in sizes:
        blocks = bounded_rows(_block_owners(ranked, stretches), broadcast_rows)
        if blocks is not None:
            break
    if not blocks:
        return _best_copy(ranked).select(*mirrors.columns)

    width = STRETCH * stretches
    owned = [block for block in blocks if block._owner is not None]
    contested = [block for block in blocks if block._owner is None]
    parts = []
    if owned:
        parts.append(_of_blocks(ranked, owned, width))
    if contested:
        parts.append(_best_copy(_of_blocks(ranked, contested, width)))
    return reduce(
        lambda a, b: a.unionByName(b), [part.select(*mirrors.columns) for part in parts]
    )


def _of_blocks(ranked: DataFrame, blocks: Sequence[Row], width: int) -> DataFrame:
    """Rows of the blocks, from their owners where they have one.

    Neighbouring blocks of one owner form ranges. A few of those are literals,
    which skip row groups of each node's log, and whole logs of other nodes.
    """
    ranges: list[list] = []
    for block in sorted(blocks, key=lambda b: (b.topic, b.partition, b._block)):
        key = (block.topic, block.partition, block._owner)
        if ranges and ranges[-1][0] == key and ranges[-1][2] == block._block - 1:
            ranges[-1][2] = block._block
        else:
            ranges.append([key, block._block, block._block])
    if len(ranges) <= LITERAL_ROWS:
        conditions = []
        for (topic, partition, owner), first, last in ranges:
            inside = (
                (F.col("topic") == topic)
                & (F.col("partition") == partition)
                & F.col("offset").between(first * width, (last + 1) * width - 1)
            )
            conditions.append(inside if owner is None else inside & (F.col("_rank") == owner))
        return ranked.where(reduce(lambda a, b: a | b, conditions))
    table = local_table(ranked.sparkSession, blocks, BLOCK_SCHEMA)
    return (
        ranked.withColumn("_block", slice_of("offset", width))
        .join(F.broadcast(table), ["topic", "partition", "_block"])
        .where(F.col("_owner").isNull() | (F.col("_rank") == F.col("_owner")))
        .drop("_block", "_owner")
    )


def _block_owners(ranked: DataFrame, block_stretches: int) -> DataFrame:
    """Per block the rank of the node that alone can serve it, else NULL."""
    keys = ["topic", "partition", "_stretch"]
    nodes = (
        ranked.select("topic", "partition", "offset", "_rank", stretch_of("offset").alias("_stretch"))
        .groupBy(*keys, "_rank")
        .agg(offset_bitmap("offset").alias("_bits"), F.count(F.lit(1)).alias("_rows"))
    )
    stretches = nodes.groupBy(*keys).agg(
        F.bitmap_count(F.bitmap_or_agg("_bits")).alias("_all"),
        F.min(F.struct("_rank", "_rows", F.bitmap_count("_bits").alias("_distinct"))).alias("_best"),
    )
    served = (F.col("_best._distinct") == F.col("_all")) & (F.col("_best._rows") == F.col("_all"))
    blocks = stretches.groupBy(
        "topic",
        "partition",
        F.expr(f"(_stretch - 1) div {block_stretches}").alias("_block"),
    ).agg(
        F.bool_and(served).alias("_served"),
        F.min("_best._rank").alias("_first"),
        F.max("_best._rank").alias("_last"),
    )
    one_owner = F.col("_served") & (F.col("_first") == F.col("_last"))
    return blocks.select(
        "topic", "partition", "_block", F.when(one_owner, F.col("_first")).alias("_owner")
    )


def _best_copy(ranked: DataFrame) -> DataFrame:
    """Group by coordinate; copies are reduced map-side before the shuffle."""
    rest = [name for name in ranked.columns if name not in (*COORDINATES, "_rank")]
    return (
        ranked.groupBy(*COORDINATES)
        .agg(F.min_by(F.struct(*rest), F.col("_rank")).alias("_best"))
        .select(*COORDINATES, "_best.*")
    )
