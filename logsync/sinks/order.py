"""Keeping per-partition order into a sink."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.numbering import SLICE_WIDTH, slice_of
from ..schemas import MESSAGE_COLUMNS, MESSAGE_SCHEMA


def order_for_write(
    messages: DataFrame,
    order: Sequence[str] = ("source_partition", "source_offset"),
    width: int = SLICE_WIDTH,
    single_writer: bool = False,
) -> DataFrame:
    """Sort rows of a topic-partition by ``order``, whose last part is an offset.

    By default a task receives whole slices of ``width`` offsets, so that a hot
    partition is spread over tasks and every file covers narrow offset ranges;
    readers of a table order by offset. With ``single_writer`` all rows of a
    topic-partition go to one task in order, as an append-only broker needs;
    records without a partition are spread by key;
    use that within micro-batches, whose size ``max_per_trigger`` bounds.
    """
    *before, offset = order
    keys = ["topic", "partition"]
    if single_writer:
        # Where the sink chooses the partition, only a key's own order counts.
        free = F.xxhash64(F.coalesce(F.col("key"), F.concat_ws(":", *order).cast("binary")))
        spread = messages.repartition(*keys, F.when(F.col("partition").isNull(), free))
    else:
        spread = messages.repartition(*keys, *before, slice_of(offset, width))
    return spread.sortWithinPartitions(*keys, *order)


def staged_rounds(messages: DataFrame, folder: str, width: int) -> Iterator[DataFrame]:
    """``messages`` in parts of ``width`` source offsets of each partition, in that order.

    For targets that take a partition from a single task, which is then handed no
    more than a part of it. Messages are written to ``folder`` once, and each part
    is read from there; those without an offset come first.
    """
    spark, part = messages.sparkSession, "_round"
    rounds = messages.select(*MESSAGE_COLUMNS, slice_of("source_offset", width).alias(part))
    rounds.repartition(part, "topic", "partition").sortWithinPartitions(part).write.partitionBy(part).parquet(folder)
    schema = T.StructType([*MESSAGE_SCHEMA.fields, T.StructField(part, T.LongType())])
    staged = spark.read.schema(schema).parquet(folder)
    # Folders, of which there are as many as rounds.
    for row in staged.select(part).distinct().orderBy(part).collect():
        number = row[part]
        own = F.col(part).isNull() if number is None else F.col(part) == number
        yield staged.where(own).select(*MESSAGE_COLUMNS)
