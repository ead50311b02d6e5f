"""Sets of offsets as intervals: found from bitmaps, merged, and left out of a log.

An interval holds offsets from ``low`` up to, not including, ``high``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .lookup import LITERAL_ROWS, bounded_rows, fits
from .numbering import slice_of

PARTITION_KEYS = ["topic", "partition"]
# Offsets of a bitmap.
STRETCH = 32_768
# Offsets of a slice in which a record is compared with intervals, one after the other.
COMPARED = 1_024
INTERVAL_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("low", T.LongType()),
        T.StructField("high", T.LongType()),
    ]
)


def stretch_of(offset: str) -> Column:
    """Number of the stretch of 32,768 offsets that ``offset`` falls into."""
    return F.bitmap_bucket_number(F.col(offset) + 1)


def offset_bitmap(offset: str) -> Column:
    """Aggregate: which offsets of a stretch occur, however often."""
    return F.bitmap_construct_agg(F.bitmap_bit_position(F.col(offset) + 1))


def stretches_of(log: DataFrame) -> DataFrame:
    """For each stretch that occurs: first and last offset, how many there are, and their bitmap.

    Bitmaps are combined map-side, so no row is shuffled.
    """
    thin = log.select(*PARTITION_KEYS, "offset", stretch_of("offset").alias("_stretch"))
    return (
        thin.groupBy(*PARTITION_KEYS, "_stretch")
        .agg(
            F.min("offset").alias("_low"),
            F.max("offset").alias("_high"),
            offset_bitmap("offset").alias("_bitmap"),
        )
        .withColumn("_seen", F.bitmap_count("_bitmap"))
    )


def _bits(bitmap: str) -> Column:
    """A bitmap as text of ``x`` and ``o``, the first offset first."""
    text = F.regexp_replace(F.hex(bitmap), "(.)(.)", "$2$1")
    for digit in range(16):
        bits = "".join("x" if digit >> place & 1 else "o" for place in range(4))
        text = F.replace(text, F.lit(f"{digit:X}"), F.lit(bits))
    return text


def runs_of(stretches: DataFrame) -> DataFrame:
    """Runs of offsets that occur, and of those that do not, in turn along each stretch."""
    runs = F.regexp_extract_all(_bits("_bitmap"), F.lit("(x+|o+)"), F.lit(1))
    sized = F.transform(runs, lambda run: F.struct(F.length(run).alias("n"), run.startswith(F.lit("x")).alias("present")))
    each = stretches.select(*PARTITION_KEYS, "_stretch", F.posexplode(sized).alias("_place", "_run"))
    # At most one run for each offset of a stretch.
    along = W.partitionBy(*PARTITION_KEYS, "_stretch").orderBy("_place")
    before = F.sum("_run.n").over(along.rowsBetween(W.unboundedPreceding, W.currentRow)) - F.col("_run.n")
    return each.select(
        *PARTITION_KEYS,
        "_stretch",
        ((F.col("_stretch") - 1) * STRETCH + before).alias("low"),
        ((F.col("_stretch") - 1) * STRETCH + before + F.col("_run.n")).alias("high"),
        F.col("_run.present").alias("present"),
    )


def merged_intervals(
    intervals: DataFrame, keys: Sequence[str] = PARTITION_KEYS, low: str = "low", high: str = "high"
) -> DataFrame:
    """Intervals that touch or overlap as one; ``keys`` may hold NULL."""
    ordered = W.partitionBy(*keys).orderBy(low, high)
    earlier = F.max(high).over(ordered.rowsBetween(W.unboundedPreceding, -1))
    starts = F.when(earlier.isNull() | (F.col(low) > earlier), 1).otherwise(0)
    numbered = (
        intervals.select(*keys, low, high)
        .where(F.col(low) < F.col(high))
        .withColumn("_starts", starts)
        .withColumn("_island", F.sum("_starts").over(ordered.rowsBetween(W.unboundedPreceding, 0)))
    )
    return (
        numbered.groupBy(*keys, "_island")
        .agg(F.min(low).alias(low), F.max(high).alias(high))
        .drop("_island")
    )


def offset_intervals(log: DataFrame) -> DataFrame:
    """The offsets of each partition of ``log`` as intervals, whatever repeats it holds."""
    stretches = stretches_of(log.where("topic IS NOT NULL AND partition IS NOT NULL"))
    whole = F.col("_seen") == F.col("_high") - F.col("_low") + 1
    inside = runs_of(stretches.where(~whole)).where("present").select(*PARTITION_KEYS, "low", "high")
    complete = stretches.where(whole).select(
        *PARTITION_KEYS, F.col("_low").alias("low"), (F.col("_high") + 1).alias("high")
    )
    return merged_intervals(complete.unionByName(inside))


def outside_intervals(
    log: DataFrame,
    intervals: DataFrame,
    literal_rows: int = LITERAL_ROWS,
    broadcast_rows: int | None = None,
    width: int = COMPARED,
) -> DataFrame:
    """Records of ``log`` whose offsets are in none of their partition's intervals.

    A few intervals become literals that a Parquet scan can use. More are cut at
    slices of ``width`` offsets and joined by slice, so that no task gets a
    whole partition; the join looks at the intervals of one slice for a record.
    """
    rows = bounded_rows(intervals.select(*INTERVAL_SCHEMA.fieldNames()), literal_rows)
    if rows is not None:
        # Each factor is an OR that can be pushed down.
        factors = [
            (F.col("topic") != r.topic)
            | (F.col("partition") != r.partition)
            | (F.col("offset") < r.low)
            | (F.col("offset") >= r.high)
            for r in rows
        ]
        return log.where(reduce(lambda a, b: a & b, factors, F.lit(True)))
    slices = F.sequence(slice_of("low", width), F.expr(f"(high - 1) div {width}"))
    cut = intervals.select(
        *(F.col(k).alias(f"_{k}") for k in PARTITION_KEYS), "low", "high", F.explode(slices).alias("_of")
    ).select(
        "_topic",
        "_partition",
        "_of",
        F.greatest("low", F.col("_of") * width).alias("_low"),
        F.least("high", (F.col("_of") + 1) * width).alias("_high"),
    )
    if fits(cut) if broadcast_rows is None else fits(cut, broadcast_rows):
        cut = F.broadcast(cut)
    sliced = log.withColumn("_slice", slice_of("offset", width))
    covered = (
        (F.col("topic") == F.col("_topic"))
        & (F.col("partition") == F.col("_partition"))
        & (F.col("_slice") == F.col("_of"))
        & (F.col("offset") >= F.col("_low"))
        & (F.col("offset") < F.col("_high"))
    )
    return sliced.join(cut, covered, "left_anti").select(*log.columns)
