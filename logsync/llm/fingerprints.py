"""Document fingerprints: bottom-k sketches of shingle hashes.

A fingerprint is the ``K`` smallest distinct 64-bit hashes of a text's word
shingles. The sketch of a whole is the smallest of its parts' hashes, so
sketches merge; from two of them come estimates of resemblance (Jaccard) and
containment, and from one the number of distinct shingles. With fewer than
``K`` shingles all estimates are exact.

Words are runs of signs between ASCII blanks, in lower case; a text of fewer
than ``WIDTH`` words is one shingle. Everything is built-in functions.

Defined results: null and empty texts, and those without words, have an empty
fingerprint; two empty ones resemble each other fully, and an empty one no
other; repeated rows have equal fingerprints.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from logsync.llm.components import _kept

K = 128
WIDTH = 5
# Ids that share a window; a group holds so many rows at most, ids being unique.
GROUP = 1024
BROADCAST_ROWS = 200_000


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(text), r"[ \t\n\u000B\f\r]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def shingle_hashes(hashes: Column, width: int = WIDTH) -> Column:
    """Hashes of all runs of ``width`` word hashes, or of the whole where it is shorter."""
    size = F.size(hashes) - width + 1
    shifted = [F.slice(hashes, i + 1, F.greatest(size, F.lit(0))).alias(f"w{i}") for i in range(width)]
    runs = F.transform(F.arrays_zip(*shifted), lambda x: F.xxhash64(*(x[f"w{i}"] for i in range(width))))
    short = F.array(F.xxhash64(hashes))
    return F.when(size >= 1, runs).when(F.size(hashes) > 0, short).otherwise(F.array().cast("array<bigint>"))


def bottom(hashes: Column, k: int = K) -> Column:
    """The sketch of some hashes: the ``k`` smallest distinct ones, ascending."""
    return F.slice(F.array_sort(F.array_distinct(hashes)), 1, k)


def with_sketch(df: DataFrame, text: str, name: str, k: int = K) -> DataFrame:
    """``df`` with the sketch of a text column.

    Each step is a column of its own, which the next reads more than once, so
    that the optimizer computes it once.
    """
    return (
        df.withColumn("_words", word_hashes(F.coalesce(F.col(text), F.lit(""))))
        .withColumn("_shingles", shingle_hashes(F.col("_words")))
        .withColumn(name, bottom(F.col("_shingles"), k))
        .drop("_words", "_shingles")
    )


def merged(a: Column, b: Column, k: int = K) -> Column:
    """The sketch of two parts taken together."""
    return bottom(F.concat(a, b), k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard similarity of the sketched sets."""
    both = F.size(merged(a, b, k))
    shared = F.size(F.array_intersect(merged(a, b, k), F.array_intersect(a, b)))
    return F.when(both == 0, F.lit(1.0)).otherwise(shared / both)


def distinct_shingles(a: Column, k: int = K) -> Column:
    """Estimated size of a sketched set; exact below ``k``."""
    # The largest kept hash, as a share of the whole range.
    reach = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / reach)


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of the first set that the second holds."""
    union = distinct_shingles(merged(a, b, k), k)
    share = resemblance(a, b, k) * union / distinct_shingles(a, k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.least(F.lit(1.0), share))


def as_text(sketch: Column) -> Column:
    """A sketch as hexadecimal digits, 16 for each hash."""
    return F.array_join(F.transform(sketch, lambda h: F.lpad(F.lower(F.hex(h)), 16, "0")), "")


def successors(ids: DataFrame, group: int = GROUP) -> DataFrame:
    """``id, next_id`` for distinct ids: the next larger, and the first after the last.

    Ids are ordered within groups of neighbours; where a group ends, the next
    one begins, and their order is found the same way, a level up. No window
    holds more than ``group`` ids.
    """
    # Towards zero, so that ids of both signs meet in the end.
    grouped = ids.select("id", (F.col("id") / group).cast("bigint").alias("grp"))
    inner = grouped.select("id", "grp", F.lead("id").over(W.partitionBy("grp").orderBy("id")).alias("next_id"))
    # A table for each level, a group's width smaller than the one below.
    heads = _kept(grouped.groupBy("grp").agg(F.min("id").alias("head")), "heads")
    known = inner.where("next_id IS NOT NULL").select("id", "next_id")
    last = inner.where("next_id IS NULL").select("id", "grp")
    if heads.limit(2).count() < 2:
        return known.unionByName(last.join(heads, "grp").select("id", F.col("head").alias("next_id")))
    after = successors(heads.select(F.col("grp").alias("id")), group)
    step = after.join(heads.select(F.col("grp").alias("next_id"), "head"), "next_id")
    ends = last.join(step.select(F.col("id").alias("grp"), "head"), "grp")
    return known.unionByName(ends.select("id", F.col("head").alias("next_id")))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with ``next_<column>`` of the next row, by ascending id and text.

    Rows go to groups of neighbouring ids once. The first row of each group is
    sent to the group before as well, as a guest, so that every row finds its
    successor in its own window. Rows without id have no successor.
    """
    rows = docs.where("doc_id IS NOT NULL").withColumn("_grp", F.floor(F.col("doc_id") / GROUP))
    ids = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").alias("id"))
    heads = ids.groupBy(F.floor(F.col("id") / GROUP).alias("grp")).agg(F.min("id").alias("head"))
    # One row for each group of ids.
    heads = _kept(heads, "heads")
    order = successors(heads.select(F.col("grp").alias("id")), GROUP)
    to = order.join(heads, order["next_id"] == heads["grp"]).select(
        F.col("id").alias("_to"), F.col("head").alias("_head")
    )
    small = to.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    guests = rows.join(F.broadcast(to) if small else to, F.col("doc_id") == F.col("_head"))
    guests = guests.withColumn("_grp", F.col("_to")).drop("_to", "_head").withColumn("_guest", F.lit(True))
    every = rows.withColumn("_guest", F.lit(False)).unionByName(guests)
    order_by = W.partitionBy("_grp").orderBy("_guest", "doc_id", F.col("text").asc_nulls_first())
    found = every.withColumns({f"next_{c}": F.lead(c).over(order_by) for c in columns})
    lone = docs.where("doc_id IS NULL").withColumns({f"next_{c}": F.lit(None).cast(docs.schema[c].dataType) for c in columns})
    return found.where(~F.col("_guest")).drop("_guest", "_grp").unionByName(lone)
