"""Benchmark decontamination: SimHash over item-sized windows.

A window has as many words as a benchmark item, and lies where one of its word
shingles would lie in that item; any window that is similar to the item shares
a shingle with it, so no other place needs to be looked at. Windows and items
get a 64-bit SimHash of their shingles. Fingerprints within ``RADIUS`` bits of
each other agree in at least one of ``RADIUS + 1`` blocks, so an equi-join on
length, block and value finds all of them. What it finds is verified by exact
similarity of the shingles weighted by how often they occur: the sum of the
smaller counts over the sum of the larger ones.

Words are runs of letters, digits and non-ASCII signs in lower case; shingles
are their 64-bit hashes. Everything is built-in functions. Windows are found
once for each distinct text, however many copies it has.

Defined results: null and empty texts, items of fewer than ``WIDTH`` words and
null items match nothing; a text shorter than an item is one window; of items
with the same words the smallest id is named; repeated rows, and rows that
share an id, each bring their matches, of which equal ones are returned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logsync.llm.components import _kept
from logsync.llm.fingerprints import shingle_hashes

WIDTH = 5
SIMILARITY = 0.8
# Two windows of similarity 0.8 differ in ten bits on average, of 64.
RADIUS = 15
BLOCK_BITS = 4
# So many shingles, windows or fingerprints are broadcast: some dozen bytes each.
BROADCAST_ROWS = 500_000


_BETWEEN = r"[\x00-/:-@\[-`{-\x7f]+"
# From each word on, as many words as a shingle has.
_RUN = "(?<![^ ])(?=(" + " ".join(["[^ ]++"] * WIDTH) + "))"


def plain_words(text: Column) -> Column:
    low = F.lower(F.coalesce(text, F.lit("")))
    return F.filter(F.split(low, _BETWEEN), lambda w: w != "")


def word_runs(df: DataFrame) -> DataFrame:
    """``df(..., text)`` with a row for each shingle: its place ``at`` and hash ``run``; ``_n`` words in all.

    Runs are cut out of the text by one pattern, which takes a fraction of what
    arrays of words would.
    """
    plain = F.trim(F.regexp_replace(F.lower(F.coalesce("text", F.lit(""))), _BETWEEN, " "))
    others = [c for c in df.columns if c != "text"]
    return (
        df.withColumn("_plain", plain)
        .withColumn("_n", F.length("_plain") - F.length(F.replace("_plain", F.lit(" "), F.lit(""))) + 1)
        .select(*others, "_n", F.posexplode(F.regexp_extract_all("_plain", F.lit(_RUN), F.lit(1))).alias("at", "_run"))
        .select(*others, "_n", "at", F.xxhash64("_run").alias("run"))
    )


def with_shingles(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with ``_words`` (their hashes) and ``_shingles``."""
    return df.withColumn("_words", F.transform(plain_words(F.col(text)), lambda w: F.xxhash64(w))).withColumn(
        "_shingles", shingle_hashes(F.col("_words"), WIDTH)
    )


def simhash(shingles: Column) -> Column:
    """Bit by bit, what most of the shingles have, each as often as it occurs."""

    def bit(h: Column, b: Column) -> Column:
        return F.call_function("shiftright", h, b).bitwiseAND(F.lit(1))

    def most(b: Column) -> Column:
        ones = F.aggregate(shingles, F.lit(0), lambda acc, h: acc + bit(h, b).cast("int"))
        return F.when(2 * ones > F.size(shingles), F.call_function("shiftleft", F.lit(1).cast("bigint"), b)).otherwise(
            F.lit(0).cast("bigint")
        )

    bits = F.sequence(F.lit(0), F.lit(63))
    return F.aggregate(bits, F.lit(0).cast("bigint"), lambda acc, b: acc.bitwiseOR(most(b)))


def blocks(fingerprint: Column) -> Column:
    """Each block's number and value."""
    mask = F.lit((1 << BLOCK_BITS) - 1).cast("bigint")
    return F.array(
        *(
            F.struct(
                F.lit(k).alias("block"), F.shiftrightunsigned(fingerprint, k * BLOCK_BITS).bitwiseAND(mask).alias("value")
            )
            for k in range(RADIUS + 1)
        )
    )


def weighted_similarity(a: Column, b: Column) -> Column:
    """Shared occurrences over all occurrences of the shingles of two lists."""

    def times(of: Column, x: Column) -> Column:
        return F.size(F.filter(of, lambda y: y == x))

    shared = F.aggregate(
        F.array_distinct(a), F.lit(0), lambda acc, x: acc + F.least(times(a, x), times(b, x))
    )
    return shared / (F.size(a) + F.size(b) - shared)


def _sent(df: DataFrame) -> DataFrame:
    """Broadcast if small enough, which is counted."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def benchmark_items(benchmark: DataFrame) -> DataFrame:
    """``item_id, length, item_shingles, item_print``: one row for equal items."""
    rows = with_shingles(benchmark.where("item_id IS NOT NULL").select("item_id", "text"))
    long_enough = rows.where(F.size("_words") >= WIDTH)
    return (
        long_enough.groupBy(F.col("_shingles").alias("item_shingles"), F.size("_words").alias("length"))
        .agg(F.min("item_id").alias("item_id"))
        .withColumn("item_print", simhash(F.col("item_shingles")))
    )


def candidate_windows(keyed: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``_text, length, begin, doc_id``: windows that share a shingle in place with an item.

    ``doc_id`` is the smallest that has the text.
    """
    items = word_runs(benchmark.where("item_id IS NOT NULL").select("text"))
    places = items.select(F.col("_n").alias("length"), F.col("at").alias("item_at"), "run").distinct()
    begin = F.greatest(F.lit(0), F.least(F.col("at") - F.col("item_at"), F.col("_n") - F.col("length")))
    return (
        word_runs(keyed.select("doc_id", "_text", "text"))
        .join(_sent(places), "run")
        .select("_text", "length", begin.alias("begin"), "doc_id")
        .groupBy("_text", "length", "begin")
        .agg(F.min("doc_id").alias("doc_id"))
    )


def contaminated(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``doc_id, item_id, similarity, begin, length``: the best window of each pair.

    ``begin`` is a word's number; of equally similar windows the first counts.
    """
    items = _kept(benchmark_items(benchmark), "items")
    keyed = docs.select(F.col("doc_id").cast("long"), "text").withColumn("_text", F.xxhash64("text"))
    places = _kept(candidate_windows(keyed, benchmark), "places")
    at_text = places.groupBy("_text", F.col("doc_id").alias("_id")).agg(
        F.collect_set(F.struct("length", "begin")).alias("_places")
    )
    # All windows of a text: as many as it has words times lengths, at most.
    few = places.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    held = keyed.withColumnRenamed("_text", "_own").join(
        F.broadcast(at_text) if few else at_text, (F.col("_own") == F.col("_text")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    )
    windows = (
        with_shingles(held)
        .select("_text", "_shingles", F.explode("_places").alias("w"))
        .select(
            "_text",
            F.col("w.length").alias("length"),
            F.col("w.begin").alias("begin"),
            F.slice("_shingles", F.col("w.begin") + 1, F.greatest(F.lit(1), F.col("w.length") - WIDTH + 1)).alias("shingles"),
        )
        .withColumn("print", simhash(F.col("shingles")))
    )
    windows = _kept(windows, "windows")
    theirs = items.select("item_id", "length", "item_print", F.explode(blocks(F.col("item_print"))).alias("b"))
    pairs = (
        windows.select("_text", "length", "begin", "print", F.explode(blocks(F.col("print"))).alias("b"))
        .join(_sent(theirs), ["length", "b"])
        .where(F.bit_count(F.col("print").bitwiseXOR(F.col("item_print"))) <= RADIUS)
        .select("_text", "length", "begin", "item_id")
        .distinct()
    )
    best = (
        pairs.join(windows, ["_text", "length", "begin"])
        .join(_sent(items.select("item_id", "item_shingles")), "item_id")
        .withColumn("similarity", weighted_similarity(F.col("shingles"), F.col("item_shingles")))
        .where(F.col("similarity") >= similarity)
        .groupBy("_text", "item_id")
        .agg(F.max(F.struct("similarity", (-F.col("begin")).alias("back"), "length")).alias("best"))
    )
    matched = best.select(
        "_text", "item_id", "best.similarity", (-F.col("best.back")).cast("int").alias("begin"), "best.length"
    )
    return keyed.select("doc_id", "_text").distinct().join(matched, "_text").drop("_text").distinct()
