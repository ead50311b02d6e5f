"""Connected components of an edge table, by alternating star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logsync.session import run_folder


def _kept(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: lineage ends there."""
    path = run_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``: the smallest id reachable.

    Each round links all neighbours of a node to the smallest of them, first the
    larger ones, then the smaller ones; the rounds grow with the logarithm of
    the longest path. A node with many links costs no more than its links, whose
    minima are partial aggregates; edges stay distributed throughout.
    """
    pairs = edges.where("a <> b AND a IS NOT NULL AND b IS NOT NULL")
    pairs = _kept(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    while True:
        # Larger neighbours of every node go to its smallest neighbour.
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.where("b > a")
            .join(lowest, "a")
            .select(F.col("b").alias("a"), F.least("m", "a").alias("b"))
            .distinct()
        )
        # Smaller neighbours, and the node, go to the smallest.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        moved = large.join(low, "a")
        small = (
            moved.select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(low.select("a", F.col("m").alias("b")))
            .where("a <> b")
            .distinct()
        )
        after = _kept(small, "edges")
        # Done when every node hangs on one root, and no root on another.
        tops = after.select(F.col("b").alias("a")).distinct()
        loose = after.join(tops, "a", "left_semi").limit(1).count()
        crossed = after.groupBy("a").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count()
        pairs = after
        if not loose and not crossed:
            return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                pairs.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
