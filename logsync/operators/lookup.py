"""Joining a log with a small per-topic or per-partition table.

Logs are skewed on exactly these keys: a single topic-partition may hold a
third of all rows. Broadcasting the table avoids shuffling the log at all, but
only after its size was checked; a larger table is joined with salted keys, so
that no task receives a whole topic-partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# About the number of partitions of a very large cluster; such a table stays
# within some ten megabytes.
BROADCAST_ROWS = 200_000
# Up to this many rows become literals that a Parquet scan can use.
LITERAL_ROWS = 64
LEAST_SALTS = 64


def refuse_repeats(table: DataFrame, keys: Sequence[str], rows: Sequence[Row] | None) -> None:
    """Raise where two rows of a lookup table share a key.

    ``rows``: the whole table where it is at the driver already.
    """
    if rows is not None:
        found = [tuple(row[k] for k in keys) for row in rows]
        repeated = len(found) > len(set(found))
    else:
        counts = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        repeated = counts.where("_n > 1").limit(1).count() > 0
    if repeated:
        raise ValueError(f"a lookup table has several rows with the same {', '.join(keys)}")


def bounded_rows(table: DataFrame, limit: int) -> list[Row] | None:
    """All rows of ``table`` when there are at most ``limit``, else None."""
    rows = table.limit(limit + 1).collect()
    return rows if len(rows) <= limit else None


def local_table(
    spark: SparkSession, rows: Sequence[Sequence[Any]], schema: T.StructType
) -> DataFrame:
    """A few rows as a DataFrame the optimizer sees the content and size of."""
    arrow = to_arrow_schema(schema)
    columns = [pa.array([row[i] for row in rows], kind.type) for i, kind in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


def fits(table: DataFrame, limit: int = BROADCAST_ROWS) -> bool:
    """Whether ``table`` has at most ``limit`` rows; counts no further."""
    first = table.limit(limit + 1)
    # Rows already on the driver need no job to be counted.
    return (len(first.collect()) if table.isLocal() else first.count()) <= limit


def lookup_join(
    log: DataFrame,
    table: DataFrame,
    keys: Sequence[str],
    how: str = "inner",
    spread: Column | str = "offset",
    limit: int = BROADCAST_ROWS,
    salts: int | None = None,
) -> DataFrame:
    """Join ``log`` (large, skewed on ``keys``) with ``table`` (small).

    ``how`` is inner, left, left_semi or left_anti. ``spread`` is a log column
    that varies within a key; it decides the salt when the table is too large
    to broadcast; there are as many salts as shuffle partitions, 64 at least.
    """
    keys = list(keys)
    if fits(table, limit):
        return log.join(F.broadcast(table), keys, how)
    salts = salts or max(
        LEAST_SALTS, int(log.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    )
    column = F.col(spread) if isinstance(spread, str) else spread
    salted = log.withColumn("_salt", F.pmod(F.xxhash64(column), F.lit(salts)).cast("int"))
    copies = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies, [*keys, "_salt"], how).drop("_salt")
