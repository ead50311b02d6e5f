"""Embedding whitening: blockwise QR, a bidiagonal form, qd steps, twisted vectors.

Entries become whole numbers ``floor(1024 c) + 100000``, so counts, sums and
squared deviations are exact. Every task reduces its centred rows, a block at a
time, to one triangle by QR; triangles are merged in groups of sixteen until one
is left, whatever the number of rows. That triangle's singular values and
vectors, from ``bidiagonal``, are the components.

Defined results: rows whose vector is null, empty, or holds null or non-finite
entries are left out; so are vectors of another length than most have (of two
lengths as frequent the shorter counts). Entries beyond 2^52 / 1024 count as
that. Ids may be null or repeated: each row stands for itself. A deviation that
no long holds is null. Directions without variance are no components, so fewer
rows than that many dimensions, equal vectors, one row or none give fewer
results or none. Other columns are not carried.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logsync.llm.bidiagonal import largest_components

SCALE, SHIFT = 1024.0, 100_000
COMPONENTS = 8
# Numbers of a block that a task holds at a time.
BLOCK = 1 << 20
# Triangles of all tasks are merged by these numbers of groups, one after the other.
LEVELS = (4096, 256, 16, 1)
# A direction with less than this share of the largest variance has none: it is rounding.
RANK = 1e-24
_LARGEST = float(1 << 52)


class Whitening(NamedTuple):
    """``sums`` are whole numbers of any size; ``vectors`` holds components as columns."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def dimensions(self) -> int:
        return len(self.sums)


def usable(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """Rows whose vector is there and finite throughout."""
    finite = F.forall(column, lambda c: F.coalesce(F.abs(c.cast("double")) < F.lit(float("inf")), F.lit(False)))
    return vectors.where(F.col(column).isNotNull() & (F.size(column) > 0) & finite)


def _dimensions(rows: DataFrame, column: str) -> int:
    lengths = rows.groupBy(F.size(column).alias("d")).agg(F.count(F.lit(1)).alias("n"))
    first = lengths.orderBy(F.desc("n"), "d").first()
    return first["d"] if first else 0


def blocks(batches: Iterator[pa.RecordBatch], column: str, d: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of batches with their vectors as whole numbers, one row each."""
    rows = max(1, BLOCK // max(1, d))
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            part = batch.slice(at, rows)
            entries = part.column(part.schema.get_field_index(column)).flatten().cast(pa.float64())
            scaled = np.floor(SCALE * entries.to_numpy(zero_copy_only=False))
            whole = np.clip(scaled, -_LARGEST, _LARGEST).astype(np.int64) + SHIFT
            yield part, whole.reshape(-1, d)


def _sums(rows: DataFrame, column: str, d: int) -> tuple[int, list[int]]:
    """How many rows, and the exact sum of each dimension."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, x in blocks(batches, column, d):
            # Upper and lower halves, whose sums over a block fit.
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.arange(d, dtype=np.int32)),
                    pa.array(np.full(d, len(x), np.int64)),
                    pa.array((x >> 26).sum(axis=0)),
                    pa.array((x & ((1 << 26) - 1)).sum(axis=0)),
                ],
                names=["place", "n", "upper", "lower"],
            )

    parts = rows.select(column).mapInArrow(add, "place int, n long, upper long, lower long")
    exact = lambda c: F.sum(F.col(c).cast("decimal(38,0)")).alias(c)
    # A row for each dimension.
    totals = parts.groupBy("place").agg(exact("n"), exact("upper"), exact("lower")).orderBy("place").collect()
    n = int(totals[0]["n"]) if totals else 0
    return n, [(int(r["upper"]) << 26) + int(r["lower"]) for r in totals]


def _offsets(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n x - S``, exactly: as longs where they fit, else as Python's numbers."""
    largest = int(np.abs(x).max(initial=0)) * n + max(map(abs, sums), default=0)
    if largest < 1 << 62:
        return x * np.int64(n) - np.array(sums, np.int64)
    return x.astype(object) * n - np.array(sums, object)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``x - S/n``, rounded once."""
    offsets = _offsets(x, n, sums)
    return (offsets / n).astype(np.float64)


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    offsets = _offsets(x, n, sums)
    largest = int(np.abs(offsets).max(initial=0))
    if largest * largest * max(1, offsets.shape[1]) < 1 << 62:
        return (offsets * offsets).sum(axis=1).tolist()
    exact = [sum(int(c) ** 2 for c in row) for row in offsets]
    return [c if c < 1 << 63 else None for c in exact]


def _merged(parts: DataFrame, merge: Callable[[list[np.ndarray]], np.ndarray], d: int) -> DataFrame:
    """Triangles ``part, triangle`` merged to one; no task gets more than a share of a level."""

    def join(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("part").to_numpy(), kind="stable")
        held = table.column("triangle").to_pylist()
        out = merge([np.frombuffer(held[i]).reshape(-1, d) for i in order])
        return pa.table({"part": pa.array([int(table.column("group")[0].as_py())], pa.int32()), "triangle": [out.tobytes()]})

    for groups in LEVELS:
        grouped = parts.withColumn("group", F.pmod("part", F.lit(groups)))
        parts = grouped.groupBy("group").applyInArrow(join, "part int, triangle binary")
    return parts


def _reduced(triangles: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.vstack(triangles), mode="r")


def fit_whitening(vectors: DataFrame, column: str = "embedding", components: int = COMPONENTS) -> Whitening:
    """The largest components of the covariance of all usable rows."""
    rows = usable(vectors, column)
    d = _dimensions(rows, column)
    if not d:
        return Whitening(0, [], np.zeros(0), np.zeros((0, 0)), 0.0)
    rows = rows.where(F.size(column) == d).select(column)
    n, sums = _sums(rows, column, d)

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        triangle = np.zeros((0, d))
        for _, x in blocks(batches, column, d):
            triangle = _reduced([triangle, centred(x, n, sums)])
        if len(triangle):
            part = pa.array([TaskContext.get().partitionId()], pa.int32())
            yield pa.RecordBatch.from_arrays([part, pa.array([triangle.tobytes()])], names=["part", "triangle"])

    parts = rows.mapInArrow(reduce, "part int, triangle binary")
    # One triangle, of as many numbers as a vector has, squared.
    found = _merged(parts, _reduced, d).collect()
    triangle = np.zeros((d, d))
    if found:
        own = np.frombuffer(found[0]["triangle"]).reshape(-1, d)
        triangle[: len(own)] = own
    # The shares of columns add up to the trace; large entries are scaled away first.
    squares, directions = largest_components(triangle, min(components, d))
    kept = squares > RANK * max(float(squares.max(initial=0.0)), np.finfo(float).tiny)
    trace = float(np.square(triangle).sum()) / n
    return Whitening(n, sums, squares[kept] / n, directions[:, kept], trace)


def _projected(x: np.ndarray, model: Whitening) -> np.ndarray:
    return centred(x, model.n, model.sums) @ model.vectors / np.sqrt(model.values)


def whiten(vectors: DataFrame, model: Whitening, column: str = "embedding") -> DataFrame:
    """Usable rows of ``vec_id, <column>`` with ``deviation`` and ``whitened``, an array by component."""
    rows = usable(vectors, column).where(F.size(column) == model.dimensions)
    sent = rows.sparkSession.sparkContext.broadcast(model)
    kind = vectors.schema["vec_id"].dataType
    schema = T.StructType(
        [
            T.StructField("vec_id", kind),
            T.StructField("deviation", T.LongType()),
            T.StructField("whitened", T.ArrayType(T.DoubleType())),
        ]
    )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        k = len(own.values)
        for batch, x in blocks(batches, column, own.dimensions):
            flat = _projected(x, own).ravel()
            ends = pa.array(np.arange(0, len(x) * k + 1, k) if k else np.zeros(len(x) + 1), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(_deviations(x, own.n, own.sums), pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(flat)),
                ],
                names=["vec_id", "deviation", "whitened"],
            )

    return rows.select("vec_id", column).mapInArrow(score, schema)


def identity_error(vectors: DataFrame, model: Whitening, column: str = "embedding") -> float:
    """How far the covariance of the whitened fit rows is from the identity, at its worst entry."""
    k = len(model.values)
    if not k:
        return 0.0
    rows = usable(vectors, column).where(F.size(column) == model.dimensions).select(column)
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((k + 1, k))
        for _, x in blocks(batches, column, sent.value.dimensions):
            w = _projected(x, sent.value)
            total[:k] += w.T @ w
            total[k] += w.sum(axis=0)
        at = np.arange(total.size, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total.ravel())], names=["at", "total"])

    sums = rows.mapInArrow(products, "at int, total double").groupBy("at").agg(F.sum("total").alias("total"))
    total = np.zeros((k + 1) * k)
    # At most (k + 1) k rows.
    for row in sums.collect():
        total[row["at"]] = row["total"]
    total = total.reshape(k + 1, k) / model.n
    # Projections are of centred rows, so their mean is rounding, which goes too.
    covariance = total[:k] - np.outer(total[k], total[k])
    return float(np.abs(covariance - np.eye(k)).max())
