"""The solver against LAPACK, and whitened tables against covariances worked out whole."""

from __future__ import annotations

import math
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from logsync.llm import bidiagonal as bd
from logsync.llm import whitening as wh
from logsync.llm.queries import QUERIES

VECTORS = "vec_id long, embedding array<float>, label int"


def triangle(a):
    d = a.shape[1]
    r = np.linalg.qr(a - a.mean(axis=0), mode="r")
    return np.vstack([r, np.zeros((d - len(r), d))])


def some_matrices():
    chance = np.random.default_rng(4)
    turn = lambda d: np.linalg.qr(chance.normal(size=(d, d)))[0]
    ties = np.diag([5, 5, 5, 3, 3, 1 + 1e-9, 1, 1, 0.5, 0.5] + [0.1] * 6)
    return {
        "random": chance.normal(size=(300, 40)),
        "graded": chance.normal(size=(300, 24)) * np.logspace(0, -7, 24),
        "graded backwards": chance.normal(size=(300, 24)) * np.logspace(-7, 0, 24),
        "ties": np.vstack([ties, -ties]) @ turn(16),
        "equal": np.vstack([np.eye(12), -np.eye(12)]),
        "few rows": chance.normal(size=(5, 30)),
        "one column": chance.normal(size=(9, 1)),
        "two columns": chance.normal(size=(9, 2)),
        "a zero column": chance.normal(size=(50, 6)) * [1, 0, 2, 1, 0, 3],
        "equal columns": np.repeat(chance.normal(size=(50, 3)), 2, axis=1),
        "nothing": np.zeros((4, 5)),
    }


@pytest.mark.parametrize("name", list(some_matrices()))
def test_singular_values_and_vectors(name):
    r = triangle(some_matrices()[name])
    d = r.shape[1]
    true = np.linalg.svd(r, compute_uv=False) ** 2
    largest = max(true[0], 1e-300)
    diagonal, above, _ = bd.bidiagonalised(r)
    found = bd.squared_singular_values(diagonal, above)
    assert np.abs(found - true).max() <= 1e-13 * largest
    # Differential steps keep relative accuracy, as far as the other solver has it.
    sure = true > 1e-8 * largest
    assert np.all(np.abs(found - true)[sure] <= 1e-10 * true[sure])
    values, vectors = bd.largest_components(r, 8)
    k = min(8, d)
    assert vectors.shape == (d, k)
    assert np.abs(vectors.T @ vectors - np.eye(k)).max() < 1e-11
    assert np.abs(r.T @ (r @ vectors) - vectors * values).max() <= 1e-12 * largest


def brute(rows):
    """Whole numbers, exact deviations and components of the usable rows, by another solver."""
    finite = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    lengths = defaultdict(int)
    for _, v in finite:
        lengths[len(v)] += 1
    d = min(lengths, key=lambda k: (-lengths[k], k))
    kept = [(i, [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v]) for i, v in finite if len(v) == d]
    n, sums = len(kept), [sum(c) for c in zip(*(x for _, x in kept))]
    deviations = [sum((n * c - s) ** 2 for c, s in zip(x, sums)) for _, x in kept]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for _, x in kept])
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return [i for i, _ in kept], deviations, centred, values[::-1], vectors[:, ::-1]


def check(out, rows, components=8):
    ids, deviations, centred, values, vectors = brute(rows)
    found = defaultdict(list)
    for r in out:
        found[r["vec_id"], r["component"]].append((r["whitened"], r["deviation"], r["n"], r["explained"]))
    assert len(out) == len(ids) * components
    for k in range(components):
        mine = [found[i, k + 1] for i in ids]
        assert all(len(m) == 1 and m[0][2] == len(ids) for m in mine)
        assert [m[0][1] for m in mine] == deviations
        assert np.allclose([m[0][3] for m in mine], values[k] / values.sum(), rtol=1e-10)
        whitened = np.array([m[0][0] for m in mine])
        true = centred @ vectors[:, k] / np.sqrt(values[k])
        assert min(np.abs(whitened - true).max(), np.abs(whitened + true).max()) < 1e-8
    assert {r["identity_error"] for r in out} and all(r["identity_error"] < 1e-9 for r in out)


def test_the_query_equals_other_solvers(spark, sf_dir):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    check(QUERIES["op13_whitening"](spark, sf_dir).collect(), rows)


def whitened(spark, tmp_path, rows, schema=VECTORS):
    frame = spark.createDataFrame([(i, v, 0) for i, v in rows], schema)
    frame.withColumns({c: F.lit("x") for c in ("place", "whitened", "deviation", "n", "component")}).write.parquet(
        f"{tmp_path}/embeddings.parquet"
    )
    return QUERIES["op13_whitening"](spark, str(tmp_path)).collect()


def test_odd_vectors_are_left_out(spark, tmp_path):
    chance = np.random.default_rng(2)
    rows = [(i, chance.normal(size=9).astype(np.float32).tolist()) for i in range(60)]
    rows += [(100, rows[0][1]), (101, rows[0][1])]
    odd = [
        (200, None), (201, []), (202, [None] * 9), (203, [float("nan"), *[1.0] * 8]),
        (204, [float("inf"), *[1.0] * 8]), (205, [1.0] * 8 + [float("-inf")]), (206, [1.0, 2.0]), (207, [0.5] * 10),
    ]
    out = whitened(spark, tmp_path, rows + odd)
    check(out, rows + odd)
    same = {r["vec_id"]: r["whitened"] for r in out if r["component"] == 1}
    assert same[0] == same[100] == same[101] and not set(same) & {i for i, _ in odd}


def test_null_and_repeated_ids_are_rows_of_their_own(spark, tmp_path):
    chance = np.random.default_rng(3)
    rows = [(None if i % 3 else 7, chance.normal(size=4).tolist()) for i in range(30)]
    out = whitened(spark, tmp_path, rows)
    assert len(out) == 30 * 4 and {r["n"] for r in out} == {30}
    assert sum(r["vec_id"] is None for r in out) == 20 * 4


def test_directions_without_variance_are_no_components(spark, tmp_path):
    chance = np.random.default_rng(6)
    rows = [(i, [*chance.normal(size=3).tolist(), 2.0, 2.0]) for i in range(20)]
    out = whitened(spark, tmp_path / "flat", rows)
    assert {r["component"] for r in out} == {1, 2, 3}
    assert all(r["identity_error"] < 1e-9 for r in out)
    assert whitened(spark, tmp_path / "equal", [(i, [1.0, 2.0]) for i in range(5)]) == []
    assert whitened(spark, tmp_path / "one", [(1, [1.0, 2.0])]) == []
    assert whitened(spark, tmp_path / "none", []) == []
    assert whitened(spark, tmp_path / "nulls", [(1, None), (2, None)]) == []


def test_large_entries_stay_exact(spark, tmp_path):
    rows = [(i, [1e9 * i, float(i % 5)]) for i in range(40)] + [(99, [1e300, 1.0])]
    out = whitened(spark, tmp_path, rows, VECTORS.replace("float", "double"))
    x = [[min(math.floor(1024 * c), 1 << 52) + 100_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    true = {i: sum((n * c - s) ** 2 for c, s in zip(own, sums)) for (i, _), own in zip(rows, x)}
    for r in out:
        assert r["deviation"] == (true[r["vec_id"]] if true[r["vec_id"]] < 1 << 63 else None)


def test_triangles_of_many_tasks_merge_to_the_same_components(spark, sf_dir):
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    one, many = wh.fit_whitening(vectors.coalesce(1)), wh.fit_whitening(vectors.repartition(37))
    assert one.n == many.n and one.sums == many.sums
    assert np.allclose(one.values, many.values, rtol=1e-12)
    assert np.allclose(one.vectors, many.vectors, atol=1e-10)
