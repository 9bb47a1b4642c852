"""Whitening against numpy's eigenvectors of the whole covariance, on awkward vectors and degenerate tables."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from sonorum.llm import whitening
from sonorum.llm.common import materialize

MIDDLE = "/root/testdata/sf0.01"
KIND = "vec_id bigint, embedding array<float>"


def whole(rows):
    return np.array([[int(np.floor(64 * float(np.float32(c)))) + 1_000_000 for c in v] for v in rows], object)


def against(rows, got, most=32):
    """got: what components_of gave for the vectors `rows`, one or more rows for each vec_id."""
    x = whole(rows)
    n = len(x)
    sums = x.sum(axis=0)
    y = ((x * n - sums) / n).astype(np.float64)
    covariance = y.T @ y / n
    values, vectors = np.linalg.eigh(covariance)
    order = [k for k in np.argsort(-values) if values[k] > 1e-9 * values.max()][:most]
    want_w = y @ vectors[:, order] / np.sqrt(values[order])
    deviations = ((x * n - sums) ** 2).sum(axis=1)
    assert {r["component"] for r in got} == set(range(1, len(order) + 1))
    w = np.zeros((n, len(order)))
    for r in got:
        w[r["vec_id"], r["component"] - 1] = r["whitened"]
        assert r["deviation"] == deviations[r["vec_id"]] and r["n"] == n
        assert abs(r["explained"] / (values[order[r["component"] - 1]] / values.sum()) - 1) < 1e-10
        assert r["identity_error"] < 1e-10
    signs = np.sign((w * want_w).sum(axis=0))
    gaps = [min([abs(values[k] - v) for j, v in enumerate(values) if j != k], default=1) / values.max() for k in order]
    for k, gap in enumerate(gaps):
        if gap > 1e-6:
            assert np.abs(w[:, k] * signs[k] - want_w[:, k]).max() < 1e-9 / gap * 1e-2 + 1e-9
    return w


def test_table_against_eigenvectors(spark):
    rows = [v for (v,) in duckdb.sql(f"select embedding from '{MIDDLE}/embeddings.parquet' order by vec_id").fetchall()]
    ids = [i for (i,) in duckdb.sql(f"select vec_id from '{MIDDLE}/embeddings.parquet' order by vec_id").fetchall()]
    place = {i: k for k, i in enumerate(ids)}
    got = [r.asDict() | {"vec_id": place[r["vec_id"]]} for r in whitening.op11_whitening(spark, MIDDLE).collect()]
    assert len(got) == 32 * len(rows)
    against(rows, got)


def whitened(spark, rows, kind=KIND, **options):
    df = spark.createDataFrame(rows, kind)
    for name in ("x", "c", "k", "n", "dims", "count"):
        df = df.withColumn(name, F.lit("x"))
    numbers = materialize(whitening.whole_numbers(df), "vectors")
    return whitening.components_of(numbers, whitening.fit_whitening(numbers, **options)).collect()


def test_unusable_vectors_are_left_out(spark):
    rng = np.random.default_rng(2)
    good = rng.standard_normal((40, 5)).tolist()
    bad = [None, [1.0, None, 1.0, 1.0, 1.0], [float("nan")] * 5, [float("inf"), 0, 0, 0, 0], [float("-inf"), 0.0, 0.0, 0.0, 0.0], [], [1.0] * 4, [3e38] * 5]
    rows = [*enumerate(good), *((100 + k, [float(c) if c is not None else None for c in v] if v is not None else None) for k, v in enumerate(bad))]
    got = whitened(spark, rows)
    assert {r["vec_id"] for r in got} == set(range(40)) and len(got) == 200
    against(good, got)


def test_directions_without_variance_are_no_components(spark):
    rng = np.random.default_rng(3)
    base = rng.integers(-5, 6, (30, 2)).astype(float)
    rows = np.column_stack([base, base[:, 0] + base[:, 1], np.full(30, 7.0), base[:, 0]]).tolist()
    got = whitened(spark, list(enumerate(rows)))
    assert {r["component"] for r in got} == {1, 2}
    against(rows, got)


def test_equal_variances_keep_all_components(spark):
    """One distinct eigenvalue: every step ends in a closed space, and a new vector starts."""
    rows = [[float(s * (k == d)) for k in range(6)] for d in range(6) for s in (1, -1)]
    got = whitened(spark, list(enumerate(rows)))
    assert len(got) == 12 * 6 and all(abs(r["explained"] - 1 / 6) < 1e-12 and r["identity_error"] < 1e-12 for r in got)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [2.0, 3.0])], [(1, [2.0, 3.0]), (1, [2.0, 3.0]), (None, [2.0, 3.0])], [(1, [])]])
def test_tables_without_variance_have_no_rows(spark, rows):
    assert whitened(spark, rows) == []


def test_repeated_rows_null_ids_and_large_entries(spark):
    rows = [(None, [1e12, 2.0]), (1, [-1e12, 5.0]), (1, [-1e12, 5.0]), (2, [0.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    numbers = materialize(whitening.whole_numbers(df), "vectors")
    model = whitening.fit_whitening(numbers)
    x = np.array([[int(64 * c) + 1_000_000 for c in v] for _, v in rows], object)
    want = ((x * 4 - x.sum(axis=0)) ** 2).sum(axis=1).tolist()
    assert sorted(int(r["deviation"]) for r in whitening.whiten(numbers, model).collect()) == sorted(want)
    found = whitening.components_of(numbers, model).collect()
    assert len(found) == 8 and all(r["deviation"] is None for r in found) and found[0]["identity_error"] < 1e-4  # variances 10^23 apart


def test_bidiagonalisation_of_ill_conditioned_rows():
    rng = np.random.default_rng(5)
    u, _, v = np.linalg.svd(rng.standard_normal((300, 40)), full_matrices=False)
    values = np.geomspace(1e4, 1e-1, 40)
    x = u * values @ v
    right, b = whitening.bidiagonal(lambda h: (x.T @ (x @ h), float((x @ h) @ (x @ h))), 40, 10)
    assert np.abs(right.T @ right - np.eye(40)).max() < 1e-13
    assert np.abs(np.linalg.svd(b)[1] / values - 1).max() < 1e-8
    short, b = whitening.bidiagonal(lambda h: (x.T @ (x @ h), float((x @ h) @ (x @ h))), 40, 10, tolerance=1e-12)
    assert short.shape[1] < 40 and np.abs(np.linalg.svd(b)[1][:10] / values[:10] - 1).max() < 1e-10
