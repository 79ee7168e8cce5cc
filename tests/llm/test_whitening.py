"""Whitening against numpy's eigenvectors and exact sums."""

import math

import numpy as np
import pytest

from tallyloom.llm import queries, whitening

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "vec_id long, embedding array<double>, label string, n long, component string, dims int, x string"


def plain(rows, components=16):
    """Rows of the operator, from one matrix: {(vec_id, position): [(component, deviation, |whitened|, explained)]}."""
    kept = [(i, key, tuple(math.floor(64 * c) + 1_000_000 for c in v)) for i, (key, v) in enumerate(rows) if v and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted({x for _, _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[(n * c - s) / n for c, s in zip(x, sums)] for x in fit])
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    order = np.argsort(-values)[:components]
    order = order[values[order] > 1e-9 * values.max()]
    out = {}
    for i, key, x in kept:
        y = np.array([(n * c - s) / n for c, s in zip(x, sums)])
        deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
        out[i] = (key, [(k + 1, n, deviation, abs(y @ vectors[:, j]) / math.sqrt(values[j]), values[j] / np.trace(cov)) for k, j in enumerate(order)])
    return out


def compare(df, rows):
    want = sorted((key, *row) for key, found in plain(rows).values() for row in found)
    got = sorted((r.vec_id, r.component, r.n, r.deviation, abs(r.whitened), r.explained) for r in df.collect())
    assert [g[:4] for g in got] == [w[:4] for w in want]
    np.testing.assert_allclose([g[4:] for g in got], [w[4:] for w in want], rtol=1e-6, atol=1e-8)
    assert all(r.identity_error <= 1e-9 for r in df.collect())


def test_query_equals_plain_rows(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()]
    compare(queries.QUERIES["op11_whitening"](spark, SF_DIR), rows)


def vectors(n=60, dims=5):
    rng = np.random.default_rng(4)
    mix = rng.normal(size=(dims, dims))
    return [(i, [float(c) for c in mix @ rng.normal(size=dims) * 3]) for i in range(n)]


def test_awkward_vectors(spark):
    """Nulls, non-finite entries, copies, repeated ids, other lengths and columns with the names of the result."""
    rows = vectors()
    rows += [rows[0]] * 40 + [(3, rows[7][1]), (900, None), (901, []), (902, [1.0, None, 0.0, 0.0, 0.0]), (903, [math.nan] * 5), (904, [math.inf, 0.0, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, "l", 5, "c", 1, "x") for i, v in [*rows, (905, [1.0, 2.0])]], SCHEMA).repartition(4)
    compare(whitening.whiten(df, whitening.fit(df)), rows)


def test_null_ids_stay_rows(spark):
    df = spark.createDataFrame([(None, v, "l", 5, "c", 1, "x") for _, v in vectors(30)], SCHEMA)
    assert whitening.whiten(df, whitening.fit(df)).filter("vec_id is null").count() == 30 * 5


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [0.5, 0.5])], [(1, [0.5, 0.5]), (2, [0.5, 0.5])]])
def test_tables_without_components(spark, rows):
    """No vector, or one distinct vector: no variance, no rows."""
    df = spark.createDataFrame([(i, v, "l", 5, "c", 1, "x") for i, v in rows], SCHEMA)
    found = whitening.whiten(df, whitening.fit(df))
    assert found.count() == 0
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def test_dependent_dimensions_give_fewer_components(spark):
    rows = [(i, [float(i % 7), float(i % 7) * 2, float(i % 3), 4.0]) for i in range(40)]
    df = spark.createDataFrame([(i, v, "l", 5, "c", 1, "x") for i, v in rows], SCHEMA)
    assert {r.component for r in whitening.whiten(df, whitening.fit(df)).select("component").distinct().collect()} == {1, 2}
    compare(whitening.whiten(df, whitening.fit(df)), rows)


def test_large_values_are_exact_or_null(spark):
    rows = [(1, [1e6, 2e5]), (2, [-1e6, 0.0]), (3, [3e6, 1e5])]
    df = spark.createDataFrame([(i, v, "l", 5, "c", 1, "x") for i, v in rows], SCHEMA)
    compare(whitening.whiten(df, whitening.fit(df)), rows)
    far = spark.createDataFrame([(1, [1e300, 2.0]), (2, [-1e300, 0.0])], "vec_id long, embedding array<double>")
    assert {r.deviation for r in whitening.whiten(far, whitening.fit(far)).collect()} == {None}


def test_factor_and_rotations():
    rng = np.random.default_rng(2)
    for dims, rank in ((1, 1), (2, 2), (7, 7), (8, 3), (33, 20)):
        x = rng.normal(size=(dims, rank)) * np.geomspace(1, 1e-3, rank)
        a = x @ x.T
        low = whitening.pivoted_cholesky(a)
        assert low.shape[1] == rank
        np.testing.assert_allclose(low @ low.T, a, atol=1e-12 * np.abs(a).max())
        values, axes = whitening.principal_axes(a)
        np.testing.assert_allclose(values, np.linalg.eigvalsh(a)[::-1][:rank], rtol=1e-8)
        np.testing.assert_allclose(axes @ axes.T, np.eye(rank), atol=1e-11)
    assert len(whitening.principal_axes(np.zeros((3, 3)))[0]) == 0
