"""Factor models for 64-bit ids and hot items."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tallyloom.plans import factors, ratings, wide_factors
from tallyloom.session import staged_tables, staging

TRIPLE = "user_id long, item_id long, rating double"
BIG = 1 << 40


@pytest.fixture(scope="module")
def rows():
    """Ratings of rank 3 with large and negative ids; the first item has a third of all, repeats included."""
    rng = np.random.default_rng(3)
    users, items = rng.normal(size=(60, 3)), rng.normal(size=(40, 3))
    score = 3 + users @ items.T * 0.6
    some = [(u * BIG - 7, i * BIG + 5, float(score[u, i])) for u in range(60) for i in range(40) if rng.random() < 0.5]
    return some + [(u * BIG - 7, 5, float(score[u, 0])) for u in range(60) for _ in range(len(some) // 120)]


def plain(rows, start, rank, iterations, regularization):
    """The same alternation, one user and item at a time."""
    users, items = {u: np.array(v) for u, v in start.items()}, {}
    for _ in range(iterations):
        for own, other, at in ((items, users, 1), (users, items, 0)):
            for key in {r[at] for r in rows}:
                mine = [(other[r[1 - at]], r[2]) for r in rows if r[at] == key]
                x, y = np.array([v for v, _ in mine]), np.array([s for _, s in mine])
                own[key] = np.linalg.solve(x.T @ x + regularization * len(y) * np.eye(rank), x.T @ y)
    return users, items


def test_sums_in_parts_equal_the_plain_alternation(spark, rows):
    df = spark.createDataFrame(rows, TRIPLE).repartition(7)
    before = staged_tables()
    tables = wide_factors.train_in_parts(df, 3, 4)
    assert staged_tables() == before + 2  # all but the last factors are released
    ids = spark.createDataFrame([(u,) for u in {r[0] for r in rows}], "id long")
    start = {r.id: r.f for r in ids.select("id", wide_factors.initial_features(3).alias("f")).collect()}
    users, items = plain(rows, start, 3, 4, factors.REGULARIZATION)
    for got, want in ((tables.users, users), (tables.items, items)):
        found = {r.id: r.features for r in got.collect()}
        assert found.keys() == want.keys()
        for key, value in want.items():
            np.testing.assert_allclose(found[key], value, rtol=1e-6, atol=1e-8)
    assert max(r.residual for r in wide_factors.user_residuals(tables, df).collect()) < 1e-12


def test_training_on_dense_numbers(spark, rows):
    df = spark.createDataFrame(rows, TRIPLE)
    tables = wide_factors.train_dense(df, 3, blocks=4)
    assert {r.id for r in tables.users.collect()} == {r[0] for r in rows}
    assert {r.id for r in tables.items.collect()} == {r[1] for r in rows}
    assert max(r.residual for r in wide_factors.user_residuals(tables, df).collect()) < 1e-4


def test_predictions_fit_and_unknown_ids_drop(spark, rows):
    df = spark.createDataFrame(rows, TRIPLE)
    tables = wide_factors.train_in_parts(df, 4, 6, 0.01)
    error = ratings.rmse(wide_factors.predict(tables, df.distinct()), df.distinct()).first()
    assert error.rmse < 0.3
    strange = spark.createDataFrame([(1, 5), (53, 2), (BIG - 7, 5)], "user_id long, item_id long")
    assert [(r.user_id, r.item_id) for r in wide_factors.predict(tables, strange).collect()] == [(BIG - 7, 5)]


def test_dense_ids_number_distinct_ids(spark):
    df = spark.createDataFrame([(3 * BIG,), (-BIG,), (3 * BIG,), (None,), (5,)], "user_id long")
    assert sorted((r.id, r.number) for r in wide_factors.dense_ids(df, "user_id").collect()) == [(-BIG, 0), (5, 1), (3 * BIG, 2)]


def test_nulls_and_no_ratings(spark):
    df = spark.createDataFrame([(None, 1, 2.0), (1, None, 2.0), (1, 1, None)], TRIPLE)
    tables = wide_factors.train_in_parts(df, 2, 1)
    assert tables.users.count() == tables.items.count() == 0


def test_ratings_stay_and_a_factor_goes_once_to_a_block(spark):
    """Each user rates 200 items: with a row of factors per rating, a half-step moves 200 a user."""
    rows = [(u * BIG, i * BIG - 1, float((u * i) % 5 + 1)) for u in range(300) for i in range(200)]
    with staging(spark):
        by_user, by_item, blocks = wide_factors.place_ratings(spark.createDataFrame(rows, TRIPLE).repartition(5))
        start = by_user.groupBy("block").applyInArrow(wide_factors._first_ids, "block int, id long")
        sent = start.collect()
        assert len({r.id for r in sent}) == 300
        assert len(sent) == len({(r.block, r.id) for r in sent}) <= 300 * blocks < len(rows) // 10
        step = by_item.groupBy("block").cogroup(
            start.select("block", "id", wide_factors.initial_features(2).alias("features")).mapInArrow(wide_factors._pack_factors, wide_factors._FACTORS).groupBy("block")
        ).applyInArrow(wide_factors._half_step(2, 0.1, blocks, True, None), wide_factors._FACTORS)
        plan = step._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1  # of the factors; the ratings stay


def test_ids_in_parts_give_the_plain_factors(spark, monkeypatch):
    """Two users and two items with most ratings, in several parts, repeated ratings among them."""
    rng = np.random.default_rng(9)
    some = [(int(u) * BIG, int(i) * BIG, float(r)) for u, i, r in zip(rng.integers(0, 90, 400), rng.integers(0, 70, 400), rng.integers(1, 6, 400))]
    hot = [(u * BIG, i * BIG, float(u % 5)) for i in (0, 1) for u in range(90)] + [(u * BIG, i * BIG, float(i % 4)) for u in (0, 1) for i in range(70)]
    rows = some + hot + hot[:50]
    df = spark.createDataFrame(rows, TRIPLE).repartition(3)
    for parts in (2, 1e-6):  # ids with more than 24 ratings are in parts; none
        monkeypatch.setattr(wide_factors, "_PARTS", parts)
        with staging(spark):
            tables = wide_factors.train_in_parts(df, 3, 2)
            ids = spark.createDataFrame([(u,) for u in {r[0] for r in rows}], "id long")
            start = {r.id: r.f for r in ids.select("id", wide_factors.initial_features(3).alias("f")).collect()}
            users, items = plain(rows, start, 3, 2, factors.REGULARIZATION)
            for got, want in ((tables.users, users), (tables.items, items)):
                found = [(r.id, r.features) for r in got.collect()]
                assert sorted(key for key, _ in found) == sorted(want)
                for key, value in found:
                    np.testing.assert_allclose(value, want[key], rtol=1e-6, atol=1e-8)


def test_placed_ratings_are_compressed(spark):
    """The JVM holds all rows of a block at once: 28 bytes a rating if they are plain."""
    rows = [(u * BIG, i * BIG - 1, float((u * i) % 5 + 1)) for u in range(300) for i in range(200)]
    with staging(spark):
        for side in wide_factors.place_ratings(spark.createDataFrame(rows, TRIPLE).coalesce(1))[:2]:
            stored = side.selectExpr("sum(length(own) + length(other) + length(to) + length(rating)) AS n").first().n
            assert stored < 14 * len(rows)


def test_values_come_back_from_bytes():
    rng = np.random.default_rng(4)
    some = [rng.integers(-(1 << 62), 1 << 62, n) for n in (0, 1, 1000)]
    column = pa.array([wide_factors._to_bytes(values) for values in some])
    assert [wide_factors._number(row) for row in column] == [0, 1, 1000]
    np.testing.assert_array_equal(wide_factors._from_bytes(column, np.int64), np.concatenate(some))
    vectors = rng.normal(size=(70, 3))
    np.testing.assert_array_equal(wide_factors._from_bytes(pa.array([wide_factors._to_bytes(vectors)]), np.float64), vectors.ravel())
    assert len(wide_factors._from_bytes(pa.array([], pa.binary()), np.int32)) == 0


def test_equations_are_solved_some_at_a_time(monkeypatch):
    x, y = np.random.default_rng(5).normal(size=(2, 20, 3))
    sums = np.column_stack([np.arange(1, 21), y, *[x[:, i] * x[:, j] + (i == j) for i, j in zip(*np.triu_indices(3))]])
    whole = wide_factors._solve(sums, 3, 0.1)
    monkeypatch.setattr(wide_factors, "_SOLVED", 7)
    np.testing.assert_allclose(wide_factors._solve(sums, 3, 0.1), whole)
    assert wide_factors._solve(sums[:0], 3, 0.1).shape == (0, 3)


def test_memory_of_a_full_block():
    """A block with as many ratings as it may have, of two thirds as many other ids, in rows as they are packed."""
    rng, n, blocks = np.random.default_rng(6), wide_factors._BLOCK_RATINGS, 16
    rows, others = [], []
    for k in range(0, n, 1 << 14):
        size = min(1 << 14, n - k)
        own, other = np.sort(rng.integers(0, n // 30, size)) * BIG, rng.integers(0, n, size) * BIG
        others.append(np.unique(other))
        columns = own, other, (other % 7919 % blocks).astype(np.int32), rng.integers(1, 6, size).astype(np.float64)
        rows.append((0, False, *map(wide_factors._to_bytes, columns)))
    names = {"block": pa.int32(), "split": pa.bool_(), "own": pa.binary(), "other": pa.binary(), "to": pa.binary(), "rating": pa.binary()}
    placed = pa.table({name: pa.array([row[k] for row in rows], kind) for k, (name, kind) in enumerate(names.items())})
    ids = np.unique(np.concatenate(others))
    given = wide_factors._factor_batch(wide_factors._factor_rows(0, 0, ids, rng.normal(size=(len(ids), 4))))
    assert placed.nbytes + given.nbytes < 64 << 20
    del rows, others, columns, own, other, ids
    tracemalloc.start()
    found = wide_factors._half_step(4, 0.1, blocks, True, None)(placed, given)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20
    assert found.num_rows
