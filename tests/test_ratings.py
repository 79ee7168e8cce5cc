import numpy as np
import pytest

from tallyloom.operators.sampling import split_rows
from tallyloom.plans import factors, ratings

TRIPLE = "user_id int, item_id int, rating double"
PREDICTED = "user_id int, item_id int, prediction double"


def test_item_stats(spark):
    groups = {1: [1, 2, 3, 4], 100: [10.0, 20.0, 30.0], 110: range(20)}
    rows = [(user, item, float(value)) for item, values in groups.items() for user, value in enumerate(values)]
    stats = {r.item_id: (r.n_ratings, r.mean_rating) for r in ratings.item_stats(spark.createDataFrame(rows, TRIPLE)).collect()}
    assert stats == {1: (4, 2.5), 100: (3, 20.0), 110: (20, 9.5)}


def test_rmse(spark):
    predicted = [(1, 1, 5.0), (1, 2, 3.0), (1, 3, 4.0), (2, 1, 3.0), (2, 2, 2.0), (2, 3, 4.0)]
    actual = [(1, 2, 3.0), (1, 3, 5.0), (2, 1, 5.0), (2, 2, 1.0)]
    truth = spark.createDataFrame(actual, TRIPLE)

    def error(rows):
        return ratings.rmse(spark.createDataFrame(rows, PREDICTED), truth).first()

    assert abs(error(predicted).rmse - 1.22474487139) < 1e-8
    assert abs(error([(2, 2, 5.0), (1, 2, 5.0)]).rmse - 3.16227766017) < 1e-8
    assert error(actual).rmse == 0.0
    assert error([(9, 9, 1.0)]).rmse is None


def test_unrated_items(spark):
    items = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "item_id int, title string")
    own = spark.createDataFrame([(0, 2, 4.0)], TRIPLE)
    assert sorted((r.user_id, r.item_id) for r in ratings.unrated_items(items, own, 0).collect()) == [(0, 1), (0, 3)]


@pytest.fixture(scope="module")
def low_rank(spark):
    rng = np.random.default_rng(3)
    users, items = rng.normal(size=(120, 3)), rng.normal(size=(80, 3))
    score = np.clip(3 + users @ items.T * 0.6, 1, 5)
    rows = [(u, i, float(score[u, i])) for u in range(120) for i in range(80) if rng.random() < 0.5]
    return spark.createDataFrame(rows, TRIPLE)


def test_factors_beat_the_mean(spark, low_rank):
    train, validation, test = split_rows(low_rank, ["user_id", "item_id"], [6, 2, 2], 0)
    chosen = factors.select_rank(train, validation, (2, 4))
    table = chosen.errors.collect()
    assert [r.rank for r in table] == [2, 4] and sum(r.best for r in table) == 1
    best = min(table, key=lambda r: r.rmse)
    assert best.best and best.rank == chosen.rank
    error = ratings.rmse(factors.predict(chosen.model, test), test).first().rmse
    baseline = ratings.mean_baseline(train, test).first()
    assert error < 0.6 * baseline.rmse
    assert baseline.n == test.count()


def test_unknown_users_are_dropped_and_recommendations_ranked(spark, low_rank):
    items = low_rank.select("item_id").distinct().selectExpr("item_id", "concat('t', item_id) AS title")
    own = spark.createDataFrame([(999, i, 5.0) for i in range(10)], TRIPLE)
    model = factors.train(low_rank.unionByName(own), 3)
    assert factors.predict(model, spark.createDataFrame([(5000, 1)], "user_id int, item_id int")).count() == 0
    predicted = factors.predict(model, ratings.unrated_items(items, own, 999))
    top = ratings.recommend(predicted, low_rank, items, 20, 30).collect()
    assert len(top) == 20 and not {r.item_id for r in top} & set(range(10))
    assert [r.prediction for r in top] == sorted((r.prediction for r in top), reverse=True)
    assert all(r.n_ratings > 30 for r in top)
    sides = {r.side for r in factors.factor_table(model).collect()}
    assert sides == {"user", "item"}


def test_top_rated(spark):
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(30) for i in range(1, 9) if (u + i) % 3]
    items = spark.createDataFrame([(i, f"t{i}") for i in range(1, 9)], "item_id int, title string")
    top = ratings.top_rated(spark.createDataFrame(rows, TRIPLE), items, 3, 10).collect()
    keys = [(round(r.mean_rating, 3), r.title) for r in top]
    assert len(top) == 3 and keys == sorted(keys, reverse=True)


def test_user_factors_solve_their_equation(low_rank):
    model = factors.train(low_rank, 3)
    assert factors.user_residuals(model, low_rank).agg({"residual": "max"}).first()[0] < 1e-5
    pairs = low_rank.select("user_id", "item_id")
    products = {(r.user_id, r.item_id): r.product for r in factors.products(model, pairs).collect()}
    predicted = {(r.user_id, r.item_id): r.prediction for r in factors.predict(model, pairs).collect()}
    assert products.keys() == predicted.keys()
    assert all(abs(products[k] - predicted[k]) < 1e-4 for k in products)


def test_ids_beyond_32_bits_are_refused(spark):
    big = spark.createDataFrame([(2**31 + 1, 1, 3.0), (1, 2, 4.0)], "user_id long, item_id long, rating double")
    with pytest.raises(Exception):  # Spark says so on an executor
        factors.train(big, 2)
