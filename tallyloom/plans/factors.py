"""Recommendation models by alternating least squares."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.plans.ratings import rmse
from tallyloom.session import checkpoint_folder

# The training parameters.
RANKS = (4, 8, 12)
ITERATIONS = 5
REGULARIZATION = 0.1
SEED = 5

_CHECKPOINT_EVERY = 2


def train(ratings: DataFrame, rank: int, blocks: int | None = None) -> ALSModel:
    """Factor the ratings; users and items must be integers of 32 bits, which Spark's ALS checks.

    Ratings are cut into ``blocks`` by user and by item (one per core by default,
    at least 10), which is the unit of work of the training. Factors are
    checkpointed on the shared folder, so a lost executor does not restart it.
    """
    spark = ratings.sparkSession
    checkpoint_folder(spark)
    return ALS(
        userCol="user_id",
        itemCol="item_id",
        ratingCol="rating",
        rank=rank,
        maxIter=ITERATIONS,
        regParam=REGULARIZATION,
        seed=SEED,
        coldStartStrategy="drop",
        checkpointInterval=_CHECKPOINT_EVERY,
        **dict.fromkeys(("numUserBlocks", "numItemBlocks"), blocks or max(10, spark.sparkContext.defaultParallelism)),
    ).fit(ratings)


def predict(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """Predictions for the pairs whose user and item were both seen in training."""
    return model.transform(pairs.select("user_id", "item_id")).select(
        "user_id", "item_id", F.col("prediction").cast("double").alias("prediction")
    )


def factor_table(model: ALSModel) -> DataFrame:
    """User and item factors as one table: side, id, features."""
    users = model.userFactors.select(F.lit("user").alias("side"), "id", "features")
    return users.unionByName(model.itemFactors.select(F.lit("item").alias("side"), "id", "features"))


def _wide(model: ALSModel, side: str) -> DataFrame:
    table = model.userFactors if side == "user" else model.itemFactors
    return table.select(F.col("id").cast("long").alias(f"{side}_id"), F.transform("features", lambda x: x.cast("double")).alias(f"_{side}"))


def _dot(left: str, right: str) -> Column:
    return F.aggregate(F.zip_with(left, right, lambda x, y: x * y), F.lit(0.0), lambda total, x: total + x)


def products(model: ALSModel, pairs: DataFrame) -> DataFrame:
    """The pairs with ``product``, the dot product of their two factor rows; others drop out."""
    known = pairs.join(_wide(model, "user"), "user_id").join(_wide(model, "item"), "item_id")
    return known.withColumn("product", _dot("_user", "_item")).drop("_user", "_item")


def user_residuals(model: ALSModel, ratings: DataFrame) -> DataFrame:
    """``user_id``, ``residual``: how far each user's factors are from solving their own least-squares equation.

    The last half-step of the training solves sum((u v - r) v) + regularisation * n * u = 0 for
    every user; the residual is the length of the left side, relative to the sum of the ratings.
    """
    joined = ratings.join(_wide(model, "user"), "user_id").join(_wide(model, "item"), "item_id")
    error = _dot("_user", "_item") - F.col("rating")
    sums = [F.sum(error * F.col("_item")[k]) + REGULARIZATION * F.count("*") * F.max(F.col("_user")[k]) for k in range(model.rank)]
    gradient = joined.groupBy("user_id").agg(F.sum("rating").alias("_total"), *[total.alias(f"_g{k}") for k, total in enumerate(sums)])
    length = F.sqrt(sum(F.col(f"_g{k}") * F.col(f"_g{k}") for k in range(model.rank)))
    return gradient.select("user_id", F.try_divide(length, F.col("_total")).alias("residual"))


@dataclass
class Selection:
    """The chosen model, its rank, and the error of every rank tried."""

    model: ALSModel
    rank: int
    errors: DataFrame


def select_rank(train_ratings: DataFrame, validation: DataFrame, ranks: Sequence[int] = RANKS) -> Selection:
    """Train one model per rank and keep the one with the smallest validation error, the first if equal."""
    spark = train_ratings.sparkSession
    models, errors = [], []
    for rank in ranks:
        model = train(train_ratings, rank)
        models.append(model)
        errors.append(rmse(predict(model, validation), validation).first().rmse)
    found = [error for error in errors if error is not None]
    best = errors.index(min(found)) if found else 0
    rows = [(rank, error, position == best) for position, (rank, error) in enumerate(zip(ranks, errors))]
    table = spark.createDataFrame(rows, "rank int, rmse double, best boolean")
    return Selection(models[best], ranks[best], table)
