"""Rating averages, rankings, error measures and candidates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.matching import difference
from tallyloom.operators.ranking import rating_title_order, top_by


def item_stats(ratings: DataFrame) -> DataFrame:
    """Count and average of the ratings per item, in one pass."""
    return ratings.groupBy("item_id").agg(F.count("*").alias("n_ratings"), F.avg("rating").alias("mean_rating"))


def named_stats(ratings: DataFrame, items: DataFrame) -> DataFrame:
    """Item averages with titles; items without ratings drop out."""
    return item_stats(ratings).join(items, "item_id").select("item_id", "mean_rating", "title", "n_ratings")


def top_rated(ratings: DataFrame, items: DataFrame, n: int = 20, more_than: int = 500) -> DataFrame:
    """Best average among items with enough ratings, by rating and title descending."""
    enough = named_stats(ratings, items).filter(F.col("n_ratings") > more_than)
    return enough.orderBy(*rating_title_order("mean_rating", "title", descending=True), "item_id").limit(n)


def rmse(predicted: DataFrame, actual: DataFrame) -> DataFrame:
    """One row: root mean squared error over the (user, item) pairs found in both."""
    error = F.col("prediction") - F.col("rating")
    matched = predicted.select("user_id", "item_id", "prediction").join(
        actual.select("user_id", "item_id", "rating"), ["user_id", "item_id"]
    )
    return matched.agg(F.count("*").alias("n"), F.sqrt(F.avg(error * error)).alias("rmse"))


def mean_baseline(train: DataFrame, test: DataFrame) -> DataFrame:
    """One row: error of predicting the training mean for every test rating."""
    mean = train.agg(F.avg("rating")).scalar()
    error = F.col("rating") - F.col("_mean")
    return (
        test.withColumn("_mean", mean)
        .agg(F.count("*").alias("n"), F.max("_mean").alias("train_mean"), F.sqrt(F.avg(error * error)).alias("rmse"))
    )


def unrated_items(items: DataFrame, own_ratings: DataFrame, user_id: int) -> DataFrame:
    """(user, item) pairs for the items the user has not rated."""
    candidates = difference(items.select("item_id"), own_ratings.select("item_id"))
    return candidates.select(F.lit(user_id).alias("user_id"), "item_id")


def recommend(
    predicted: DataFrame, ratings: DataFrame, items: DataFrame, n: int = 20, more_than: int = 75
) -> DataFrame:
    """The best predictions among items with enough ratings, with titles."""
    counts = item_stats(ratings).select("item_id", "n_ratings").filter(F.col("n_ratings") > more_than)
    named = predicted.select("item_id", "prediction").join(counts, "item_id").join(items, "item_id")
    return top_by(named.select("item_id", "prediction", "title", "n_ratings"), n, "prediction", "item_id")
