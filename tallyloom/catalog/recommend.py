"""Ratings, rankings, errors, factor models and recommendations."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.registry import query
from tallyloom.catalog.tables import item_lines, items, rating_lines, ratings
from tallyloom.operators.counting import count_by
from tallyloom.operators.ranking import top_by
from tallyloom.operators.sampling import split_rows, with_split
from tallyloom.plans import factors, wide_factors
from tallyloom.plans import ratings as rated
from tallyloom.session import stage_table
from tallyloom.sources.ratings import parse_items, parse_ratings

# Shares of training, validation and test.
SPLIT_WEIGHTS, SPLIT_SEED = (6, 2, 2), 0
# Ratings an item needs: the given data has far fewer per item than a film has.
MANY, ENOUGH = 25, 20
USER, NEW_USER, NEW_RATINGS = 1, 0, 10

RATINGS = """
    WITH ratings AS (
      SELECT o_custkey AS user_id, l_partkey AS item_id,
             CAST(max(1 + CAST(l_quantity AS BIGINT) % 5) AS DOUBLE) AS rating
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2
    ), items AS (
      SELECT p_partkey AS item_id, p_name AS title FROM part
    ), stats AS (
      SELECT item_id, count(*) AS n_ratings, avg(rating) AS mean_rating FROM ratings GROUP BY 1
    ), marked AS (
      SELECT *, ('0x' || left(md5('0:' || user_id || ',' || item_id), 15))::BIGINT % 10 AS bucket FROM ratings
    ), train AS (SELECT * FROM marked WHERE bucket < 6), test AS (SELECT * FROM marked WHERE bucket >= 8)
"""


def _parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Training, validation and test ratings, staged with their part: every model reads them again, and the part is a hash per row."""
    staged = stage_table(with_split(ratings(spark, sf_dir), ["user_id", "item_id"], SPLIT_WEIGHTS, SPLIT_SEED))
    return [staged.filter(F.col("part") == index).drop("part") for index in range(len(SPLIT_WEIGHTS))]


@query(
    "ratings_parse",
    RATINGS
    + """
    SELECT CASE WHEN (user_id + item_id) % 101 = 0 THEN 0 ELSE 1 END AS parse_status,
           user_id, item_id,
           CASE WHEN (user_id + item_id) % 101 <> 0 THEN rating END AS rating
    FROM ratings
    """,
)
def ratings_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_ratings(rating_lines(spark, sf_dir)).drop("line")


@query("item_rating_stats", RATINGS + "SELECT item_id, n_ratings, round(mean_rating, 6) AS mean_rating FROM stats")
def item_rating_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rated.item_stats(ratings(spark, sf_dir)).withColumn("mean_rating", F.round("mean_rating", 6))


@query(
    "item_rating_names",
    RATINGS
    + """
    SELECT item_id, round(mean_rating, 6) AS mean_rating, title, n_ratings FROM stats JOIN items USING (item_id)
    """,
)
def item_rating_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    named = rated.named_stats(ratings(spark, sf_dir), items(spark, sf_dir))
    return named.withColumn("mean_rating", F.round("mean_rating", 6))


@query(
    "top_rated_items",
    RATINGS
    + f"""
    SELECT item_id, round(mean_rating, 6) AS mean_rating, title, n_ratings FROM stats JOIN items USING (item_id)
    WHERE n_ratings > {MANY}
    ORDER BY CAST(printf('%.3f', stats.mean_rating) AS DOUBLE) DESC, title DESC, item_id LIMIT 20
    """,
)
def top_rated_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = rated.top_rated(ratings(spark, sf_dir), items(spark, sf_dir), 20, MANY)
    return top.withColumn("mean_rating", F.round("mean_rating", 6))


@query(
    "split_counts",
    RATINGS
    + """
    SELECT CASE WHEN bucket < 6 THEN 0 WHEN bucket < 8 THEN 1 ELSE 2 END AS part, count(*) AS n
    FROM marked GROUP BY 1
    """,
)
def split_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(with_split(ratings(spark, sf_dir), ["user_id", "item_id"], SPLIT_WEIGHTS, SPLIT_SEED), "part")


@query(
    "rmse",
    RATINGS
    + """
    , means AS (SELECT item_id, avg(rating) AS prediction FROM train GROUP BY 1)
    SELECT count(*) AS n, round(sqrt(avg((prediction - rating) * (prediction - rating))), 6) AS rmse
    FROM test JOIN means USING (item_id)
    """,
)
def rmse_of_item_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, test = split_rows(ratings(spark, sf_dir), ["user_id", "item_id"], SPLIT_WEIGHTS, SPLIT_SEED)
    means = rated.item_stats(train).select("item_id", F.col("mean_rating").alias("prediction"))
    predicted = test.select("user_id", "item_id").join(means, "item_id")
    return rated.rmse(predicted, test).withColumn("rmse", F.round("rmse", 6))


@query(
    "mean_baseline_rmse",
    RATINGS
    + """
    , mean AS (SELECT avg(rating) AS train_mean FROM train)
    SELECT count(*) AS n, round(max(train_mean), 6) AS train_mean,
           round(sqrt(avg((rating - train_mean) * (rating - train_mean))), 6) AS rmse
    FROM test, mean
    """,
)
def mean_baseline_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, _, test = split_rows(ratings(spark, sf_dir), ["user_id", "item_id"], SPLIT_WEIGHTS, SPLIT_SEED)
    result = rated.mean_baseline(train, test)
    return result.select("n", F.round("train_mean", 6).alias("train_mean"), F.round("rmse", 6).alias("rmse"))


@query(
    "unrated_items",
    RATINGS
    + f"""
    SELECT CAST({USER} AS INTEGER) AS user_id, item_id FROM items
    WHERE item_id NOT IN (SELECT item_id FROM ratings WHERE user_id = {USER})
    """,
)
def unrated_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = ratings(spark, sf_dir).filter(F.col("user_id") == USER)
    return rated.unrated_items(items(spark, sf_dir), own, USER)


@query(
    "top_unrated_by_mean",
    RATINGS
    + f"""
    SELECT item_id, round(mean_rating, 6) AS prediction, title, n_ratings FROM stats JOIN items USING (item_id)
    WHERE n_ratings > {ENOUGH} AND item_id NOT IN (SELECT item_id FROM ratings WHERE user_id = {USER})
    ORDER BY mean_rating DESC, item_id LIMIT 20
    """,
)
def top_unrated_by_mean(spark: SparkSession, sf_dir: str) -> DataFrame:
    given, titles = ratings(spark, sf_dir), items(spark, sf_dir)
    candidates = rated.unrated_items(titles, given.filter(F.col("user_id") == USER), USER)
    means = rated.item_stats(given).select("item_id", F.col("mean_rating").alias("prediction"))
    top = rated.recommend(candidates.join(means, "item_id"), given, titles, 20, ENOUGH)
    return top.withColumn("prediction", F.round("prediction", 6))


# The factors themselves differ between engines, so the queries below say what a true model must satisfy, and SQL
# says for which rows. The functions of plans.factors return the values.
_CLOSE, _SOLVED = 1e-4, 1e-5
KNOWN = RATINGS + """
    , users AS (SELECT DISTINCT user_id FROM train), rated AS (SELECT DISTINCT item_id FROM train),
    validation AS (SELECT * FROM marked WHERE bucket >= 6 AND bucket < 8),
    own AS (SELECT item_id FROM (SELECT item_id, count(*) AS n FROM train GROUP BY 1 ORDER BY n DESC, item_id LIMIT {limit}))
""".replace("{limit}", str(NEW_RATINGS))


def _same(left: Column, right: Column) -> Column:
    return F.abs(left - right) <= _CLOSE


def _error_from_factors(model: ALSModel, actual: DataFrame) -> Column:
    """Root mean squared error over the dot products of the factors, as a value."""
    error = F.col("product") - F.col("rating")
    return factors.products(model, actual).agg(F.sqrt(F.avg(error * error))).scalar()


@query(
    "als_model_factors",
    KNOWN
    + f"""
    SELECT 'user' AS side, user_id AS id, {factors.RANKS[1]} AS n_factors, TRUE AS solved FROM users
    UNION ALL SELECT 'item', item_id, {factors.RANKS[1]}, NULL FROM rated
    """,
)
def als_model_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All users and items with their number of factors, and whether a user's factors solve that user's equation."""
    train, _, _ = _parts(spark, sf_dir)
    model = factors.train(train, factors.RANKS[1])
    residuals = factors.user_residuals(model, train).select(F.lit("user").alias("side"), F.col("user_id").alias("id"), "residual")
    table = factors.factor_table(model).select("side", F.col("id").cast("long").alias("id"), F.size("features").alias("n_factors"))
    return table.join(residuals, ["side", "id"], "left").select("side", "id", "n_factors", (F.col("residual") < _SOLVED).alias("solved"))


#: Makes ids that need more than 32 bits.
WIDE = 1 << 33


@query(
    "als_wide_ids",
    KNOWN
    + f"""
    SELECT 'user' AS side, user_id * {WIDE} AS id, {factors.RANKS[0]} AS n_factors, TRUE AS solved FROM users
    UNION ALL SELECT 'item', item_id * {WIDE}, {factors.RANKS[0]}, NULL FROM rated
    """,
)
def als_wide_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``als_model_factors``, for ids of more than 32 bits."""
    train, _, _ = _parts(spark, sf_dir)
    wide = stage_table(train.select((F.col("user_id") * WIDE).alias("user_id"), (F.col("item_id") * WIDE).alias("item_id"), "rating"))
    return _solved(wide_factors.train_dense(wide, factors.RANKS[0]), wide, _SOLVED)


@query(
    "als_in_parts",
    KNOWN
    + f"""
    SELECT 'user' AS side, user_id * {WIDE} AS id, {factors.RANKS[0]} AS n_factors, TRUE AS solved FROM users
    UNION ALL SELECT 'item', item_id * {WIDE}, {factors.RANKS[0]}, NULL FROM rated
    UNION ALL SELECT 'item', -1, {factors.RANKS[0]}, NULL FROM (SELECT 1 FROM train WHERE (user_id + item_id) % 2 = 0 LIMIT 1)
    """,
)
def als_in_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Factors from equations that are summed in parts; one more item has about a third of all ratings."""
    train, _, _ = _parts(spark, sf_dir)
    hot = train.filter((F.col("user_id") + F.col("item_id")) % 2 == 0)
    wide = train.select((F.col("user_id") * WIDE).alias("user_id"), (F.col("item_id") * WIDE).alias("item_id"), "rating").unionByName(
        hot.select((F.col("user_id") * WIDE).alias("user_id"), F.lit(-1).cast("long").alias("item_id"), "rating")
    )
    return _solved(wide_factors.train_in_parts(wide, factors.RANKS[0]), wide, 1e-9)


def _solved(tables: wide_factors.FactorTables, ratings: DataFrame, least: float) -> DataFrame:
    """All users and items with their number of factors, and whether a user's factors solve that user's equation."""
    users = tables.users.join(wide_factors.user_residuals(tables, ratings).withColumnRenamed("user_id", "id"), "id", "left")
    sides = [users.select(F.lit("user").alias("side"), "id", F.size("features").alias("n_factors"), (F.col("residual") < least).alias("solved"))]
    sides.append(tables.items.select(F.lit("item").alias("side"), "id", F.size("features").alias("n_factors"), F.lit(None).cast("boolean").alias("solved")))
    return sides[0].unionByName(sides[1])


@query(
    "als_predictions",
    KNOWN
    + """
    SELECT user_id, item_id, TRUE AS is_product FROM validation
    WHERE user_id IN (SELECT user_id FROM users) AND item_id IN (SELECT item_id FROM rated)
    """,
)
def als_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs that get a prediction, and whether it is the dot product of their factors."""
    train, validation, _ = _parts(spark, sf_dir)
    model = factors.train(train, factors.RANKS[1])
    products = factors.products(model, validation.select("user_id", "item_id"))
    found = factors.predict(model, validation).join(products, ["user_id", "item_id"], "left")
    return found.select(F.col("user_id").cast("long").alias("user_id"), F.col("item_id").cast("long").alias("item_id"), F.coalesce(_same(F.col("prediction"), F.col("product")), F.lit(False)).alias("is_product"))


@query(
    "als_model_selection",
    KNOWN
    + f"""
    SELECT unnest({list(factors.RANKS)}) AS rank, n, TRUE AS first_smallest FROM (
      SELECT count(*) AS n FROM validation
      WHERE user_id IN (SELECT user_id FROM users) AND item_id IN (SELECT item_id FROM rated)
    )
    """,
)
def als_model_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ranks tried, the pairs scored, and whether ``best`` marks the first smallest error."""
    train, validation, _ = _parts(spark, sf_dir)
    chosen = factors.select_rank(train, validation)
    scored = rated.rmse(factors.predict(chosen.model, validation), validation).select("n").scalar()
    least = chosen.errors.agg(F.min(F.struct("rmse", "rank")).alias("m")).select("m.rank").scalar()
    return chosen.errors.select("rank", scored.alias("n"), (F.col("best") == (F.col("rank") == least)).alias("first_smallest"))


@query(
    "als_test_rmse",
    KNOWN
    + """
    SELECT count(*) AS n, TRUE AS rmse_is_right FROM test
    WHERE user_id IN (SELECT user_id FROM users) AND item_id IN (SELECT item_id FROM rated)
    """,
)
def als_test_rmse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs scored by the chosen model, and whether their error is that of its factors."""
    train, validation, test = _parts(spark, sf_dir)
    chosen = factors.select_rank(train, validation)
    error = rated.rmse(factors.predict(chosen.model, test), test)
    return error.select("n", _same(F.col("rmse"), _error_from_factors(chosen.model, test)).alias("rmse_is_right"))


def _new_user_ratings(given: DataFrame) -> DataFrame:
    """A new user's ratings: the most rated items, each at the rounded average."""
    liked = top_by(rated.item_stats(given), NEW_RATINGS, "n_ratings", "item_id")
    return liked.select(
        F.lit(NEW_USER).cast("long").alias("user_id"), "item_id", F.round("mean_rating", 0).alias("rating")
    )


@query(
    "retrain_with_user",
    KNOWN
    + """
    SELECT count(*) AS n, (SELECT count(*) FROM own) AS added, TRUE AS rmse_is_right FROM test
    WHERE user_id IN (SELECT user_id FROM users) AND item_id IN (SELECT item_id FROM rated)
    """,
)
def retrain_with_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``als_test_rmse`` for a model that has also seen a new user's ratings."""
    train, _, test = _parts(spark, sf_dir)
    own = stage_table(_new_user_ratings(train))
    model = factors.train(train.unionByName(own), factors.RANKS[1])
    error = rated.rmse(factors.predict(model, test), test).withColumn("added", own.agg(F.count("*")).scalar())
    return error.select("n", "added", _same(F.col("rmse"), _error_from_factors(model, test)).alias("rmse_is_right"))


@query(
    "top_unrated",
    KNOWN
    + f"""
    , candidates AS (
      SELECT item_id FROM train WHERE item_id NOT IN (SELECT item_id FROM own) AND item_id IN (SELECT item_id FROM items)
      GROUP BY 1 HAVING count(*) > {ENOUGH // 2}
    )
    SELECT count(*) AS candidates, least(count(*), 20) AS listed, TRUE AS is_head FROM candidates
    """,
)
def top_unrated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items that could be recommended to the new user, and whether the listed ones are the best by their factors."""
    train, _, _ = _parts(spark, sf_dir)
    own, titles = stage_table(_new_user_ratings(train)), items(spark, sf_dir)
    model = factors.train(train.unionByName(own), factors.RANKS[1])
    unrated = stage_table(rated.unrated_items(titles, own, NEW_USER).withColumn("user_id", F.col("user_id").cast("long")))
    top = stage_table(rated.recommend(factors.predict(model, unrated), train, titles, 20, ENOUGH // 2))
    counts = rated.item_stats(train).select("item_id", "n_ratings").filter(F.col("n_ratings") > ENOUGH // 2)
    scored = factors.products(model, unrated).join(counts, "item_id").join(top.select("item_id", "prediction"), "item_id", "left")
    least_listed = F.min(F.when(F.col("prediction").isNotNull(), F.col("product")))
    best_other = F.max(F.when(F.col("prediction").isNull(), F.col("product")))
    wrong = F.count_if(~_same(F.col("prediction"), F.col("product")))
    return scored.agg(
        F.count("*").alias("candidates"), F.count("prediction").alias("listed"),
        ((wrong == 0) & F.coalesce(least_listed >= best_other - _CLOSE, F.lit(True))).alias("is_head"),
    )


@query(
    "items_parse",
    """
    SELECT CASE WHEN p_partkey % 97 = 5 THEN 0 ELSE 1 END AS parse_status, p_partkey AS item_id,
           CASE WHEN p_partkey % 97 <> 5 THEN p_name END AS title FROM part
    """,
)
def items_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_items(item_lines(spark, sf_dir)).drop("line")
