"""Counts, sums, shares, histograms and grouped lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.numbers import int_quotient
from tallyloom.operators.indexing import with_global_index


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n"))


def count_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Rows per key. Counted within each partition before the shuffle."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def distinct_count(df: DataFrame, column: str, name: str = "n") -> DataFrame:
    return df.agg(F.count_distinct(F.col(column)).alias(name))


def distinct_count_by(df: DataFrame, key: str | Column, column: str, name: str = "n") -> DataFrame:
    """Distinct values per key.

    Spark shuffles on key and value together first, so a key with most of the
    rows is spread over all tasks.
    """
    return df.groupBy(key).agg(F.count_distinct(F.col(column)).alias(name))


def rows_per_distinct(df: DataFrame, key: str | Column, column: str, name: str) -> DataFrame:
    """Rows divided by distinct values per key, rounded down."""
    return df.groupBy(key).agg(int_quotient(F.count("*"), F.count_distinct(F.col(column))).alias(name))


def integer_stats(df: DataFrame, column: str) -> DataFrame:
    """One row: integer average, minimum and maximum of an integer column."""
    value = F.col(column)
    return df.agg(
        int_quotient(F.sum(value), F.count(value)).alias("average"),
        F.min(value).alias("minimum"),
        F.max(value).alias("maximum"),
    )


def share_of_total(counts: DataFrame, n: str = "n", name: str = "share") -> DataFrame:
    """Each group's part of the total over all groups."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn(name, F.try_divide(F.col(n), total))


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Equal-width bins between minimum and maximum; the last one is closed, empty ones count 0."""
    values = df.select(F.col(column).alias("_value")).filter(F.col("_value").isNotNull())
    # One struct, so that the input is read once for both ends.
    ends = values.agg(F.struct(F.min("_value").alias("low"), F.max("_value").alias("high")))
    width = (F.col("_ends.high") - F.col("_ends.low")) / F.lit(bins)
    place = F.floor(F.coalesce(F.try_divide(F.col("_value") - F.col("_ends.low"), width), F.lit(0.0)))
    ranged = values.withColumn("_ends", ends.scalar())
    counted = count_by(ranged.select(F.least(F.lit(bins - 1), place).cast("int").alias("bin")), "bin")
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return all_bins.join(counted, "bin", "left").select("bin", F.coalesce("n", F.lit(0)).alias("n"))


def grouped_lists(df: DataFrame, key: str, value: str, size: int = 1000) -> DataFrame:
    """All values per key in order, as consecutive lists of at most ``size`` values.

    A key may hold a large part of all rows, so its values are never gathered in
    one place: rows get their place in the global order first, and each list is
    built by whichever task owns that (key, list) pair. The first place of a key is
    joined by key and part of the order, so a key in many parts is in many tasks.
    """
    placed = with_global_index(df.select(key, value), key, value, name="_place", part="_part")
    # One row per key and part; the parts of a key are counted, not its rows.
    starts = placed.groupBy(key, "_part").agg(F.min("_place").alias("_from")).select(
        F.col(key).alias("_key"), F.col("_part").alias("_in"), F.min("_from").over(Window.partitionBy(key)).alias("_start")
    )
    place = F.col("_place") - F.col("_start")
    return (
        placed.join(starts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_in")))
        .select(key, F.call_function("div", place, F.lit(size)).alias("list_no"), "_place", value)
        .groupBy(key, "list_no")
        .agg(F.sort_array(F.collect_list(F.struct("_place", value))).alias("_items"))
        .select(key, "list_no", F.col("_items").getField(value).alias("items"))
    )
