"""Differences and pair counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left`` whose values do not occur in ``right``; repeats in ``left`` stay."""
    left_alias, right_alias = left.alias("_l"), right.alias("_r")
    same: Column | None = None
    for column in left.columns:
        equal = F.col(f"_l.{column}").eqNullSafe(F.col(f"_r.{column}"))
        same = equal if same is None else same & equal
    return left_alias.join(right_alias, same, "left_anti")


def without(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Rows of ``left`` that have no partner in ``right`` on the keys."""
    return left.join(right.select(*keys), list(keys), "left_anti")


def pair_space(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: how many (left, right) pairs exist, without building any of them."""
    pairs = left.agg(F.count("*").alias("left_rows"))
    return pairs.select(
        "left_rows", right.agg(F.count("*")).scalar().alias("right_rows")
    ).withColumn("pairs", F.col("left_rows") * F.col("right_rows"))


def block_pairs(
    left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str, block: int = 2000
) -> DataFrame:
    """Inner join on one key with evenly sized work, for keys that repeat on both sides.

    A frequent key on both sides makes one join group grow with the product of
    its sizes. Such a key is cut into blocks of about ``block`` rows per side and
    every pair of blocks becomes a join group of its own, so no group compares
    more than about ``block * block`` rows. Keys on one side only are dropped
    before the rows are moved. ``left_id`` and ``right_id`` spread the rows of a
    key over its blocks; names other than the key must differ between the sides.
    """
    left_sizes = left.groupBy(key).agg(F.count("*").alias("_left_n"))
    right_sizes = right.groupBy(key).agg(F.count("*").alias("_right_n"))
    cuts = left_sizes.join(right_sizes, key).select(
        key,
        F.ceil(F.col("_left_n") / block).alias("_left_cuts"),
        F.ceil(F.col("_right_n") / block).alias("_right_cuts"),
    )

    def every(cut_count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(cut_count) - 1))

    def own(row_id: str, cut_count: str) -> Column:
        return F.pmod(F.xxhash64(row_id), F.col(cut_count))

    cut_left = left.join(cuts, key).select(
        *left.columns, own(left_id, "_left_cuts").alias("_left_cut"), every("_right_cuts").alias("_right_cut")
    )
    cut_right = right.join(cuts, key).select(
        *right.columns, every("_left_cuts").alias("_left_cut"), own(right_id, "_right_cuts").alias("_right_cut")
    )
    return cut_left.join(cut_right, [key, "_left_cut", "_right_cut"]).drop("_left_cut", "_right_cut")


def bounded_pairs(
    left: DataFrame, right: DataFrame, key: str, left_id: str, right_id: str, left_bound: str, right_bound: str, least: float, block: int = 2000
) -> DataFrame:
    """Inner join on one key of the rows whose bounds, both positive, multiply to at least ``least``.

    The rows of a key are put in ranges of their bound, each range half an octave wide, and only the largest bound and the
    number of rows of every range are compared first: ranges that can't reach ``least`` together never meet, so no
    row is sent there and no pair of theirs exists. Ranges with many rows are cut as in :func:`block_pairs`.
    """

    def ranged(df: DataFrame, bound: str, name: str) -> DataFrame:
        return df.withColumn(name, F.floor(F.log2(bound) * 2))

    def ranges(df: DataFrame, bound: str, side: str) -> DataFrame:
        return df.groupBy(key, f"_{side}_range").agg(F.max(bound).alias(f"_{side}_max"), F.ceil(F.count("*") / block).alias(f"_{side}_cuts"))

    left, right = ranged(left, left_bound, "_left_range"), ranged(right, right_bound, "_right_range")
    meeting = ranges(left, left_bound, "left").join(ranges(right, right_bound, "right"), key).filter(F.col("_left_max") * F.col("_right_max") >= least)
    meeting = meeting.drop("_left_max", "_right_max")

    def every(cut_count: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(cut_count) - 1))

    def own(row_id: str, cut_count: str) -> Column:
        return F.pmod(F.xxhash64(row_id), F.col(cut_count))

    cut_left = left.join(meeting, [key, "_left_range"]).select(
        *left.columns, "_right_range", own(left_id, "_left_cuts").alias("_left_cut"), every("_right_cuts").alias("_right_cut")
    )
    cut_right = right.join(meeting, [key, "_right_range"]).select(
        *right.columns, "_left_range", every("_left_cuts").alias("_left_cut"), own(right_id, "_right_cuts").alias("_right_cut")
    )
    blocks = ["_left_range", "_right_range", "_left_cut", "_right_cut"]
    return cut_left.join(cut_right, [key, *blocks]).drop(*blocks).filter(F.col(left_bound) * F.col(right_bound) >= least)
