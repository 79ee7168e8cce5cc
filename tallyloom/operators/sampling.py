"""Repeatable samples and splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.numbers import hash_bucket, hash_long, hash_text


_HASH_BITS = 60
#: Rows that the tasks' own best ones are merged for; larger samples are bounded first.
_MERGED = 100_000
#: Bits of a hash by which it is counted in each of two rounds: at most 2^16 counts reach the driver per round.
_SKETCH_BITS = 16


def sample_rows(df: DataFrame, key: str, n: int, seed: int, merged: int = _MERGED) -> DataFrame:
    """Exactly ``n`` rows (or all) without replacement: those with the smallest key hashes.

    ``key`` must identify a row and not be null. The result does not depend on the partitions. Up to ``merged`` rows are the smallest ones
    of every task, merged. For larger samples nothing is sorted as a whole: two rounds of counts by the leading bits
    of the hashes find the range of hashes, about one in 2^32 of all, in which the sample ends. All rows below
    it are taken as they are, and only the rows inside it are sorted.
    """
    order = [hash_text(F.col(key), seed), F.col(key)]
    if n <= merged:
        return df.orderBy(*order).limit(n)
    hashed = df.withColumn("_hash", hash_long(F.col(key), seed))
    below, left, shift = 0, n, _HASH_BITS
    for _ in range(2):
        # ``left`` rows are wanted from hashes of at least ``below``; the range that the last of them is in comes next.
        inside = hashed if shift == _HASH_BITS else hashed.filter((F.col("_hash") >= below) & (F.col("_hash") < below + (1 << shift)))
        shift -= _SKETCH_BITS
        counts = inside.groupBy(F.shiftright("_hash", shift).alias("range")).agg(F.count("*").alias("n")).collect()
        for place, rows in sorted(map(tuple, counts)):
            if rows >= left:
                below = place << shift
                break
            left -= rows
        else:  # no more rows than wanted
            return df
    whole = hashed.filter(F.col("_hash") < below).select(*df.columns)
    last = hashed.filter((F.col("_hash") >= below) & (F.col("_hash") < below + (1 << shift)))
    return whole.unionByName(last.orderBy(*order).limit(left).select(*df.columns))


#: Bits of a key's hash that choose its coarse bucket, and rows wanted in a fine one.
_COARSE_BITS, _FINE_ROWS = 12, 1000


def sample_with_replacement(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` independent draws of a row; the same row may be drawn again.

    A draw is a place in the order (key hash, key). Buckets are ranges of the hash,
    in two levels: a fixed number of coarse ones, each cut into so many fine ones
    that a fine bucket has about ``_FINE_ROWS`` rows whatever the size of the table.
    A draw finds its coarse bucket, and in it its fine one, by an equality join on
    steps of equal width; only the rows of drawn fine buckets are moved and ranked.
    ``key`` must identify a row.
    """
    total = df.count()
    if not total or not n:
        return df.sparkSession.range(0).select(F.col("id").alias("draw")).join(df.limit(0), F.lit(True)).select("draw", *df.columns)
    fine_bits = max(0, (total // (_FINE_ROWS << _COARSE_BITS)).bit_length())
    shift = _HASH_BITS - _COARSE_BITS
    hashed = df.withColumn("_hash", hash_long(F.col(key), seed))
    keyed = hashed.withColumn("_coarse", F.shiftright("_hash", shift)).withColumn(
        "_fine", F.shiftright(F.col("_hash").bitwiseAND((1 << shift) - 1), shift - fine_bits)
    )
    sizes = keyed.groupBy("_coarse", "_fine").agg(F.count("*").alias("_n"))
    # At most 2^_COARSE_BITS rows are brought together here.
    coarse = sizes.groupBy("_coarse").agg(F.sum("_n").alias("_n"))
    in_coarse = _with_ends(coarse, Window.orderBy("_coarse"))
    in_fine = _with_ends(sizes, Window.partitionBy("_coarse").orderBy("_fine"))

    draws = df.sparkSession.range(n).select(
        F.col("id").alias("draw"), F.pmod(hash_long(F.col("id"), seed), F.lit(total)).alias("_place")
    )
    step = max(1, total >> _COARSE_BITS)
    placed = _into_ranges(draws, in_coarse, [], F.lit(step)).withColumn("_place", F.col("_place") - F.col("_start")).drop("_start", "_end", "_n")
    fine_step = F.lit(max(1, step >> fine_bits))
    drawn = _into_ranges(placed, in_fine, ["_coarse"], fine_step).select(
        "draw", "_coarse", "_fine", (F.col("_place") - F.col("_start")).alias("_rank")
    )
    in_bucket = Window.partitionBy("_coarse", "_fine").orderBy("_hash", key)
    wanted = keyed.join(drawn.select("_coarse", "_fine").distinct(), ["_coarse", "_fine"], "left_semi")
    ranked = wanted.withColumn("_rank", F.row_number().over(in_bucket).cast("long") - 1)
    return drawn.join(ranked, ["_coarse", "_fine", "_rank"]).select("draw", *df.columns)


def _with_ends(sizes: DataFrame, order: Window) -> DataFrame:
    """Add the half-open range of places ``_start`` to ``_end`` of each bucket."""
    return sizes.withColumn("_end", F.sum("_n").over(order)).withColumn("_start", F.col("_end") - F.col("_n"))


def _into_ranges(draws: DataFrame, ranges: DataFrame, keys: Sequence[str], step: Column) -> DataFrame:
    """Join each place to the range it lies in, through steps of equal width that a range overlaps."""
    first = F.call_function("div", F.col("_start"), step)
    last = F.call_function("div", F.col("_end") - 1, step)
    stepped = ranges.withColumn("_step", F.explode(F.sequence(first, last)))
    found = draws.withColumn("_step", F.call_function("div", F.col("_place"), step)).join(stepped, [*keys, "_step"])
    return found.filter((F.col("_place") >= F.col("_start")) & (F.col("_place") < F.col("_end"))).drop("_step")


def with_split(df: DataFrame, keys: Sequence[str], weights: Sequence[int], seed: int) -> DataFrame:
    """Add ``part``: 0, 1, ... in the proportion of the weights, decided by the keys alone."""
    bucket = hash_bucket([F.col(key) for key in keys], seed, sum(weights))
    part = F.lit(len(weights) - 1)
    upper = sum(weights)
    for index in range(len(weights) - 1, 0, -1):
        upper -= weights[index]
        part = F.when(bucket < upper, F.lit(index - 1)).otherwise(part)
    return df.withColumn("part", part)


def split_rows(df: DataFrame, keys: Sequence[str], weights: Sequence[int], seed: int) -> list[DataFrame]:
    """Disjoint parts that together hold every row."""
    marked = with_split(df, keys, weights, seed)
    return [marked.filter(F.col("part") == index).drop("part") for index in range(len(weights))]
