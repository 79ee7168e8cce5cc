"""User-written Python functions run over whole tables."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.registry import query
from tallyloom.catalog.tables import table
from tallyloom.operators.counting import grouped_lists
from tallyloom.operators.custom import map_partitions, map_partitions_with_index, numbers_below, reduce_by_key, row_function, running_sums


@query("udf_row_function", "SELECT p_partkey, p_name || 's' AS plural FROM part")
def udf_row_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    plural = row_function(lambda word: word + "s", "string")
    return table(spark, sf_dir, "part").select("p_partkey", plural(F.col("p_name")).alias("plural"))


@query("udaf_fold", "SELECT l_suppkey AS k, bit_xor(l_orderkey) AS v FROM lineitem GROUP BY 1")
def udaf_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_orderkey").alias("v"))
    return reduce_by_key(pairs, "k", "v", lambda left, right: left ^ right)


@query("udtf_range", "SELECT p_partkey, unnest(range(1, p_size)) AS y FROM part")
def udtf_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return numbers_below(table(spark, sf_dir, "part").select("p_partkey", "p_size"), "p_size", "y").select("p_partkey", "y")


@query(
    "udtf_partitioned",
    """
    SELECT o_custkey, o_orderkey, row_number() OVER w AS number, CAST(sum(cents) OVER w AS BIGINT) AS running
    FROM (SELECT o_custkey, o_orderkey, o_orderdate, CAST(round(o_totalprice * 100) AS BIGINT) AS cents FROM orders)
    WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)
    """,
)
def udtf_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders of each customer in turn, with what they have spent so far."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long").alias("cents")
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate", cents)
    return running_sums(orders, "cents", ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "number", "running")


@query("map_partitions_partial", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def map_partitions_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    def count_locally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = batch["event_type"].value_counts(dropna=False)
            yield pd.DataFrame({"event_type": counts.index, "n": counts.to_numpy()})

    partial = map_partitions(
        table(spark, sf_dir, "events").select("event_type"), count_locally, "event_type string, n bigint"
    )
    return partial.groupBy("event_type").agg(F.sum("n").alias("n"))


LIST_SIZE = 200


@query(
    "bucket_contents",
    f"""
    SELECT bucket, place // {LIST_SIZE} AS list_no, string_agg(CAST(v AS VARCHAR), ',' ORDER BY v) AS items
    FROM (
      SELECT o_orderkey % 4 AS bucket, o_orderkey AS v,
             row_number() OVER (PARTITION BY o_orderkey % 4 ORDER BY o_orderkey) - 1 AS place
      FROM orders
    )
    GROUP BY 1, 2
    """,
)
def bucket_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    keyed = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 4).alias("bucket"), F.col("o_orderkey").alias("v"))
    lists = grouped_lists(keyed, "bucket", "v", LIST_SIZE)
    return lists.select("bucket", "list_no", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


@query(
    "partition_numbers",
    "SELECT o_custkey AS k, count(*) AS n, 1 AS partitions FROM orders GROUP BY 1",
)
def partition_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per key counted by numbered partitions: all rows of a key are in one of them."""

    def count(number: int, batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = batch["k"].value_counts(dropna=False)
            yield pd.DataFrame({"k": counts.index, "n": counts.to_numpy(), "number": number})

    keyed = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("k")).repartition(7, "k")
    counted = map_partitions_with_index(keyed, count, "k bigint, n bigint, number int")
    return counted.groupBy("k").agg(F.sum("n").alias("n"), F.count_distinct("number").cast("int").alias("partitions"))
