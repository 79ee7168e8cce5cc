"""Projections, filters, aggregates, orders, samples and sets on the plain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.registry import query
from tallyloom.catalog.tables import corpus, first_source, second_source, table, text_lines
from tallyloom.operators.counting import count_by, count_rows, grouped_lists
from tallyloom.operators.indexing import with_global_index
from tallyloom.operators.matching import pair_space
from tallyloom.operators.ranking import largest, smallest
from tallyloom.operators.sampling import sample_rows, sample_with_replacement
from tallyloom.operators.unfolding import unfold

LINES = "SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents"


@query(
    "range_reduce",
    """
    SELECT count(*) AS numbers, CAST(sum(x) AS BIGINT) AS total
    FROM (SELECT unnest(range(0, CAST(l_quantity AS BIGINT))) AS x FROM lineitem)
    """,
)
def range_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("long")
    numbers = (
        table(spark, sf_dir, "lineitem")
        .filter(quantity > 0)
        .select(F.explode(F.sequence(F.lit(0).cast("long"), quantity - 1)).alias("x"))
    )
    return numbers.agg(F.count("*").alias("numbers"), F.sum("x").alias("total"))


@query("row_count", "SELECT count(*) AS n FROM lineitem")
def row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(table(spark, sf_dir, "lineitem"))


@query("text_line_count", f"SELECT count(*) AS n FROM ({LINES})")
def text_line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(text_lines(spark, sf_dir))


@query(
    "line_index",
    """
    SELECT doc_id, line_no, row_number() OVER (ORDER BY doc_id, line_no) - 1 AS line_index, line
    FROM (
      SELECT doc_id, CAST(unnest(range(len(lines))) AS INTEGER) AS line_no, unnest(lines) AS line
      FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
    )
    """,
)
def line_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_global_index(text_lines(spark, sf_dir), "doc_id", "line_no", name="line_index")


@query(
    "project_arith",
    """
    SELECT l_orderkey, l_linenumber, l_orderkey - 1 AS key_less_one, CAST(l_quantity AS BIGINT) % 7 AS rest,
           l_quantity * l_quantity AS squared, -l_quantity AS negated
    FROM lineitem
    """,
)
def project_arith(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity")
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        (F.col("l_orderkey") - 1).alias("key_less_one"),
        (quantity.cast("long") % 7).alias("rest"),
        (quantity * quantity).alias("squared"),
        (-quantity).alias("negated"),
    )


@query("pluralize", "SELECT p_partkey, p_name || 's' AS plural FROM part")
def pluralize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.concat("p_name", F.lit("s")).alias("plural"))


@query("word_lengths", "SELECT p_partkey, CAST(length(p_name || 's') AS INTEGER) AS chars FROM part")
def word_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", F.length(F.concat("p_name", F.lit("s"))).alias("chars"))


@query("keys_values", "SELECT o_custkey AS k, o_totalprice * 2 AS v FROM orders")
def keys_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("k"), (F.col("o_totalprice") * 2).alias("v")
    )


@query("singular_plural", "SELECT p_partkey, unnest([p_name, p_name || 's']) AS word FROM part")
def singular_plural(spark: SparkSession, sf_dir: str) -> DataFrame:
    both = F.array("p_name", F.concat("p_name", F.lit("s")))
    return table(spark, sf_dir, "part").select("p_partkey", F.explode(both).alias("word"))


@query("explode_range", "SELECT p_partkey, unnest(range(1, p_size)) AS y FROM part")
def explode_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size").cast("long")
    # sequence(1, 0) counts down, so sizes without a range are left out first.
    return (
        table(spark, sf_dir, "part")
        .filter(size > 1)
        .select("p_partkey", F.explode(F.sequence(F.lit(1).cast("long"), size - 1)).alias("y"))
    )


@query(
    "filter_chain",
    """
    SELECT o_orderkey - 1 AS key_less_one FROM orders
    WHERE o_totalprice < 150000 AND (o_orderkey - 1) % 2 = 0
    """,
)
def filter_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_totalprice") < 150000)
        .select((F.col("o_orderkey") - 1).alias("key_less_one"))
        .filter(F.col("key_less_one") % 2 == 0)
    )


@query(
    "filter_modulo_sum",
    "SELECT count(*) AS n, CAST(sum(o_orderkey) AS BIGINT) AS total FROM orders WHERE o_orderkey % 7 = 0",
)
def filter_modulo_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    multiples = table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 7 == 0)
    return multiples.agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("total"))


@query(
    "count_by_value",
    "SELECT CAST(l_quantity AS BIGINT) AS quantity, count(*) AS n FROM lineitem GROUP BY 1",
)
def count_by_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_by(table(spark, sf_dir, "lineitem"), F.col("l_quantity").cast("long").alias("quantity"))


@query(
    "sum_by_key",
    "SELECT l_suppkey AS k, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY 1",
)
def sum_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("k"), F.col("l_quantity").cast("long").alias("v")
    )
    return pairs.groupBy("k").agg(F.sum("v").alias("total"))


@query(
    "fold_by_key",
    """
    SELECT l_suppkey AS k, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total, count(*) AS n,
           CAST(max(l_quantity) AS BIGINT) AS highest, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) / count(*) AS mean
    FROM lineitem GROUP BY 1
    """,
)
def fold_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("l_quantity").cast("long")
    return (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_suppkey").alias("k"))
        .agg(F.sum(value).alias("total"), F.count("*").alias("n"), F.max(value).alias("highest"))
        .withColumn("mean", F.col("total") / F.col("n"))
    )


LIST_SIZE = 50


@query(
    "grouped_lists",
    f"""
    SELECT k, list_no, string_agg(CAST(v AS VARCHAR), ',' ORDER BY place) AS items
    FROM (
      SELECT k, v, place, place // {LIST_SIZE} AS list_no
      FROM (
        SELECT l_suppkey AS k, l_orderkey AS v,
               row_number() OVER (PARTITION BY l_suppkey ORDER BY l_orderkey) - 1 AS place
        FROM lineitem
      )
    )
    GROUP BY k, list_no
    """,
)
def grouped_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("k"), F.col("l_orderkey").alias("v"))
    lists = grouped_lists(pairs, "k", "v", LIST_SIZE)
    return lists.select("k", "list_no", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"))


@query(
    "smallest_n",
    "SELECT o_totalprice, o_orderkey FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10",
)
def smallest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    return smallest(table(spark, sf_dir, "orders").select("o_totalprice", "o_orderkey"), 10, "o_totalprice", "o_orderkey")


@query(
    "largest_n",
    f"SELECT word FROM (SELECT unnest(string_split(line, ' ')) AS word FROM ({LINES})) ORDER BY word DESC LIMIT 10",
)
def largest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = unfold(text_lines(spark, sf_dir), F.split("line", " "), "word")
    return largest(words, 10, "word")


@query(
    "deterministic_sort",
    """
    SELECT row_number() OVER (ORDER BY CAST(printf('%.3f', mean_price) AS DOUBLE), title) - 1 AS place, title, n
    FROM (
      SELECT p_name AS title, avg(p_size) AS mean_price, count(*) AS n FROM part GROUP BY p_name
    )
    """,
)
def deterministic_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    sizes = (
        table(spark, sf_dir, "part")
        .groupBy(F.col("p_name").alias("title"))
        .agg(F.avg("p_size").alias("mean_price"), F.count("*").alias("n"))
    )
    rounded = sizes.select(F.bround("mean_price", 3).alias("rounded"), "title", "n")
    return with_global_index(rounded, "rounded", "title", name="place").select("place", "title", "n")


@query(
    "corpus_union",
    """
    SELECT 'd' || doc_id AS id, text FROM documents
    UNION ALL
    SELECT 'b' || item_id AS id, text FROM benchmark
    """,
)
def corpus_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus(spark, sf_dir)


@query(
    "cross_pairs_count",
    """
    SELECT (SELECT count(*) FROM documents) AS left_rows, (SELECT count(*) FROM benchmark) AS right_rows,
           count(*) AS pairs
    FROM documents, benchmark
    """,
)
def cross_pairs_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pair_space(first_source(spark, sf_dir), second_source(spark, sf_dir))


SAMPLE_SIZE, SAMPLE_SEED = 60, 500
LARGE_SAMPLE = 9_001


@query(
    "sample_without_replacement",
    f"""
    SELECT event_id, user_id, event_type FROM events
    ORDER BY md5('{SAMPLE_SEED}:' || event_id), event_id LIMIT {SAMPLE_SIZE}
    """,
)
def sample_without_replacement(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return sample_rows(events, "event_id", SAMPLE_SIZE, SAMPLE_SEED)


@query(
    "sample_large",
    f"""
    SELECT o_orderkey, o_custkey FROM orders
    ORDER BY md5('{SAMPLE_SEED}:' || o_orderkey), o_orderkey LIMIT {LARGE_SAMPLE}
    """,
)
def sample_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A sample whose end is found by counting hashes rather than by sorting."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return sample_rows(orders, "o_orderkey", LARGE_SAMPLE, SAMPLE_SEED, merged=0)


@query(
    "sample_with_replacement",
    f"""
    WITH placed AS (
      SELECT event_id, user_id, event_type,
             row_number() OVER (ORDER BY substr(md5('{SAMPLE_SEED}:' || event_id), 1, 15), event_id) - 1 AS place
      FROM events
    ), draws AS (
      SELECT draw, CAST('0x' || substr(md5('{SAMPLE_SEED}:' || draw), 1, 15) AS BIGINT)
                   % (SELECT count(*) FROM events) AS place
      FROM range({SAMPLE_SIZE}) AS t(draw)
    )
    SELECT draw, event_id, user_id, event_type FROM draws JOIN placed USING (place)
    """,
)
def draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type")
    return sample_with_replacement(events, "event_id", SAMPLE_SIZE, SAMPLE_SEED)
