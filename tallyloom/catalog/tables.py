"""Inputs of the jobs, derived from the given tables.

The given tables hold no access log, product file or rating file, so lines in
those formats are rendered from them and parsed again; the SQL reads the base
columns instead.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.operators.passages import containing
from tallyloom.session import stage_table
from tallyloom.sources.text import lines_of


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, with the files that are there now."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id``, ``line_no``, ``line`` for every line of every document."""
    return lines_of(table(spark, sf_dir, "documents").select("doc_id", "text"))


def access_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log line per event; some with a broken zone, some with a blank before the closing quote."""
    event = table(spark, sf_dir, "events")
    zone = F.when(F.col("event_id") % 97 == 0, " 0000").otherwise(" +0000")
    blank = F.when(F.col("event_id") % 89 == 0, " ").otherwise("")
    kind = F.col("event_type")
    code = (
        F.when(kind == "error", "404").when(kind == "signup", "302").when(kind == "click", "304").otherwise("200")
    )
    size = F.when(kind == "click", "-").otherwise(F.floor(F.col("value") * 100).cast("string"))
    line = F.concat(
        F.lit("host-"), F.col("user_id").cast("string"), F.lit(".example.net - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), zone, F.lit('] "GET /'), kind, F.lit("/"),
        F.regexp_extract("props", "([0-9]+)", 1), F.lit(" HTTP/1.0"), blank, F.lit('" '), code, F.lit(" "), size,
    )
    return event.select("event_id", line.alias("line"))


def product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product records of the parts, with a header and some lines that are no record."""
    part = table(spark, sf_dir, "part")
    record = F.concat(
        F.lit('"p'), F.col("p_partkey").cast("string"), F.lit('","'), F.col("p_name"), F.lit('","'),
        F.col("p_type"), F.lit('",'), F.col("p_brand"), F.lit(","), F.col("p_retailprice").cast("string"),
    )
    broken = F.concat(F.lit("part "), F.col("p_partkey").cast("string"))
    body = part.select(
        F.col("p_partkey").alias("line_no"), F.when(F.col("p_partkey") % 50 == 7, broken).otherwise(record).alias("line")
    )
    return body.unionByName(_header(spark, '"id","title","description","manufacturer","price"'))


def _header(spark: SparkSession, line: str) -> DataFrame:
    return spark.range(1).select(F.lit(-1).cast("long").alias("line_no"), F.lit(line).alias("line"))


def rating_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``user::item::rating::time`` lines, some with an unreadable rating."""
    rated = ratings(spark, sf_dir)
    rating = F.when((F.col("user_id") + F.col("item_id")) % 101 == 0, "none").otherwise(
        F.col("rating").cast("int").cast("string")
    )
    line = F.concat_ws("::", F.col("user_id").cast("string"), F.col("item_id").cast("string"), rating, F.lit("0"))
    return rated.select(line.alias("line"))


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rating from 1 to 5 per customer and part bought: ``user_id``, ``item_id``, ``rating``."""
    line = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    order = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return (
        line.join(order, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
        .agg(F.max(1 + F.col("l_quantity").cast("long") % 5).cast("double").alias("rating"))
    )


def item_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``item::title::genres`` lines of the parts, some without a title."""
    part = table(spark, sf_dir, "part")
    broken, key = F.col("p_partkey") % 97 == 5, F.col("p_partkey").cast("string")
    return part.select(F.when(broken, key).otherwise(F.concat_ws("::", key, "p_name", "p_type")).alias("line"))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("title"))


def first_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as ``id``, ``text``."""
    return table(spark, sf_dir, "documents").select(F.concat(F.lit("d"), F.col("doc_id")).alias("id"), "text")


def second_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark passages as ``id``, ``text``."""
    return table(spark, sf_dir, "benchmark").select(F.concat(F.lit("b"), F.col("item_id")).alias("id"), "text")


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return first_source(spark, sf_dir).unionByName(second_source(spark, sf_dir))


def gold_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``a_id``, ``b_id`` where the document contains the passage word for word.

    The pairs stand for a file of known matches, so they are staged as one.
    """
    return stage_table(containing(first_source(spark, sf_dir), second_source(spark, sf_dir)))


def gold_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold mapping lines with a header; one line per passage is no pair."""
    pair = F.concat(F.lit('"'), F.col("a_id"), F.lit('","'), F.col("b_id"), F.lit('"'))
    pairs = gold_pairs(spark, sf_dir).select(pair.alias("line"))
    broken = second_source(spark, sf_dir).select(F.concat(F.lit("no pair for "), F.col("id")).alias("line"))
    header = spark.range(1).select(F.lit('"idAmazon","idGoogleBase"').alias("line"))
    return pairs.unionByName(broken).unionByName(header)
