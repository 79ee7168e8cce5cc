"""Record readers, similarity, similar pairs and their evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.registry import query
from tallyloom.catalog.tables import (
    corpus,
    first_source,
    gold_lines,
    gold_pairs,
    product_lines,
    second_source,
    table,
)
from tallyloom.catalog.texts import CORPUS
from tallyloom.plans import similarity
from tallyloom.plans.weights import document_weights, inverse_document_frequency, norms, text_parts
from tallyloom.session import stage_table
from tallyloom.sources.quality import record_quality
from tallyloom.sources.records import parse_gold, parse_products

MIN_SIMILARITY, MIN_OTHERS = 0.1, 0.02

GOLD = """
    SELECT 'd' || doc_id AS a_id, 'b' || item_id AS b_id
    FROM documents d, benchmark b WHERE instr(d.text, b.text) > 0 AND b.text <> ''
"""
SCORED = (
    CORPUS
    + f"""
    , norms AS (
      SELECT side, id, sqrt(sum(weight * weight)) AS norm FROM weights GROUP BY side, id
    ), dots AS (
      SELECT a.id AS a_id, b.id AS b_id, sum(a.weight * b.weight) AS dot
      FROM weights a JOIN weights b ON a.token = b.token
      WHERE a.side = 'a' AND b.side = 'b' GROUP BY 1, 2
    ), scores AS (
      SELECT a_id, b_id, dot, dot / na.norm / nb.norm AS similarity
      FROM dots JOIN norms na ON na.id = a_id JOIN norms nb ON nb.id = b_id
    ), gold AS ({GOLD})
    """
)
#: Every document with the copy that stands for its text: the one with the smallest number.
COPIES = """
    SELECT side, id, arg_min(id, number) OVER (PARTITION BY side, text) AS first_id, count(*) OVER (PARTITION BY side, text) AS copies
    FROM (SELECT *, CAST(id[2:] AS BIGINT) AS number FROM corpus)
"""


def _similar_sql(least: float) -> str:
    """All pairs of documents above a bound, each named by its representatives as well."""
    return SCORED + f"""
    , copies AS ({COPIES}), similar_pairs AS (
      SELECT a_id, b_id, similarity, a.first_id AS a_first, b.first_id AS b_first
      FROM scores JOIN copies a ON a.id = a_id JOIN copies b ON b.id = b_id WHERE similarity >= {least}
    )
    """


def _idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Staged, because the weights of both sources read it."""
    return stage_table(inverse_document_frequency(corpus(spark, sf_dir)))


def _sources(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return first_source(spark, sf_dir), second_source(spark, sf_dir)


PRODUCTS = """
    SELECT p_partkey AS line_no, CASE WHEN p_partkey % 50 = 7 THEN -1 ELSE 1 END AS parse_status,
           CASE WHEN p_partkey % 50 <> 7 THEN 'p' || p_partkey END AS id,
           CASE WHEN p_partkey % 50 <> 7 THEN p_name || ' "' || p_type || '" ' || p_brand END AS text
    FROM part UNION ALL SELECT -1, 0, NULL, NULL
"""


@query("product_parse", PRODUCTS)
def product_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_products(product_lines(spark, sf_dir)).drop("line")


@query(
    "product_quality",
    f"""
    SELECT count(*) AS lines, count(*) FILTER (WHERE parse_status = 1) AS parsed,
           count(*) FILTER (WHERE parse_status = 0) AS header, count(*) FILTER (WHERE parse_status = -1) AS invalid
    FROM ({PRODUCTS})
    """,
)
def product_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return record_quality(parse_products(product_lines(spark, sf_dir)))


@query(
    "gold_parse",
    f"""
    SELECT 1 AS parse_status, a_id, b_id FROM ({GOLD})
    UNION ALL SELECT -1, NULL, NULL FROM benchmark
    UNION ALL SELECT 0, NULL, NULL
    """,
)
def gold_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_gold(gold_lines(spark, sf_dir)).drop("line")


@query("doc_norms", SCORED + "SELECT id, round(norm, 6) AS norm FROM norms")
def doc_norms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus(spark, sf_dir)
    return norms(document_weights(docs, _idf(spark, sf_dir))).withColumn("norm", F.round("norm", 6))


@query(
    "dot_products",
    SCORED
    + """
    SELECT g.a_id, g.b_id, round(coalesce(dot, 0), 6) AS dot FROM gold g LEFT JOIN scores s USING (a_id, b_id)
    """,
)
def dot_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, idf = gold_pairs(spark, sf_dir), _idf(spark, sf_dir)
    a_docs, b_docs = _sources(spark, sf_dir)
    a_weights = stage_table(document_weights(similarity.only_in_pairs(a_docs, pairs, "a"), idf, parts=text_parts(a_docs)))
    b_weights = stage_table(document_weights(similarity.only_in_pairs(b_docs, pairs, "b"), idf, parts=text_parts(b_docs)))
    return similarity.dot_products(pairs, a_weights, b_weights).withColumn("dot", F.round("dot", 6))


@query(
    "cosine_pairs",
    SCORED
    + """
    SELECT g.a_id, g.b_id, round(coalesce(similarity, 0), 6) AS similarity
    FROM gold g LEFT JOIN scores s USING (a_id, b_id)
    """,
)
def cosine_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    a_docs, b_docs = _sources(spark, sf_dir)
    scored = similarity.pair_cosines(gold_pairs(spark, sf_dir), a_docs, b_docs, _idf(spark, sf_dir))
    return scored.withColumn("similarity", F.round("similarity", 6))


@query(
    "pair_lookup",
    SCORED
    + """
    , requests AS (
      SELECT 'd' || doc_id AS a_id, 'b' || (doc_id % (SELECT count(*) FROM benchmark)) AS b_id FROM labels
    )
    SELECT a_id, b_id,
           round(CASE WHEN na.norm IS NOT NULL AND nb.norm IS NOT NULL THEN coalesce(similarity, 0) END, 6) AS similarity
    FROM requests LEFT JOIN scores USING (a_id, b_id)
    LEFT JOIN norms na ON na.id = a_id LEFT JOIN norms nb ON nb.id = b_id
    """,
)
def pair_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    a_docs, b_docs = _sources(spark, sf_dir)
    passages = b_docs.agg(F.count("*")).scalar()
    requests = table(spark, sf_dir, "labels").select(
        F.concat(F.lit("d"), F.col("doc_id")).alias("a_id"),
        F.concat(F.lit("b"), F.col("doc_id") % passages).alias("b_id"),
    )
    scored = similarity.pair_cosines(requests, a_docs, b_docs, _idf(spark, sf_dir))
    return scored.withColumn("similarity", F.round("similarity", 6))


@query(
    "er_all_pairs",
    SCORED
    + """
    SELECT count(*) AS pairs, round(sum(coalesce(similarity, 0)), 6) AS similarity_sum,
           round(avg(coalesce(similarity, 0)), 9) AS similarity_mean
    FROM (SELECT a.id AS a_id, b.id AS b_id FROM corpus a, corpus b WHERE a.side = 'a' AND b.side = 'b')
    LEFT JOIN scores USING (a_id, b_id)
    """,
)
def er_all_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = similarity.all_pairs_total(*_sources(spark, sf_dir), _idf(spark, sf_dir))
    return total.select(
        "pairs",
        F.round("similarity_sum", 6).alias("similarity_sum"),
        F.round("similarity_mean", 9).alias("similarity_mean"),
    )


@query(
    "inverted_index",
    CORPUS + "SELECT token, side AS source, id, round(weight, 6) AS weight FROM weights",
)
def inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    a_docs, b_docs = _sources(spark, sf_dir)
    index = similarity.inverted_index({"a": a_docs, "b": b_docs}, _idf(spark, sf_dir))
    return index.withColumn("weight", F.round("weight", 6))


def _similar(spark: SparkSession, sf_dir: str, least: float) -> DataFrame:
    a_docs, b_docs = _sources(spark, sf_dir)
    return similarity.similar_pairs(a_docs, b_docs, min_similarity=least)


@query("text_copies", CORPUS + f"SELECT side AS source, id, first_id, copies FROM ({COPIES})")
def text_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document and the copy that stands for it in the lists of pairs."""
    found = [similarity.representatives(docs).withColumn("source", F.lit(side)) for side, docs in zip("ab", _sources(spark, sf_dir))]
    return found[0].unionByName(found[1]).select("source", "id", "first_id", "copies")


@query(
    "er_inverted_index",
    _similar_sql(MIN_SIMILARITY)
    + """
    SELECT a_first AS a_id, b_first AS b_id, round(min(similarity), 6) AS similarity,
           count(DISTINCT a_id) AS a_copies, count(DISTINCT b_id) AS b_copies
    FROM similar_pairs GROUP BY 1, 2
    """,
)
def er_inverted_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _similar(spark, sf_dir, MIN_SIMILARITY).withColumn("similarity", F.round("similarity", 6))


@query(
    "non_duplicates",
    _similar_sql(MIN_OTHERS)
    + """
    SELECT a_first AS a_id, b_first AS b_id, round(min(similarity), 6) AS similarity, count(*) AS pairs
    FROM similar_pairs s WHERE NOT EXISTS (SELECT 1 FROM gold g WHERE g.a_id = s.a_id AND g.b_id = s.b_id)
    GROUP BY 1, 2
    """,
)
def non_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    similar, gold = _similar(spark, sf_dir, MIN_OTHERS), gold_pairs(spark, sf_dir)
    others = similarity.other_pairs(similar, gold, *_sources(spark, sf_dir))
    return others.withColumn("similarity", F.round("similarity", 6))


@query(
    "er_evaluation",
    SCORED
    + """
    , judged AS (
      SELECT coalesce(similarity, 0) AS similarity, gold.a_id IS NOT NULL AS duplicate
      FROM (SELECT a.id AS a_id, b.id AS b_id FROM corpus a, corpus b WHERE a.side = 'a' AND b.side = 'b') p
      LEFT JOIN scores USING (a_id, b_id) LEFT JOIN gold USING (a_id, b_id)
    )
    SELECT count(*) FILTER (WHERE duplicate) AS duplicates,
           round(avg(similarity) FILTER (WHERE duplicate), 6) AS mean_duplicates,
           round(avg(similarity) FILTER (WHERE NOT duplicate), 9) AS mean_others
    FROM judged
    """,
)
def er_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    a_docs, b_docs = _sources(spark, sf_dir)
    result = similarity.evaluate(a_docs, b_docs, gold_pairs(spark, sf_dir), _idf(spark, sf_dir))
    return result.select(
        "duplicates",
        F.round("mean_duplicates", 6).alias("mean_duplicates"),
        F.round("mean_others", 9).alias("mean_others"),
    )
