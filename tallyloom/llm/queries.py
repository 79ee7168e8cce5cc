"""The registered queries of the training-data operators: each runs over its whole table with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tallyloom.llm import bpe, fm_index, html_mincut, langid, ngram_join, ppm, quality, redirects, simhash, suffix_dedup, superkmers, token_alignment, whitening

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
#: DuckDB SQL with the same rows, for the queries that SQL can express.
SQL: dict[str, str] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of the documents: five-word shingles, Jaccard similarity 0.75 or more."""
    found = ngram_join.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


@query
def op9_superkmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents without windows of 20 words that start earlier in the corpus."""
    return superkmers.without_repeats(table(spark, sf_dir, "documents"))


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents without strings of 400 bytes that occur more than once."""
    return suffix_dedup.without_repeats(table(spark, sf_dir, "documents"))


@query
def op8_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in the documents: windows of ten words."""
    return fm_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_ITEM_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL["op8_fm_index"] = f"""
WITH d AS (SELECT doc_id, {_ITEM_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_ITEM_WORDS} AS w FROM benchmark),
sizes AS (SELECT item_id, w, least(len(w), 10) AS k FROM b WHERE len(w) > 0),
phrases AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sizes)),
lengths AS (SELECT DISTINCT k FROM phrases),
windows AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, lengths WHERE len(w) >= k)),
found AS (SELECT doc_id, i, k, item_id FROM windows JOIN phrases USING (k, phrase)),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM found) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY 1)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SQL["op9_superkmers"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
again AS (SELECT doc_id, i FROM windows QUALIFY row_number() OVER (PARTITION BY words ORDER BY doc_id, i) > 1),
gone AS (SELECT doc_id, list(DISTINCT j) AS places FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM again) GROUP BY 1),
kept AS (SELECT doc_id, w, places, list_filter(range(1, len(w) + 1), lambda j: places IS NULL OR NOT list_contains(places, j)) AS rest
  FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(places), 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(list_transform(rest, lambda j: w[j]), ' '), '')) AS kept_sha256
FROM kept
"""


@query
def op4_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language-model scores of the documents."""
    return ppm.score_texts(table(spark, sf_dir, "documents"))


@query
def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of the documents and their decoding."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trips(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of the documents, learned from three quarters of them."""
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of the documents, from base rules and trees fitted on the labels."""
    found = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op10_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main texts of the pages."""
    return html_mincut.extract(table(spark, sf_dir, "pages"))


URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@query
def op5_redirect_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on the addresses of the pages, with the links that the pages state."""
    return redirects.filter_urls(table(spark, sf_dir, "pages"), redirects.rules_table(spark, URL_RULES))


# The given pages state no redirect and no canonical link, so the verdict without a rule is always allow.
SQL["op5_redirect_filter"] = """
WITH rest AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
parts AS (SELECT page_id, translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(rule, host_part, path_part, action) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
found AS (SELECT page_id, max_by(rule, length(rule)) AS rule, max_by(action, length(rule)) AS action
  FROM parts JOIN rules ON (host = host_part OR ends_with(host, '.' || host_part)) AND starts_with(path, path_part) GROUP BY 1)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict FROM parts LEFT JOIN found USING (page_id)
"""

SQL["op2_ngram_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY 1),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have FROM shingles a JOIN shingles b USING (s) WHERE a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT x, y FROM common JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y WHERE 100 * both_have >= 75 * (a.n + b.n - both_have)
), reach(x, y) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.x, links.y FROM reach JOIN links ON reach.y = links.x)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM d LEFT JOIN sizes USING (doc_id) JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY 1) ON x = d.doc_id
"""


@query
def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings along the first 16 components of their distinct grid vectors."""
    vectors = table(spark, sf_dir, "embeddings")
    return whitening.whiten(vectors, whitening.fit(vectors))


@query
def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of the documents by fingerprints of 64 bits, at most four of them different."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers over the documents."""
    paths = [public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
    return token_alignment.align(table(spark, sf_dir, "documents"), *paths)
