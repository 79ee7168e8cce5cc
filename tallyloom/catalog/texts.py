"""Word counts, tokens and weights over whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.catalog.basics import LINES
from tallyloom.catalog.registry import query
from tallyloom.catalog.tables import corpus, first_source, second_source, text_lines
from tallyloom.functions.text import STOPWORDS, content_tokens, normalize_text, word_tokens
from tallyloom.operators.counting import count_by, count_rows, distinct_count, histogram
from tallyloom.operators.ranking import smallest
from tallyloom.operators.unfolding import unfold
from tallyloom.plans import growing_corpus, weights, words
from tallyloom.session import own_folder
from tallyloom.sources.text import read_lines, read_words

NORMALIZED = r"trim(lower(regexp_replace(line, '[^A-Za-z0-9 ]', '', 'g')))"
WORDS = f"WITH words AS (SELECT unnest(string_split({NORMALIZED}, ' ')) AS word FROM ({LINES})) "
STOP_LIST = "(" + ", ".join(f"'{word}'" for word in STOPWORDS) + ")"

# Corpus, tokens and weights as SQL tables; side a is the documents, side b the passages.
CORPUS = f"""
    WITH corpus AS (
      SELECT 'a' AS side, 'd' || doc_id AS id, text FROM documents
      UNION ALL
      SELECT 'b' AS side, 'b' || item_id AS id, text FROM benchmark
    ), tokens AS (
      SELECT side, id, lower(t) AS token
      FROM (SELECT side, id, unnest(regexp_split_to_array(text, '\\W+')) AS t FROM corpus)
      WHERE t <> '' AND lower(t) NOT IN {STOP_LIST}
    ), counts AS (
      SELECT side, id, token, count(*) AS n FROM tokens GROUP BY ALL
    ), frequency AS (
      SELECT side, id, token, n / sum(n) OVER (PARTITION BY id) AS tf FROM counts
    ), idf AS (
      SELECT token, (SELECT count(DISTINCT id) FROM corpus) / count(*) AS idf FROM counts GROUP BY token
    ), weights AS (
      SELECT side, id, token, tf * idf AS weight FROM frequency JOIN idf USING (token)
    )
"""


@query(
    "normalize_text",
    f"""
    SELECT doc_id, line_no, {NORMALIZED} AS normalized
    FROM (
      SELECT doc_id, CAST(unnest(range(len(lines))) AS INTEGER) AS line_no, unnest(lines) AS line
      FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents)
    )
    """,
)
def normalized_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_lines(spark, sf_dir).select("doc_id", "line_no", normalize_text(F.col("line")).alias("normalized"))


@query("explode_words", WORDS + "SELECT word, count(*) AS n FROM words GROUP BY 1")
def explode_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(words.words_of(text_lines(spark, sf_dir)))


@query("nonempty_word_count", WORDS + "SELECT count(*) AS n FROM words WHERE word <> ''")
def nonempty_word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(words.nonempty_words(text_lines(spark, sf_dir)))


@query("word_count", WORDS + "SELECT word, count(*) AS n FROM words WHERE word <> '' GROUP BY 1")
def word_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.word_count(words.nonempty_words(text_lines(spark, sf_dir)))


@query("unique_words", WORDS + "SELECT count(DISTINCT word) AS n FROM words WHERE word <> ''")
def unique_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return distinct_count(words.nonempty_words(text_lines(spark, sf_dir)), "word")


@query(
    "mean_words_per_word",
    WORDS
    + """
    SELECT count(*) AS total, count(DISTINCT word) AS uniques, count(*) / count(DISTINCT word) AS mean
    FROM words WHERE word <> ''
    """,
)
def mean_words_per_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.mean_uses(words.nonempty_words(text_lines(spark, sf_dir)))


@query(
    "top_words",
    WORDS + "SELECT word, count(*) AS n FROM words WHERE word <> '' GROUP BY 1 ORDER BY n DESC, word LIMIT 15",
)
def top_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return words.top_words(text_lines(spark, sf_dir))


SPLIT = r"list_filter(regexp_split_to_array(text, '\W+'), lambda t: t <> '')"
LOWER = f"list_transform({SPLIT}, lambda t: lower(t))"


@query(
    "tokenize",
    f"SELECT 'd' || doc_id AS id, len({LOWER}) AS n_tokens, array_to_string({LOWER}, ' ') AS tokens FROM documents",
)
def tokenize(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = word_tokens(F.col("text"))
    return first_source(spark, sf_dir).select(
        "id", F.size(tokens).cast("long").alias("n_tokens"), F.array_join(tokens, " ").alias("tokens")
    )


KEPT = f"list_filter({LOWER}, lambda t: t NOT IN {STOP_LIST})"


@query(
    "tokens_no_stopwords",
    f"SELECT 'd' || doc_id AS id, array_to_string({KEPT}, ' ') AS tokens FROM documents",
)
def tokens_no_stopwords(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = content_tokens(F.col("text"))
    return first_source(spark, sf_dir).select("id", F.array_join(tokens, " ").alias("tokens"))


@query("doc_token_counts", f"SELECT 'd' || doc_id AS id, len({KEPT}) AS n_tokens FROM documents")
def doc_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weights.token_totals(first_source(spark, sf_dir))


@query("total_tokens", CORPUS + "SELECT count(*) AS n FROM tokens")
def total_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weights.token_totals(corpus(spark, sf_dir)).agg(F.sum("n_tokens").alias("n"))


@query("biggest_doc", CORPUS + "SELECT id, count(*) AS n_tokens FROM tokens GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 1")
def biggest_doc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weights.biggest_document(corpus(spark, sf_dir))


@query(
    "source_sizes",
    CORPUS
    + """
    SELECT side, (SELECT count(*) FROM corpus c WHERE c.side = t.side) AS docs, count(*) AS n_tokens
    FROM tokens t GROUP BY side
    """,
)
def source_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    def size(docs: DataFrame, side: str) -> DataFrame:
        return weights.token_totals(docs).agg(
            F.lit(side).alias("side"), F.count("*").alias("docs"), F.sum("n_tokens").alias("n_tokens")
        )

    return size(first_source(spark, sf_dir), "a").unionByName(size(second_source(spark, sf_dir), "b"))


@query("tf", CORPUS + "SELECT id, token, round(tf, 6) AS tf FROM frequency")
def tf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weights.term_frequency(corpus(spark, sf_dir)).withColumn("tf", F.round("tf", 6))


@query("idf", CORPUS + "SELECT token, round(idf, 6) AS idf FROM idf")
def idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weights.inverse_document_frequency(corpus(spark, sf_dir)).withColumn("idf", F.round("idf", 6))


@query("idf_appended", CORPUS + "SELECT token, round(idf, 6) AS idf FROM idf")
def idf_appended(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from sums that were kept while the corpus grew: documents first, passages in files added later."""
    source, store = own_folder(spark, "corpus"), own_folder(spark, "sums")
    for part in (first_source(spark, sf_dir), second_source(spark, sf_dir)):
        part.write.mode("append").parquet(source)
        growing_corpus.update(spark, store, source)
    return growing_corpus.idf(spark, store).withColumn("idf", F.round("idf", 6))


@query("vocabulary_size", CORPUS + "SELECT count(*) AS n FROM idf")
def vocabulary_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_rows(weights.inverse_document_frequency(corpus(spark, sf_dir)))


@query("smallest_idf", CORPUS + "SELECT token, round(idf, 6) AS idf FROM idf ORDER BY idf.idf, token LIMIT 11")
def smallest_idf(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowest = smallest(weights.inverse_document_frequency(corpus(spark, sf_dir)), 11, "idf", "token")
    return lowest.withColumn("idf", F.round("idf", 6))


@query(
    "idf_histogram",
    CORPUS
    + """
    , span AS (SELECT min(idf) AS low, (max(idf) - min(idf)) / 50 AS width FROM idf),
    placed AS (SELECT least(49, CAST(floor((idf - low) / width) AS INTEGER)) AS bin FROM idf, span)
    SELECT CAST(b AS INTEGER) AS bin, count(placed.bin) AS n
    FROM range(50) AS bins(b) LEFT JOIN placed ON placed.bin = b GROUP BY 1
    """,
)
def idf_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram(weights.inverse_document_frequency(corpus(spark, sf_dir)), "idf", 50)


@query("tfidf", CORPUS + "SELECT id, token, round(weight, 6) AS weight FROM weights")
def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = corpus(spark, sf_dir)
    weighted = weights.document_weights(docs, weights.inverse_document_frequency(docs))
    return weighted.select("id", "token", F.round("weight", 6).alias("weight"))


def _as_file(df: DataFrame, name: str, **options: str) -> str:
    """Write one text column to the shared folder, until staged tables are released, and return the path."""
    path = own_folder(df.sparkSession, name)
    df.write.text(path, **options)
    return path


@query("file_line_count", f"SELECT line, count(*) AS n FROM ({LINES}) GROUP BY 1")
def file_line_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of the documents, written as gzip text files and read back; lines may hold carriage returns."""
    lines = text_lines(spark, sf_dir).select("line")
    return count_by(read_lines(spark, _as_file(lines, "lines", compression="gzip"), 8, "\n"), "line")


@query(
    "tokens_not_in_word_file",
    CORPUS
    + """
    , listed AS (SELECT DISTINCT token AS word FROM tokens WHERE side = 'b')
    SELECT token, count(*) AS n FROM tokens WHERE side = 'a' AND token NOT IN (SELECT word FROM listed) GROUP BY 1
    """,
)
def tokens_not_in_word_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of the documents that are not in a word file; the file holds the tokens of the passages."""
    listed = unfold(weights.tokenized(second_source(spark, sf_dir)), F.col("tokens"), "token")
    words_read = read_words(spark, _as_file(listed, "words"))
    tokens = unfold(weights.tokenized(first_source(spark, sf_dir)), F.col("tokens"), "token")
    return count_by(weights.without_words(tokens, words_read), "token")
