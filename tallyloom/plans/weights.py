"""Token counts, term frequency, inverse document frequency and their product.

Documents are tables with ``id`` and ``text``, where an id names one document;
weights are long tables with one row per document and token.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.functions.text import STOPWORDS, content_tokens
from tallyloom.operators.counting import count_by
from tallyloom.operators.ranking import top_by
from tallyloom.operators.unfolding import unfold

#: Bytes of text whose tokens one task counts, and those that are worth a task of their own in small inputs.
_PART_BYTES, _LEAST_BYTES = 8 << 20, 1 << 20


def tokenized(docs: DataFrame, stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """Each document with its list of tokens."""
    return docs.select("id", content_tokens(F.col("text"), stopwords).alias("tokens"))


def token_totals(docs: DataFrame, stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """Tokens per document, 0 for a document without any."""
    return tokenized(docs, stopwords).select("id", F.size("tokens").cast("long").alias("n_tokens"))


def biggest_document(docs: DataFrame, stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    return top_by(token_totals(docs, stopwords), 1, "n_tokens", "id")


def without_words(tokens: DataFrame, words: DataFrame) -> DataFrame:
    """Tokens that are not in a table of words, for a list read from a file."""
    return tokens.join(words.select(F.col("word").alias("token")), "token", "left_anti")


def text_parts(docs: DataFrame) -> int:
    """A number of parts in proportion to the bytes of all texts, at least two, and one per core where each gets enough."""
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(2, total // _PART_BYTES, min(docs.sparkSession.sparkContext.defaultParallelism, total // _LEAST_BYTES))


def term_frequency(docs: DataFrame, stopwords: Sequence[str] = STOPWORDS, parts: int | None = None) -> DataFrame:
    """Share of each token among the tokens of its document.

    The document's length travels with its tokens, which saves joining it back.
    Texts are moved by id before they are split: they are several times smaller
    than their token rows, which then need no shuffle of their own here. A task
    keeps all counts of its part of the texts, so there are ``parts`` by
    :func:`text_parts`, which adaptive execution doesn't merge; give it the
    documents themselves where these are chosen from others by a join.
    """
    placed = docs.repartition(parts or text_parts(docs), "id")
    return (
        unfold(tokenized(placed, stopwords), F.col("tokens"), "token", "id", F.size("tokens").alias("_length"))
        .groupBy("id", "token")
        .agg((F.count("*") / F.max("_length")).alias("tf"))
    )


def inverse_document_frequency(corpus: DataFrame, stopwords: Sequence[str] = STOPWORDS) -> DataFrame:
    """Documents divided by documents with the token, without a logarithm."""
    holders = unfold(tokenized(corpus, stopwords), F.array_distinct("tokens"), "token")
    documents = corpus.agg(F.count_distinct("id")).scalar()
    return count_by(holders, "token").select("token", (documents / F.col("n")).alias("idf"))


def document_weights(docs: DataFrame, idf: DataFrame, stopwords: Sequence[str] = STOPWORDS, parts: int | None = None) -> DataFrame:
    """Term frequency times inverse document frequency: ``id``, ``token``, ``idf``, ``weight``.

    Tokens missing from ``idf`` are dropped, so the corpus must contain the documents.
    """
    return weigh(term_frequency(docs, stopwords, parts), idf)


def weigh(frequencies: DataFrame, idf: DataFrame) -> DataFrame:
    """The weights of term frequencies that are there already."""
    return frequencies.join(idf, "token").select("id", "token", "idf", (F.col("tf") * F.col("idf")).alias("weight"))


def norms(weights: DataFrame) -> DataFrame:
    """Length of each document's vector."""
    return weights.groupBy("id").agg(F.sqrt(F.sum(F.col("weight") * F.col("weight"))).alias("norm"))


def unit_weights(weights: DataFrame) -> DataFrame:
    """Weights scaled to vectors of length one. A document's tokens come from one cell of text."""
    of_document = Window.partitionBy("id")
    length = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(of_document))
    return weights.select("id", "token", "idf", F.try_divide(F.col("weight"), length).alias("weight"))
