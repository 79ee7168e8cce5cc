"""Word counting."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.functions.text import normalize_text, split_words
from tallyloom.operators.counting import count_by
from tallyloom.operators.ranking import top_by
from tallyloom.operators.unfolding import unfold


def words_of(lines: DataFrame, line: str = "line") -> DataFrame:
    """Words of the normalised lines, empty ones included, column ``word``."""
    return unfold(lines, split_words(normalize_text(F.col(line))), "word")


def nonempty_words(lines: DataFrame, line: str = "line") -> DataFrame:
    return words_of(lines, line).filter(F.col("word") != "")


def word_count(words: DataFrame) -> DataFrame:
    """Occurrences per word."""
    return count_by(words, "word")


def top_words(lines: DataFrame, n: int = 15, line: str = "line") -> DataFrame:
    """The most frequent words of a text."""
    return top_by(word_count(nonempty_words(lines, line)), n, "n", "word")


def mean_uses(words: DataFrame) -> DataFrame:
    """One row: total words, unique words and their quotient."""
    counts = word_count(words)
    return counts.agg(F.sum("n").alias("total"), F.count("*").alias("uniques")).withColumn(
        "mean", F.try_divide(F.col("total"), F.col("uniques"))
    )
