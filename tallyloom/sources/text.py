"""Text lines and word lists."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_lines(spark: SparkSession, path: str, partitions: int | None = None, line_sep: str | None = None) -> DataFrame:
    """One row per line, column ``line``; gzip is recognised by the file suffix.

    A gzip file is read by a single task, so ask for ``partitions`` to spread
    its lines before doing any work on them. Lines end at LF, CR or both, or
    only at ``line_sep`` if that is given.
    """
    lines = spark.read.text(path, lineSep=line_sep).withColumnRenamed("value", "line")
    return lines.repartition(partitions) if partitions else lines


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """One row per distinct word of a one-word-per-line file, column ``word``."""
    return spark.read.text(path).select(F.col("value").alias("word")).distinct()


def lines_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Lines of a text column: the document, the line's place in it, the line."""
    # A split has at least one element, so the outer form adds no rows; see operators.unfolding.
    lines = docs.filter(F.col(text).isNotNull())
    return lines.select(doc_id, F.posexplode_outer(F.split(F.col(text), "\n")).alias("line_no", "line"))
