"""Inverse document frequencies of a corpus that grows by files.

Counts of documents per token add up, so each update counts the files that are new and adds their sums to a store. The
store is a versioned table: the names of the counted files and their sums come in one write, so a file is counted
once however often an update fails or is repeated. Files must not change after they were counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.functions.text import STOPWORDS
from tallyloom.operators.counting import count_by
from tallyloom.operators.unfolding import unfold
from tallyloom.plans.weights import tokenized
from tallyloom.sinks.versions import manifest, read_table, write_table

_STORE = "file string, token string, n long"


def files_of(spark: SparkSession, folder: str) -> list[str]:
    """The data files directly in a folder, by name."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    names = [status.getPath().toString() for status in found if status.isFile()]
    return sorted(name for name in names if not name.rsplit("/", 1)[1].startswith(("_", ".")))


def counted_files(spark: SparkSession, store: str) -> set[str]:
    """The files whose documents are in the sums."""
    if manifest(spark, store) is None:
        return set()
    return {r.file for r in read_table(spark, store).filter("file is not null").select("file").collect()}


def update(spark: SparkSession, store: str, folder: str, stopwords: Sequence[str] = STOPWORDS) -> list[str]:
    """Count the Parquet files of a folder (``id``, ``text``) that the store doesn't know, and only these; returns their names.

    An id names one document and is in one file. One update at a time may write to a store.
    """
    known = counted_files(spark, store)
    new = [name for name in files_of(spark, folder) if name not in known]
    if not new:
        return []
    docs = spark.read.parquet(*new).select("id", "text")
    holders = count_by(unfold(tokenized(docs, stopwords), F.array_distinct("tokens"), "token"), "token")
    documents = docs.agg(F.count("*").alias("n"))
    names = spark.createDataFrame([(name,) for name in new], "file string")
    rows = (
        holders.select(F.lit(None).cast("string").alias("file"), "token", F.col("n"))
        .unionByName(documents.select(F.lit(None).cast("string").alias("file"), F.lit(None).cast("string").alias("token"), "n"))
        .unionByName(names.select("file", F.lit(None).cast("string").alias("token"), F.lit(0).cast("long").alias("n")))
    )
    before = manifest(spark, store)
    write_table(rows, store, batch=f"update {before.version + 1 if before else 1}")
    return new


def merge(spark: SparkSession, store: str) -> int:
    """Replace the sums of all updates by one; returns the new version."""
    summed = read_table(spark, store).groupBy("file", "token").agg(F.sum("n").alias("n"))
    return write_table(summed, store, batch="merged", overwrite=True)


def idf(spark: SparkSession, store: str) -> DataFrame:
    """``token``, ``idf``: documents divided by documents with the token, over all counted files."""
    sums = read_table(spark, store).filter("file is null")
    documents = sums.filter("token is null").agg(F.sum("n")).scalar()
    counted = sums.filter("token is not null").groupBy("token").agg(F.sum("n").alias("n"))
    return counted.select("token", (documents / F.col("n")).alias("idf"))
