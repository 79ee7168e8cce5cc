"""Sums that grow with the corpus against the frequencies of the whole of it."""

import uuid

import pytest
from pyspark.sql import functions as F

from tallyloom.plans import growing_corpus as G
from tallyloom.plans.weights import inverse_document_frequency
from tallyloom.session import checkpoint_folder
from tallyloom.sinks.versions import read_table

SCHEMA = "id string, text string"
PARTS = [[("d1", "alpha beta beta"), ("d2", "beta the gamma"), ("d3", None)], [("d4", "delta, Beta"), ("d5", "")], [("d6", "alpha")]]


@pytest.fixture
def folders(spark):
    return [f"{checkpoint_folder(spark)}/{kind}-{uuid.uuid4().hex}" for kind in ("store", "source")]


def rows(df):
    return {r.token: round(r.idf, 9) for r in df.collect()}


def test_appended_equals_recomputed(spark, folders):
    store, source = folders
    whole, known = None, set()
    for part in PARTS:
        df = spark.createDataFrame(part, SCHEMA).coalesce(1)
        df.write.mode("append").parquet(source)
        whole = df if whole is None else whole.unionByName(df)
        new = G.update(spark, store, source)
        assert set(new) == set(G.files_of(spark, source)) - known and new
        known |= set(new)
        assert rows(G.idf(spark, store)) == rows(inverse_document_frequency(whole))
    assert G.update(spark, store, source) == []
    before = rows(G.idf(spark, store))
    G.merge(spark, store)
    assert rows(G.idf(spark, store)) == before and G.counted_files(spark, store) == known
    assert read_table(spark, store).count() == len(before) + 1 + len(known)
    assert G.update(spark, store, source) == []


def test_only_new_files_are_scanned(spark, folders):
    """An old file may even be gone: nothing reads it again."""
    store, source = folders
    spark.createDataFrame(PARTS[0], SCHEMA).coalesce(1).write.parquet(source)
    old = G.update(spark, store, source)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(old[0])
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, False)
    spark.createDataFrame(PARTS[1], SCHEMA).coalesce(1).write.mode("append").parquet(source)
    assert len(G.update(spark, store, source)) == 1
    both = spark.createDataFrame(PARTS[0] + PARTS[1], SCHEMA)
    assert rows(G.idf(spark, store)) == rows(inverse_document_frequency(both))


def test_folders_inside_are_not_counted(spark, folders):
    store, source = folders
    spark.createDataFrame(PARTS[0], SCHEMA).coalesce(1).write.parquet(source)
    G.update(spark, store, source)
    spark.createDataFrame([(1, 2)], "other int, text int").coalesce(1).write.parquet(source + "/more")
    spark.createDataFrame(PARTS[1], SCHEMA).withColumn("text", F.lit(None).cast("string")).coalesce(1).write.mode("append").parquet(source)
    G.update(spark, store, source)
    assert len(G.counted_files(spark, store)) == 2
    assert rows(G.idf(spark, store))["beta"] == 2.5
