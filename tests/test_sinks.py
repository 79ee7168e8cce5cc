"""Tables with versions: whole writes, repeated batches, old versions, failed and rival writers."""

import json
import uuid
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tallyloom.session import checkpoint_folder
from tallyloom.sinks import versions as V

SCHEMA = "id long, day int, note string"


@pytest.fixture
def path(spark):
    return f"{checkpoint_folder(spark)}/sink-{uuid.uuid4().hex}"


def frame(spark, low, high, note="a"):
    return spark.createDataFrame([(i, i % 3 if i % 5 else None, note) for i in range(low, high)], SCHEMA)


def rows(df):
    return Counter(tuple(r) for r in df.collect())


def test_round_trip_and_schema(spark, path):
    df = frame(spark, 0, 50)
    assert V.write_table(df, path, ["day"]) == 1
    back = V.read_table(spark, path)
    assert back.columns == df.columns and [f.dataType for f in back.schema] == [f.dataType for f in df.schema]
    assert rows(back) == rows(df)


def test_a_repeated_batch_leaves_no_double_rows(spark, path):
    for _ in range(3):
        V.write_table(frame(spark, 0, 20), path, ["day"], "first")
    V.write_table(frame(spark, 20, 30), path, ["day"], "second")
    assert rows(V.read_table(spark, path)) == rows(frame(spark, 0, 30))
    V.write_table(frame(spark, 0, 5, "b"), path, ["day"], "first")
    assert rows(V.read_table(spark, path)) == rows(frame(spark, 0, 5, "b")) + rows(frame(spark, 20, 30))
    assert V.versions(spark, path) == [1, 2, 3, 4, 5]
    assert rows(V.read_table(spark, path, 4)) == rows(frame(spark, 0, 30))


def test_unnamed_writes_add_and_overwrite_replaces(spark, path):
    V.write_table(frame(spark, 0, 4), path)
    V.write_table(frame(spark, 0, 4), path)
    assert V.read_table(spark, path).count() == 8
    V.write_table(frame(spark, 0, 3), path, overwrite=True)
    assert V.read_table(spark, path).count() == 3
    assert V.clean(spark, path) == 2
    assert V.versions(spark, path) == [3] and V.read_table(spark, path).count() == 3


def test_a_failed_write_is_not_seen(spark, path):
    V.write_table(frame(spark, 0, 6), path, batch="one")
    broken = frame(spark, 6, 9).withColumn("note", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        V.write_table(broken, path, batch="two")
    assert rows(V.read_table(spark, path)) == rows(frame(spark, 0, 6))
    assert V.clean(spark, path) == 1
    assert V.read_table(spark, path).count() == 6


def test_a_rival_takes_the_version_first(spark, path, monkeypatch):
    """Both writes count, whoever comes first."""
    V.write_table(frame(spark, 0, 2), path, batch="zero")
    publish, once = V._Files.publish, []

    def late(self, name, text):
        if not once:
            once.append(True)
            V.write_table(frame(spark, 2, 4), path, batch="rival")
        return publish(self, name, text)

    monkeypatch.setattr(V._Files, "publish", late)
    assert V.write_table(frame(spark, 4, 6), path, batch="mine") == 3
    assert rows(V.read_table(spark, path)) == rows(frame(spark, 0, 6))
    assert json.loads(V._Files(spark, path).read(V._manifest_name(3)))["batches"].keys() == {"zero", "rival", "mine"}


def test_another_schema_is_refused(spark, path):
    V.write_table(frame(spark, 0, 2), path)
    with pytest.raises(ValueError, match="differ"):
        V.write_table(frame(spark, 0, 2).drop("note"), path)
    with pytest.raises(ValueError, match="differ"):
        V.write_table(frame(spark, 0, 2), path, ["day"])


def test_partitions_prune_and_empty_tables_keep_their_schema(spark, path):
    V.write_table(frame(spark, 0, 30), path, ["day"])
    plan = V.read_table(spark, path).filter("day = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "day" in plan.split("PartitionFilters")[1].split("]")[0]
    V.write_table(frame(spark, 0, 0), path, ["day"], overwrite=True)
    assert V.read_table(spark, path).count() == 0 and V.read_table(spark, path).columns == ["id", "day", "note"]
    with pytest.raises(FileNotFoundError):
        V.read_table(spark, path + "-none")
