"""Session settings and tables staged on shared storage."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a hot key is worth an extra shuffle after the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64MB",
    # Larger limits are sorted on the executors instead of merged on the driver.
    "spark.sql.execution.topKSortFallbackThreshold": "100000",
}


def apply_settings(spark: SparkSession) -> SparkSession:
    """Set the runtime SQL options the jobs rely on, where they differ."""
    for name, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def build_session(
    app_name: str = "tallyloom",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **options: str,
) -> SparkSession:
    """Create a session; on a cluster leave ``master`` to spark-submit.

    ``shuffle_partitions`` is an upper bound: adaptive execution merges small
    partitions, so set it for the largest expected shuffle (about 128 MB each).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in {**RUNTIME_SETTINGS, **options}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local session uses a folder in its warehouse; on a
    cluster the setting is required, as no other folder is known to be shared.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staged"
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


_STAGED: list[str] = []
#: Kind of the folders whose table has a name in the catalog.
_BUCKETS = "buckets"


def stage_table(df: DataFrame, compression: str = "snappy") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a result feeds several later steps: the columns can be pruned per
    step, and a lost executor costs a re-read rather than a recomputation. The
    table stays until :func:`release_staged`.
    """
    path = own_folder(df.sparkSession, "staged")
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_buckets(df: DataFrame, column: str, buckets: int, compression: str = "snappy") -> DataFrame:
    """As :func:`stage_table`, in buckets of a column: a join or grouping by it leaves these rows where they are.

    The other side of a join is dealt to the same number of parts. Each bucket is one file; the table has a name in the
    catalog until it is released.
    """
    path = own_folder(df.sparkSession, _BUCKETS)
    writer = df.repartition(buckets, column).write.format("parquet").option("path", path).option("compression", compression)
    writer.bucketBy(buckets, column).saveAsTable(_catalog_name(path))
    return df.sparkSession.table(_catalog_name(path))


def _catalog_name(path: str) -> str:
    return f"{_BUCKETS}_{path.rpartition('-')[2]}"


def staged_tables() -> int:
    """How many tables this process has staged and not released; a mark for :func:`release_staged`."""
    return len(_STAGED)


def staged_names(since: int = 0) -> list[str]:
    """The folders staged after a mark, oldest first."""
    return _STAGED[since:]


def own_folder(spark: SparkSession, kind: str) -> str:
    """A new name in the shared folder, which is released like a staged table."""
    path = f"{checkpoint_folder(spark)}/{kind}-{uuid.uuid4().hex}"
    _STAGED.append(path)
    return path


def release_tables(spark: SparkSession, names: Iterable[str]) -> None:
    """Delete staged folders; DataFrames that read them can't be used any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for name in names:
        if name in _STAGED:
            _STAGED.remove(name)
        if f"/{_BUCKETS}-" in name:
            spark.sql(f"DROP TABLE IF EXISTS {_catalog_name(name)}")
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(conf).delete(path, True)


def release_staged(spark: SparkSession, since: int = 0, until: int | None = None) -> None:
    """Delete the tables staged by this process between two marks; DataFrames that read them can't be used any more."""
    release_tables(spark, _STAGED[since:until])


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Delete what is staged inside the block at its end; read all results before."""
    before = len(_STAGED)
    try:
        yield
    finally:
        release_staged(spark, before)
