"""Tables of Parquet files with versions: written as a whole or not at all, and never twice.

A write goes to a folder of its own, ``data/_write=<name>``, partitioned by the given columns. It counts from the moment
its *manifest* appears: one small file with the schema and the folders that make up the new version, moved into place
in one step that fails if another writer has taken the version. Readers follow the newest manifest, so they never see a
part of a write, and a failed job leaves a folder that nobody reads. A *batch* may be written any number of times: a
version holds one folder per batch, the last one written.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_WRITE = "_write"
#: Writers that publish at the same time try again with the next version.
_ATTEMPTS = 20


@dataclass(frozen=True)
class Manifest:
    """A version of a table: its schema, and the folder of each batch."""

    version: int
    schema: StructType
    partitions: tuple[str, ...]
    batches: dict[str, str]

    def text(self) -> str:
        return json.dumps({"version": self.version, "schema": self.schema.jsonValue(), "partitions": self.partitions, "batches": self.batches})

    @staticmethod
    def of(text: str) -> Manifest:
        found = json.loads(text)
        return Manifest(found["version"], StructType.fromJson(found["schema"]), tuple(found["partitions"]), found["batches"])


class _Files:
    """The few file operations needed, on whatever file system the path names."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark.sparkContext._jvm, path.rstrip("/")
        self.hadoop = self.jvm.org.apache.hadoop.fs
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.system = self.hadoop.Path(self.root).getFileSystem(self.conf)

    def path(self, name: str):
        return self.hadoop.Path(f"{self.root}/{name}")

    def names(self, folder: str) -> list[str]:
        where = self.path(folder)
        return sorted(s.getPath().getName() for s in self.system.listStatus(where)) if self.system.exists(where) else []

    def read(self, name: str) -> str:
        stream = self.system.open(self.path(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def publish(self, name: str, text: str) -> bool:
        """Put a new file in place in one step; false if it is there already."""
        draft = self.path(f"_drafts/{uuid.uuid4().hex}")
        stream = self.system.create(draft, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.system.mkdirs(self.path(name).getParent())
        context = self.hadoop.FileContext.getFileContext(self.system.getUri(), self.conf)
        options = self.jvm.java.lang.reflect.Array.newInstance(self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename"), 0)
        try:
            context.rename(self.system.makeQualified(draft), self.system.makeQualified(self.path(name)), options)
        except Py4JJavaError as error:
            if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
                self.system.delete(draft, False)
                return False
            raise
        return True


def _manifest_name(version: int) -> str:
    return f"_versions/{version:012d}.json"


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions there are, oldest first."""
    return [int(name[:12]) for name in _Files(spark, path).names("_versions") if name.endswith(".json")]


def manifest(spark: SparkSession, path: str, version: int | None = None) -> Manifest | None:
    """The manifest of a version, the newest one if none is named; None for a table that was never written."""
    known = versions(spark, path)
    if version is None and not known:
        return None
    return Manifest.of(_Files(spark, path).read(_manifest_name(known[-1] if version is None else version)))


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = (), batch: str | None = None, overwrite: bool = False) -> int:
    """Add ``df`` to the table, or with ``overwrite`` make it the whole table; returns the new version.

    ``batch`` names what is written: the same batch written again takes the place of its rows. Without a name each
    write is a batch of its own. The schema and the partition columns must be those of the table, unless it is
    overwritten. Rows are gathered by partition values first, cut where one value has many rows, so a value has few files.
    """
    spark, before = df.sparkSession, manifest(df.sparkSession, path)
    if _WRITE in df.columns:
        raise ValueError(f"a column can't be called {_WRITE}")
    if before and not overwrite:
        same = [(f.name, f.dataType) for f in before.schema] == [(f.name, f.dataType) for f in df.schema]
        if not same or before.partitions != tuple(partition_by):
            raise ValueError("the schema or the partitions differ from the table's")
    name, files = uuid.uuid4().hex, _Files(spark, path)
    rows = df.hint("rebalance", *partition_by) if partition_by else df
    writer = rows.write.partitionBy(*partition_by) if partition_by else rows.write
    writer.parquet(f"{path.rstrip('/')}/data/{_WRITE}={name}")
    for _ in range(_ATTEMPTS):
        batches = {} if overwrite or before is None else dict(before.batches)
        batches[batch or name] = name
        after = Manifest(before.version + 1 if before else 1, df.schema, tuple(partition_by), batches)
        if files.publish(_manifest_name(after.version), after.text()):
            return after.version
        before = manifest(spark, path)
    raise RuntimeError(f"other writers took {_ATTEMPTS} versions in a row")


def read_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version, the newest one if none is named; filters on partition columns prune folders."""
    found = manifest(spark, path, version)
    if found is None:
        raise FileNotFoundError(f"no table at {path}")
    root = f"{path.rstrip('/')}/data"
    folders = [f"{root}/{_WRITE}={name}" for name in found.batches.values()]
    rows = spark.read.schema(found.schema).option("basePath", root).parquet(*folders)
    return rows.select(*[F.col(f"`{name}`") for name in found.schema.names])


def clean(spark: SparkSession, path: str, keep: int = 1) -> int:
    """Delete all but the newest ``keep`` versions and every folder they don't name; returns the number of folders deleted.

    Not to be called while another job writes to the table or reads an old version of it.
    """
    files, known = _Files(spark, path), versions(spark, path)
    used = {name for version in known[-keep:] for name in manifest(spark, path, version).batches.values()}
    for version in known[:-keep]:
        files.system.delete(files.path(_manifest_name(version)), False)
    gone = [name for name in files.names("data") if name.removeprefix(f"{_WRITE}=") not in used]
    for name in gone:
        files.system.delete(files.path(f"data/{name}"), True)
    files.system.delete(files.path("_drafts"), True)
    return len(gone)
