"""Snapshot tables: each commit writes a folder of Parquet that no other commit writes, and then a pointer of its own.

Pointers are numbered and made only where there is none, so that of two writers of a version one raises Conflict; nothing that
is read is ever deleted or replaced by a commit. A writer that dies before its pointer is whole leaves the last version as it was. Readers see
the last whole snapshot. Paths are any that Hadoop's file systems know."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class Conflict(RuntimeError):
    """Another writer has committed that version, or is about to."""


class SnapshotTable:
    #: Seconds after which a pointer without content is taken for one whose writer died.
    DEAD_AFTER = 60.0

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _pointers(self) -> dict[int, str | None]:
        """Folder by version; None where a writer has not said it yet."""
        found = {}
        for s in self._fs.globStatus(self._path(f"{self.path}/_at.*")) or []:
            stream = self._fs.open(s.getPath())
            try:
                found[int(s.getPath().getName().rpartition(".")[2])] = stream.readLine()
            finally:
                stream.close()
        return found

    def version(self) -> int:
        """The last committed version, 0 for none."""
        return max((n for n, folder in self._pointers().items() if folder), default=0)

    def read(self, version: int | None = None) -> DataFrame:
        found = self._pointers()
        n = max((n for n, folder in found.items() if folder), default=0) if version is None else version
        if not n:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(f"{self.path}/{found[n]}")

    def commit(self, df: DataFrame, expected: int | None = None) -> int:
        """Writes df as the next version. expected: the version it was made from; another one raises Conflict."""
        found = self._pointers()
        now = max((n for n, folder in found.items() if folder), default=0)
        if expected is not None and expected != now:
            raise Conflict(f"{self.path}: version is {now}, not {expected}")
        for n in found:
            if n > now and time.time() - self._fs.getFileStatus(self._path(f"{self.path}/_at.{n:08d}")).getModificationTime() / 1000 < self.DEAD_AFTER:
                raise Conflict(f"{self.path}: version {n} is being written")
        version = max(found, default=0) + 1
        folder = f"v={version:08d}-{uuid.uuid4().hex[:8]}"
        columns = [df[f.name].cast(f.dataType).alias(f.name) for f in self.schema.fields]
        df.select(*columns).write.parquet(f"{self.path}/{folder}")
        at = self._path(f"{self.path}/_at.{version:08d}")
        try:
            out = self._fs.create(at, False)
        except Py4JJavaError as e:
            self._fs.delete(self._path(f"{self.path}/{folder}"), True)
            if self._fs.exists(at):
                raise Conflict(f"{self.path}: version {version} was committed meanwhile") from e
            raise
        out.write(f"{folder}\n".encode())
        out.close()
        return version

    def prune(self, keep: int = 2) -> None:
        """Deletes all but the last versions, pointers first."""
        found = self._pointers()
        for n in sorted(n for n, folder in found.items() if folder)[:-keep]:
            self._fs.delete(self._path(f"{self.path}/_at.{n:08d}"), False)
            self._fs.delete(self._path(f"{self.path}/{found[n]}"), True)


def retry_on_conflict(table: SnapshotTable, change: Callable[[DataFrame], DataFrame], attempts: int = 5, base_ms: float = 250.0, sleep: Callable[[float], None] = time.sleep) -> int:
    """Commits change(the table's rows) as the next version. Where another writer was first, change sees its rows, after a wait that
    doubles; the last attempt's Conflict is raised."""
    for n in range(1, attempts + 1):
        now = table.version()
        try:
            return table.commit(change(table.read(now)), expected=now)
        except Conflict:
            if n == attempts:
                raise
            sleep(base_ms * 2 ** (n - 1) / 1000)
    raise ValueError(f"attempts: {attempts} is not above 0")
