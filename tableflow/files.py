"""The few file-system calls a commit needs, on whatever file system a path names."""

from __future__ import annotations

import json
import time
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession
from pyspark.sql import types as T

# The file of a partitioned folder table that declares it; the underscore hides it from readers.
_DECLARATION = "_declared.json"


class Files:
    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def holds(self, path: str) -> bool:
        """Whether ``path`` is on this file system, so that a rename can reach it."""
        return self._path(path).getFileSystem(self._fs.getConf()).getUri().equals(self._fs.getUri())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def size(self, path: str) -> int:
        """Bytes of every file under ``path``, as the file system itself sums them."""
        return self._fs.getContentSummary(self._path(path)).getLength()

    def newest_age(self, path: str) -> float:
        """Seconds since any file under ``path`` changed, or since the folder was made if it has none."""
        newest = self._fs.getFileStatus(self._path(path)).getModificationTime()
        found, times = self._fs.listFiles(self._path(path), True), []
        while found.hasNext():
            times.append(found.next().getModificationTime())
        return time.time() - max(times, default=newest) / 1000

    def read_text(self, path: str) -> str:
        stream = self._fs.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        stream = self._fs.create(self._path(path), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()

    def create_new(self, path: str, text: str) -> bool:
        """Write a file that must not exist yet; whether it did not."""
        stream = None
        try:
            stream = self._fs.create(self._path(path), False)
            stream.write(bytearray(text.encode()))
        except Py4JJavaError as error:
            if stream is None and self.exists(path):
                return False
            raise error
        finally:
            if stream is not None:
                stream.close()
        return True

    def age(self, path: str) -> float:
        """Seconds since a file was written last."""
        return time.time() - self._fs.getFileStatus(self._path(path)).getModificationTime() / 1000

    def delete(self, path: str) -> None:
        self._fs.delete(self._path(path), True)

    def make_parent(self, path: str) -> None:
        self._fs.mkdirs(self._path(path).getParent())

    def rename(self, source: str, target: str) -> None:
        """A rename that never lands inside an existing folder and never fails silently."""
        if self.exists(target):
            raise FileExistsError(target)
        if not self._fs.rename(self._path(source), self._path(target)):
            raise OSError(f"could not rename {source} to {target}")

    def children(self, path: str) -> list[tuple[str, str, float]]:
        """``(name, path, age in seconds)`` of each entry; empty when there is no such folder."""
        if not self.exists(path):
            return []
        now = time.time()
        return [
            (status.getPath().getName(), status.getPath().toString(), now - status.getModificationTime() / 1000)
            for status in self._fs.listStatus(self._path(path))
        ]


class DeclaredTable(NamedTuple):
    schema: T.StructType
    partition_by: list[str]


def declare_table(spark: SparkSession, path: str, schema: T.StructType, partition_by: list[str]) -> None:
    """Keep a partitioned table's schema with it: folder names say neither types nor, without rows, the layout."""
    said = {"schema": schema.jsonValue(), "partition_by": partition_by}
    Files(spark, path).write_text(f"{path}/{_DECLARATION}", json.dumps(said))


def declared_table(spark: SparkSession, path: str) -> DeclaredTable | None:
    files, file = Files(spark, path), f"{path}/{_DECLARATION}"
    if not files.exists(file):
        return None
    said = json.loads(files.read_text(file))
    return DeclaredTable(T.StructType.fromJson(said["schema"]), said["partition_by"])
