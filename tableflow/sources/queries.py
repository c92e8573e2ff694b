"""Reading the result of a SQL text."""

from __future__ import annotations

import logging
import threading
import uuid
from concurrent.futures import Future

from pyspark.sql import DataFrame, SparkSession

from tableflow.errors import Code, TableflowError
from tableflow.files import Files
from tableflow.leases import FolderLease
from tableflow.session import staging_root
from tableflow.sources.tables import apply_hints

log = logging.getLogger(__name__)


def read_query(spark: SparkSession, query: str, **hints) -> DataFrame:
    """The query as a lazy DataFrame: hints are optimised together with the text itself.

    Use this when the result is read once. A :class:`ReadSession` lands the
    result instead, for results that are read several times or must not change.
    """
    return apply_hints(_derived(spark, query), **hints)


class ReadSession:
    """Query reads over staged results: one job per query text, dropped at close.

    Threads that ask for the same text wait for the one job. A failure is not
    remembered, so the next read tries again.
    """

    def __init__(self, spark: SparkSession, staging_dir: str | None = None):
        self._spark = spark
        self._root = staging_root(spark, staging_dir)
        self._lock = threading.Lock()
        self._landed: dict[str, Future[DataFrame]] = {}
        self._created: list[str] = []
        self._lease: FolderLease | None = None
        self._closed = False

    def __enter__(self) -> ReadSession:
        return self

    def __exit__(self, *exc) -> None:
        self.close()

    def read_query(self, query: str, **hints) -> DataFrame:
        """Hints apply to the landed rows; the text is never edited."""
        return apply_hints(self._land(query.strip()), **hints)

    def close(self) -> None:
        with self._lock:
            self._closed = True
            created, self._created = self._created, []
        if self._lease is not None:
            self._lease.close()
        for path in created:
            try:
                Files(self._spark, path).delete(path)
            except Exception:
                log.warning("could not drop staged query result %s", path, exc_info=True)

    def _land(self, text: str) -> DataFrame:
        with self._lock:
            if self._closed:
                raise TableflowError(Code.SESSION_STATE, "the read session is closed")
            future = self._landed.get(text)
            mine = future is None
            if mine:
                future = self._landed[text] = Future()
        if mine:
            try:
                future.set_result(self._materialize(text))
            except BaseException as error:
                with self._lock:
                    self._landed.pop(text, None)
                future.set_exception(error)
        return future.result()

    def _materialize(self, text: str) -> DataFrame:
        result = _derived(self._spark, text)
        path = f"{self._root}/query_{uuid.uuid4().hex}"
        with self._lock:
            self._created.append(path)
            if self._lease is None:
                self._lease = FolderLease(self._spark, self)
            self._lease.add(path)
        # The folder is there already, for its lease.
        result.write.mode("append").parquet(path)
        return self._spark.read.schema(result.schema).parquet(path)


def _derived(spark: SparkSession, query: str) -> DataFrame:
    text = query.strip()
    if text.endswith(";"):
        text = text[:-1].rstrip()
    if not text:
        raise TableflowError(Code.BAD_OPTION, "the query text is empty")
    return spark.sql(f"select * from (\n{text}\n)")
