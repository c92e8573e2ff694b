"""Files that say who is at work: the owner of a table's commit, and staged folders still in use.

An owner renews its file from a thread of its own. A file that was not renewed for a while belongs to a dead driver.
"""

from __future__ import annotations

import logging
import threading
import uuid
import weakref
from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import SparkSession

from tableflow.errors import Code, TableflowError
from tableflow.files import Files

log = logging.getLogger(__name__)

#: How often files are renewed, and after how many periods without it their owner counts as dead.
RENEWAL = timedelta(seconds=30)
MISSED = 4

_LEASE, _CLOSED = "_lease", "closed"


def is_alive(age: float) -> bool:
    return age < MISSED * RENEWAL.total_seconds()


class Heartbeat:
    """Calls ``beat`` every ``RENEWAL`` from a thread of its own until it is stopped."""

    def __init__(self, beat: Callable[[], None]):
        self._stopped = threading.Event()
        self._thread = threading.Thread(target=_beat, args=(beat, self._stopped), daemon=True)
        self._thread.start()

    def stop(self) -> None:
        self._stopped.set()
        if self._thread is not threading.current_thread():
            self._thread.join()


def _beat(beat: Callable[[], None], stopped: threading.Event) -> None:
    while not stopped.wait(RENEWAL.total_seconds()):
        try:
            beat()
        except Exception:
            log.warning("could not renew a lease", exc_info=True)


class FolderLease:
    """Keeps staged folders from being swept for as long as ``owner`` is there and the lease is not closed."""

    def __init__(self, spark: SparkSession, owner: object):
        self._spark, self._folders = spark, []
        folders = self._folders
        self._heartbeat = Heartbeat(lambda: [_renew(spark, path) for path in list(folders)])
        weakref.finalize(owner, self._heartbeat.stop)

    def add(self, folder: str) -> None:
        _renew(self._spark, folder)
        self._folders.append(folder)

    def close(self) -> None:
        """The folders may go; should the caller fail to drop one, the sweep does."""
        self._heartbeat.stop()
        for path in self._folders:
            try:
                Files(self._spark, path).write_text(f"{path}/{_LEASE}", _CLOSED)
            except Exception:
                log.warning("could not close the lease of %s", path, exc_info=True)
        self._folders.clear()


def _renew(spark: SparkSession, folder: str) -> None:
    Files(spark, folder).write_text(f"{folder}/{_LEASE}", "open")


def is_leased(spark: SparkSession, folder: str) -> bool:
    """Whether a live session uses a staged folder."""
    files, lease = Files(spark, folder), f"{folder}/{_LEASE}"
    return files.exists(lease) and is_alive(files.age(lease)) and files.read_text(lease) != _CLOSED


class TableLock:
    """The right to change the table at a path, for one owner at a time.

    It is a file next to the table, made only where there is none. A second writer is refused while the owner renews
    it, and takes it over when the owner is dead. ``check`` tells an owner that was cut off for so long that another
    took over; it has to stop then.
    """

    def __init__(self, spark: SparkSession, table: str):
        folder, _, name = table.rpartition("/")
        self._files, self._table, self._path = Files(spark, table), table, f"{folder}/_lock_{name}"
        self._owner = uuid.uuid4().hex
        self._heartbeat: Heartbeat | None = None

    def exists(self) -> bool:
        return self._files.exists(self._path)

    def is_live(self) -> bool:
        return self.exists() and is_alive(self._files.age(self._path))

    def acquire(self) -> None:
        self._files.make_parent(self._path)
        if not self._files.create_new(self._path, self._owner):
            if self.is_live():
                raise TableflowError(Code.COMMIT_IN_PROGRESS, f"another writer is changing {self._table}")
            self._files.delete(self._path)
            if not self._files.create_new(self._path, self._owner):
                raise TableflowError(Code.COMMIT_IN_PROGRESS, f"another writer is changing {self._table}")
        # On a store whose create is not exclusive, the last of two writers has it.
        self.check()
        self._heartbeat = Heartbeat(self._renew)

    def _renew(self) -> None:
        self.check()
        self._files.write_text(self._path, self._owner)

    def check(self) -> None:
        if not self.exists() or self._files.read_text(self._path) != self._owner:
            raise TableflowError(Code.COMMIT_LOST, f"another writer has taken {self._table} over")

    def release(self) -> None:
        if self._heartbeat is not None:
            self._heartbeat.stop()
        try:
            self.check()
            self._files.delete(self._path)
        except Exception:
            log.warning("could not release the lock of %s", self._table, exc_info=True)
