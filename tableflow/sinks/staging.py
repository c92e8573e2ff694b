"""Staged folders: their names, swapping them into place, and sweeping orphans."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import SparkSession

from tableflow.errors import Code, TableflowError
from tableflow.files import Files
from tableflow.leases import TableLock, is_leased
from tableflow.session import staging_root

log = logging.getLogger(__name__)

# How staged folders are named, and when one nobody dropped is an orphan.
PREFIXES = ("query_", "load_")
ORPHAN_AGE = timedelta(hours=6)

# What a commit keeps next to a table while it lasts.
_NEW, _OLD, _JOURNAL = "_new_", "_old_", "_swap_"


def expire_staging(
    spark: SparkSession,
    staging_dir: str | None = None,
    older_than: timedelta = ORPHAN_AGE,
    datasets: Iterable[str] = (),
) -> list[str]:
    """Drop staged folders left by sessions that never closed; returns what was dropped.

    A folder that a live session holds stays, however long it has been idle. The age of any
    other is that of the newest file anywhere in it. ``datasets`` are folders of tables, to
    sweep the copies that a dead commit left next to them; a commit that stopped half-way is
    undone first, and what belongs to a live one stays.
    """
    root, limit = staging_root(spark, staging_dir), older_than.total_seconds()
    files = Files(spark, root)
    stale = [
        path
        for name, path, _ in files.children(root)
        if name.startswith(PREFIXES) and files.newest_age(path) >= limit and not is_leased(spark, path)
    ]
    for folder in datasets:
        files = Files(spark, folder)
        for name, _, age in files.children(folder):
            if name.startswith(_JOURNAL) and age >= limit:
                table = f"{folder.rstrip('/')}/{name[len(_JOURNAL) : -len('.json')]}"
                if not TableLock(spark, table).is_live():
                    recover_table(spark, table)
        stale += [
            path
            for name, path, _ in files.children(folder)
            if name.startswith((_NEW, _OLD))
            and files.newest_age(path) >= limit
            and not TableLock(spark, f"{folder.rstrip('/')}/{name.split('_', 3)[3]}").is_live()
        ]
    return [path for path in stale if drop_quietly(spark, path)]


def drop_quietly(spark: SparkSession, path: str) -> bool:
    """Cleanup never hides the outcome of the work before it."""
    try:
        Files(spark, path).delete(path)
        return True
    except Exception:
        log.warning("could not drop staged folder %s", path, exc_info=True)
        return False


def swap_folders(spark: SparkSession, table: str, pairs: list[tuple[str, str]], lock: TableLock) -> None:
    """Move each new folder of ``table`` onto its live path; on failure put every old one back.

    The caller holds ``lock``. The moves are written next to the table first, so that after a
    dead driver the next writer that takes the lock undoes them. Readers of a path see the old or the new folder, apart from the moment
    between two renames. On a store without an atomic rename, use a catalog that has one.
    """
    if not pairs:
        return
    files = Files(spark, table)
    moves = []
    for new, live in pairs:
        # A leading underscore keeps the retired folder out of table listings.
        folder, _, name = live.rpartition("/")
        old = f"{folder}/{_OLD}{uuid.uuid4().hex}_{name}"
        moves.append([new, live, old if files.exists(live) else None])
    journal = _journal(table)
    lock.check()
    files.write_text(journal, json.dumps(moves))
    try:
        for new, live, old in moves:
            lock.check()
            if old is None:
                files.make_parent(live)
            else:
                files.rename(live, old)
            files.rename(new, live)
        lock.check()
    except BaseException as error:
        # Whoever took the table over undoes the moves.
        if not (isinstance(error, TableflowError) and error.code is Code.COMMIT_LOST):
            undo_swap(spark, journal)
        raise
    # From here the commit holds: an empty list undoes nothing, even if it cannot be removed.
    files.write_text(journal, "[]")
    drop_quietly(spark, journal)
    for _, _, old in moves:
        if old is not None:
            drop_quietly(spark, old)


def _journal(table: str) -> str:
    folder, _, name = table.rpartition("/")
    return f"{folder}/{_JOURNAL}{name}.json"


def undo_swap(spark: SparkSession, journal: str) -> None:
    """Bring the folders of a commit that stopped half-way back to where they were."""
    files = Files(spark, journal)
    for new, live, old in reversed(json.loads(files.read_text(journal) or "[]")):
        if files.exists(new) and (old is None or not files.exists(old)):
            continue
        if not files.exists(new) and files.exists(live):
            files.rename(live, new)
        if old is not None and files.exists(old):
            files.rename(old, live)
    files.delete(journal)


@contextmanager
def locked_table(spark: SparkSession, table: str) -> Iterator[TableLock]:
    """The lock of a table; a commit that its dead owner left half-way is undone first."""
    lock = TableLock(spark, table)
    lock.acquire()
    try:
        if Files(spark, table).exists(_journal(table)):
            undo_swap(spark, _journal(table))
        yield lock
    finally:
        lock.release()


def recover_table(spark: SparkSession, table: str) -> None:
    """Undo the commit to ``table`` that a dead driver left half-way, if there is one; a live one is refused."""
    if TableLock(spark, table).exists() or Files(spark, table).exists(_journal(table)):
        with locked_table(spark, table):
            pass
