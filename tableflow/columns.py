"""Small helpers for naming columns exactly."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tableflow.errors import Code, TableflowError


def quoted(name: str) -> str:
    """Backtick-quote one name part, so a dot in a column name is not read as nesting."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quoted(name))


def require_columns(wanted: Iterable[str], available: Iterable[str], what: str) -> None:
    """Names compare exactly, whatever ``spark.sql.caseSensitive`` says."""
    known = set(available)
    missing = [name for name in wanted if name not in known]
    if missing:
        raise TableflowError(Code.UNKNOWN_COLUMN, f"{what} not in the table: {', '.join(missing)}")
