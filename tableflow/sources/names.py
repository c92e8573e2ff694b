"""Table names: ``dataset.table`` or ``project.dataset.table``."""

from __future__ import annotations

import re
from dataclasses import dataclass

from tableflow.columns import quoted
from tableflow.errors import Code, TableflowError

# The characters each part of a name may hold. Python's \w is the letters,
# the numbers and the underscore. The default catalog of Spark has an underscore in its
# name, so the reader accepts one in a project as well.
_PARTS = {
    "project": re.compile(r"[a-z0-9.:_-]+"),
    "dataset": re.compile(r"[A-Za-z0-9_]+"),
    "table": re.compile(r"[\w-]+"),
}


@dataclass(frozen=True)
class TableName:
    project: str
    dataset: str
    table: str

    @property
    def sql(self) -> str:
        return ".".join(quoted(part) for part in (self.project, self.dataset, self.table))

    def __str__(self) -> str:
        return f"{self.project}.{self.dataset}.{self.table}"


def parse_table_name(name: str, default_project: str) -> TableName:
    parts = _split(name)
    if len(parts) == 2:
        parts = [default_project, *parts]
    if len(parts) != 3:
        raise TableflowError(Code.BAD_NAME, f"'{name}' must be dataset.table or project.dataset.table")
    for label, value in zip(_PARTS, parts):
        _check(name, label, value)
    return TableName(*parts)


def _split(name: str) -> list[str]:
    if "`" in name:
        raise TableflowError(Code.BAD_NAME, f"{name}: a name is written without backticks")
    return name.split(".")


def _check(name: str, label: str, value: str) -> None:
    if not _PARTS[label].fullmatch(value):
        raise TableflowError(Code.BAD_NAME, f"'{name}': '{value}' is not a legal {label} name")
