"""Parsing a column of table names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableflow.columns import col, require_columns

# The characters each part of a name may hold.
_PATTERNS = {
    "project": r"\A[a-z0-9.:-]+\z",
    "dataset": r"\A[A-Za-z0-9_]+\z",
    "table": r"\A[\p{L}\p{N}_-]+\z",
}

_PARTS = "_name_parts"


def parse_table_names(df: DataFrame, name_col: str, default_project: str) -> DataFrame:
    """Adds ``project``, ``dataset``, ``table`` and ``error``; the first three are NULL on error.

    A name has two or three parts; two-part names are in ``default_project``.
    """
    require_columns([name_col], df.columns, "name column")
    # The parts are a column of their own, so that a name is split once.
    df = df.withColumn(_PARTS, F.split(col(name_col), r"\.", -1))
    name, parts = col(name_col), F.col(_PARTS)
    pieces = {
        "project": F.when(F.size(parts) == 2, F.lit(default_project)).otherwise(F.get(parts, F.lit(0))),
        "dataset": F.get(parts, F.size(parts) - 2),
        "table": F.get(parts, F.size(parts) - 1),
    }
    error = (
        F.when(name.isNull(), F.lit("no name"))
        .when(F.contains(name, F.lit("`")), F.lit("backticks are not part of a name"))
        .when(~F.size(parts).isin(2, 3), F.lit("not dataset.table or project.dataset.table"))
    )
    for label, pattern in _PATTERNS.items():
        error = error.when(~pieces[label].rlike(pattern), F.concat(F.lit(f"illegal {label}: "), pieces[label]))
    parsed = df.withColumn("error", error)
    good = F.col("error").isNull()
    return parsed.withColumns({label: F.when(good, piece) for label, piece in pieces.items()}).drop(_PARTS)
