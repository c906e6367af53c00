"""Column-name helpers.

Wide market files carry names such as ``AC.PA.Open`` or ``1.0``; both need
quoting everywhere, because Spark reads a bare dot as struct access.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Carries the decoded path of the file a row came from, from the scan until the
# last transform has run. Reserved: never part of a result.
PATH_COL = "__source_path"


def q(name: str) -> str:
    """Backtick-quote one column or table name part."""
    return "`" + name.replace("`", "``") + "`"


def literal(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def c(name: str) -> Column:
    return F.col(q(name))


def qtable(name: str) -> str:
    """Quote a table name; ``db.table`` stays two parts, spaces are allowed."""
    return ".".join(q(part) for part in name.split("."))


def data_columns(df: DataFrame) -> list[str]:
    """Columns of ``df`` without the reserved path column."""
    return [name for name in df.columns if name != PATH_COL]


def check_case_collisions(names: Iterable[str]) -> None:
    """Spark resolves names without case; two that differ only by case clash."""
    seen: dict[str, str] = {}
    for name in names:
        other = seen.setdefault(name.lower(), name)
        if other != name:
            raise ValueError(f"Columns {other!r} and {name!r} differ only by case")


def check_distinct(names: Iterable[str]) -> None:
    """Names of a result: no two alike, also apart from case."""
    names = list(names)
    twice = sorted({name for name in names if names.count(name) > 1})
    if twice:
        raise ValueError(f"The result would have several columns named {twice}")
    check_case_collisions(names)


def resolve(df: DataFrame, wanted: Iterable[str]) -> list[str]:
    """Map names to the spelling used by ``df``, ignoring case."""
    by_lower = {name.lower(): name for name in df.columns}
    out = []
    for name in wanted:
        if name.lower() not in by_lower:
            raise ValueError(f"Column {name!r} does not exist; have {df.columns}")
        out.append(by_lower[name.lower()])
    return out
