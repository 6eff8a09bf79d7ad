"""Column arguments may be names or Column objects."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_list(names: str | list[str] | tuple[str, ...]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)
