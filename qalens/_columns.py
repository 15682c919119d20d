"""Column argument helper shared by functions and operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c: str | Column) -> Column:
    """A column given by name or as an expression."""
    return F.col(c) if isinstance(c, str) else c
