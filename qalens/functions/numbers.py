"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from qalens._columns import as_col


def cents(c: str | Column) -> Column:
    """Money as whole cents (``bigint``), so sums are exact and engine-independent."""
    return F.round(as_col(c) * 100).cast("bigint")
