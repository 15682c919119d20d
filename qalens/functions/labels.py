"""Value labelling and text predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from qalens._columns import as_col


def label_by_value(
    c: str | Column, mapping: Mapping[str, Sequence[object]], default: str
) -> Column:
    """Simple CASE: the first label whose value list holds the value, else ``default``.

    NULL input gets ``default`` too, as in ``CASE x WHEN ... ELSE default END``.
    """
    col = as_col(c)
    expr = None
    for label, values in mapping.items():
        cond = col.isin(list(values))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def not_blank(c: str | Column) -> Column:
    """``c NOT IN ('')``: false for the empty string; NULL (so filtered out) for NULL."""
    return as_col(c) != F.lit("")


def null_if(c: str | Column, value: object) -> Column:
    """NULL where ``c`` equals ``value``."""
    return F.nullif(as_col(c), F.lit(value))
