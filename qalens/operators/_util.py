"""Small expression helpers for the operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from qalens._columns import as_col


def ratio(numerator: str | Column, denominator: str | Column) -> Column:
    """Double division. Casting first avoids Spark's decimal result for
    ``count * 1.0 / total``, which rounds to six places."""
    return as_col(numerator).cast("double") / as_col(denominator).cast("double")
