"""Column-level helpers built from ``pyspark.sql.functions`` only."""

from qalens.functions.dates import (
    GRAINS,
    SOURCE_TIMESTAMP_REGEX,
    in_years,
    parse_timestamp,
    period_label,
    period_start,
)
from qalens.functions.labels import label_by_value, not_blank, null_if
from qalens.functions.numbers import cents

__all__ = [
    "GRAINS",
    "SOURCE_TIMESTAMP_REGEX",
    "cents",
    "in_years",
    "label_by_value",
    "not_blank",
    "null_if",
    "parse_timestamp",
    "period_label",
    "period_start",
]
