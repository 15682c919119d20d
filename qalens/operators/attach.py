"""Late materialisation: fetch descriptive columns for the few rows that survive a top-k."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def attach_columns(
    rows: DataFrame,
    key: str,
    dim: DataFrame,
    dim_key: str,
    cols: Sequence[str | Column],
    *,
    bounded: bool,
) -> DataFrame:
    """Inner-join ``rows`` to ``dim`` on ``key = dim_key`` and add ``cols`` of ``dim``.

    ``bounded=True`` promises that ``rows`` are the k rows of a cut top-k and hold keys and
    measures only: they are then broadcast, and ``dim`` is only scanned (pruned to ``cols``)
    and probed, never shuffled. Otherwise AQE picks the join from measured sizes.
    """
    d = dim.select(F.col(dim_key).alias("__attach_key"), *cols)
    side = F.broadcast(rows) if bounded else rows
    return side.join(d, F.col(key) == F.col("__attach_key"), "inner").drop("__attach_key")
