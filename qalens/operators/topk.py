"""Top-k with explicit tie rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

TIES = ("cut", "keep")


def top_k(
    df: DataFrame,
    by: str,
    k: int,
    *,
    ascending: bool = False,
    tiebreak: Sequence[str] = (),
    ties: str = "cut",
) -> DataFrame:
    """The first ``k`` rows by ``by`` (descending unless ``ascending``); NULLs rank last.

    ``ties='cut'``: exactly ``min(k, rows)`` rows; equal values are ordered by the
    ``tiebreak`` columns, so the cut is deterministic. Plans as
    ``TakeOrderedAndProject``: every task keeps its own k best rows and only
    those reach the final merge.

    ``ties='keep'``: every row whose ``rank()`` is at most ``k``, so may return
    more than ``k``. Computed without a global window: the k-th value is taken
    from a top-k (bounded, k rows) in a scalar subquery, and the table is then
    filtered in parallel with ``by >= kth``. When the first k rows hold a NULL,
    or there are fewer than k rows, every row has rank <= k and all are kept.
    """
    if ties not in TIES:
        raise ValueError(f"ties must be one of {TIES}, got {ties!r}")
    if k < 1:
        raise ValueError("k must be at least 1")
    measure = F.col(by)
    order = measure.asc_nulls_last() if ascending else measure.desc_nulls_last()
    if ties == "cut":
        return df.orderBy(order, *[F.col(c).asc() for c in tiebreak]).limit(k)

    m = F.col("m")
    first_k = (
        df.select(measure.alias("m"))
        .orderBy(m.asc_nulls_last() if ascending else m.desc_nulls_last())
        .limit(k)
    )
    kth = F.max("m") if ascending else F.min("m")
    threshold = first_k.select(
        F.when(
            (F.count(F.lit(1)) < F.lit(k)) | (F.count("m") < F.count(F.lit(1))),
            F.lit(None),
        ).otherwise(kth)
    ).scalar()
    within = measure <= threshold if ascending else measure >= threshold
    return df.filter(F.when(threshold.isNull(), F.lit(True)).otherwise(within))


def top_n_per_group(
    df: DataFrame, group: str | Sequence[str], by: str, n: int, *, ascending: bool = False
) -> DataFrame:
    """The rows of each group whose ``rank()`` by ``by`` (descending unless ``ascending``; NULLs
    last) is at most ``n``, ties included. NULL groups form one group.

    No task sorts a whole group: each task first cuts its rows of a group to its own ``n``
    best (Spark's limit below the shuffle of a row number, for ``n`` up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``, 1,000 by default), these short lists merge into the
    group's n-th value, and the table is then filtered by it in parallel. So a period with a
    third of all rows, or a value with a third of a period's, moves n rows a task.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    keys = [group] if isinstance(group, str) else list(group)
    measure = F.col(by)
    order = measure.asc_nulls_last() if ascending else measure.desc_nulls_last()
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(order))
    lists = df.select(*keys, by).withColumn("__place", place).where(F.col("__place") <= n)
    worst = F.max(by) if ascending else F.min(by)
    # fewer than n rows, or a NULL among the first n: every row has such a rank
    full = (F.count(F.lit(1)) == n) & (F.count(by) == n)
    limits = lists.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.when(full, worst).alias("__limit"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__{k}"))
    within = (measure <= F.col("__limit")) if ascending else (measure >= F.col("__limit"))
    kept = df.join(limits, same).where(F.col("__limit").isNull() | within)
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])
