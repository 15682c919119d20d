"""Equi-joins with an explicit NULL-key policy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qalens.sources.sinks import stored


def key_condition(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str],
    right_on: Sequence[str],
    null_safe: bool = False,
) -> Column:
    """``l1 = r1 AND l2 = r2 ...``; with ``null_safe`` NULL matches NULL
    (``<=>``, the R and pandas merge behaviour)."""
    if len(left_on) != len(right_on) or not left_on:
        raise ValueError("left_on and right_on must be non-empty and of equal length")
    cond = None
    for lc, rc in zip(left_on, right_on):
        part = left[lc].eqNullSafe(right[rc]) if null_safe else left[lc] == right[rc]
        cond = part if cond is None else cond & part
    return cond


def join_on(
    left: DataFrame,
    right: DataFrame,
    left_on: Sequence[str],
    right_on: Sequence[str],
    how: str = "inner",
    *,
    null_safe: bool = False,
) -> DataFrame:
    """Join on differently named keys. The strategy (broadcast, shuffled hash,
    sort-merge) is left to AQE, which broadcasts only a side measured below
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``."""
    return left.join(right, key_condition(left, right, left_on, right_on, null_safe), how)


#: Bytes that the bitmap of :func:`reduce_by_keys` may take on every executor, and what one of
#: its rows (64 ids) takes there.
MAX_BITMAP_BYTES, BITMAP_ROW_BYTES = 64 << 20, 64


def reduce_by_keys(
    rows: DataFrame,
    key: str,
    known: DataFrame,
    known_key: str,
    *,
    max_bytes: int = MAX_BITMAP_BYTES,
) -> DataFrame:
    """The rows whose integer ``key`` occurs as ``known_key``, found before anything is shuffled.

    The known ids become a bitmap of 64-id words, written once; its rows are counted, and only
    if they fit in ``max_bytes`` is it broadcast and every row tested where it is scanned.
    Otherwise the rows are semi-joined in the ordinary way. Either way each row comes at most
    once, however often its key is known; NULL keys drop out.
    """
    ids = known.select(F.col(known_key).cast("bigint").alias("__id")).where("__id IS NOT NULL")
    bit = F.expr("shiftleft(1L, cast(__id & 63 AS int))")
    words = ids.groupBy(F.shiftright("__id", 6).alias("__word")).agg(F.bit_or(bit).alias("__bits"))
    words = stored(words, "key-bitmap")
    if words.count() * BITMAP_ROW_BYTES > max_bytes:
        return rows.join(ids.select("__id"), F.col(key).cast("bigint") == F.col("__id"), "left_semi")
    wanted = F.col(key).cast("bigint")
    tested = rows.join(F.broadcast(words), F.shiftright(wanted, 6) == F.col("__word"))
    hit = F.getbit(F.col("__bits"), wanted.bitwiseAND(63).cast("int")) == 1
    return tested.where(hit).select(*[F.col(f"`{c}`") for c in rows.columns])


def join_row_count(
    left: DataFrame,
    right: DataFrame,
    left_key: str | Column,
    right_key: str | Column,
    *,
    null_safe: bool = False,
    count_name: str = "n",
) -> DataFrame:
    """Number of rows an inner equi-join would produce, as a one-row table.

    Each side is first reduced to (key, rows) with partial aggregation; the
    join then matches one row per key and sums ``left_rows * right_rows``. The
    pairs of a hot key (or of the NULL key under ``null_safe``) are counted, not
    produced.
    """
    lk = F.col(left_key) if isinstance(left_key, str) else left_key
    rk = F.col(right_key) if isinstance(right_key, str) else right_key
    lc = left.groupBy(lk.alias("__k")).agg(F.count(F.lit(1)).alias("__ln"))
    rc = right.groupBy(rk.alias("__k2")).agg(F.count(F.lit(1)).alias("__rn"))
    cond = lc["__k"].eqNullSafe(rc["__k2"]) if null_safe else lc["__k"] == rc["__k2"]
    return lc.join(rc, cond, "inner").agg(
        F.coalesce(F.sum(F.col("__ln") * F.col("__rn")), F.lit(0)).cast("bigint").alias(count_name)
    )
