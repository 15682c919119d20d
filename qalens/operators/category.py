"""Per-period category counts: shares and the leading category."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from qalens.functions.dates import period_label, period_start
from qalens.operators._util import as_col, ratio

METHODS = ("aggregate", "window")

def period_category_counts(
    df: DataFrame,
    ts: str | Column,
    category: str | Column,
    grain: str = "yyyy",
    *,
    period_name: str = "Year",
    category_name: str = "Name",
    count_name: str = "Count",
) -> DataFrame:
    """Rows per (period, category). Rows without a time are left out (an inner
    join on the period drops them in the SQL form); NULL categories are kept and
    count towards their period's total."""
    start = period_start(ts, grain)
    known = df.filter(as_col(ts).isNotNull())
    if start is None:  # a pattern of the caller's: the label is the group
        label = period_label(ts, grain).alias(period_name)
        return known.groupBy(label, as_col(category).alias(category_name)).agg(F.count(F.lit(1)).alias(count_name))
    counts = known.groupBy(start.alias("__start"), as_col(category).alias(category_name)).agg(
        F.count(F.lit(1)).alias(count_name)
    )
    return counts.select(period_label("__start", grain).alias(period_name), category_name, count_name)


def share_of_period(
    df: DataFrame,
    ts: str | Column,
    category: str | Column,
    grain: str = "yyyy",
    *,
    period_name: str = "Year",
    category_name: str = "Name",
    count_name: str = "Count",
    share_name: str = "Share",
    method: str = "aggregate",
) -> DataFrame:
    """Every (period, category) with its count and its share of the period.

    ``method='aggregate'`` (default): period totals come from a second, tiny
    aggregate of the counts and are joined back. The totals hold one row per
    period, so AQE, which measures them, broadcasts them and the counts never move again;
    if they are too large for that, the sort-merge join's skew handling splits a hot
    period.
    ``method='window'``: ``sum(count) over (partition by period)``, one
    more shuffle of all counts and one task per period.
    """
    counts = period_category_counts(
        df, ts, category, grain,
        period_name=period_name, category_name=category_name, count_name=count_name,
    )
    if method == "window":
        total = F.sum(count_name).over(Window.partitionBy(period_name))
    elif method == "aggregate":
        totals = counts.groupBy(period_name).agg(F.sum(count_name).alias("__total"))
        counts = counts.join(totals, period_name, "inner")
        total = F.col("__total")
    else:
        raise ValueError(f"method must be one of {METHODS}, got {method!r}")
    return counts.select(
        period_name, category_name, count_name, ratio(count_name, total).alias(share_name)
    )


def top_category_per_period(
    df: DataFrame,
    ts: str | Column,
    category: str | Column,
    grain: str = "yyyy",
    *,
    period_name: str = "Year",
    category_name: str = "Name",
    share_name: str = "MaxPercentage",
    ties: str = "first",
    method: str = "aggregate",
) -> DataFrame:
    """The most frequent category of each period and its share of the period.

    The rank is on the integer count, never on the ratio. ``ties='first'``: one
    row per period, equal counts resolved by the smallest category (NULL
    first); ``ties='all'``: every category holding the maximum count.

    ``method='aggregate'`` (default) never gathers a period into one task:
    'first' is a second aggregate ``min(struct(-count, category))`` next to
    ``sum(count)``; 'all' joins the counts to the per-period ``max``/``sum``
    on (period, count) -- the self-join of the SQL text, on pre-aggregated rows.
    ``method='window'`` ranks inside ``Window.partitionBy(period)``.
    """
    cnt = "__count"
    counts = period_category_counts(
        df, ts, category, grain,
        period_name=period_name, category_name=category_name, count_name=cnt,
    )
    return top_category_from_counts(
        counts, period_name=period_name, category_name=category_name, count_name=cnt,
        share_name=share_name, ties=ties, method=method,
    )


def top_category_from_counts(
    counts: DataFrame,
    *,
    period_name: str = "Year",
    category_name: str = "Name",
    count_name: str = "Count",
    share_name: str = "MaxPercentage",
    ties: str = "first",
    method: str = "aggregate",
) -> DataFrame:
    """:func:`top_category_per_period` on rows already counted per (period, category)."""
    if ties not in ("first", "all"):
        raise ValueError("ties must be 'first' or 'all'")
    cnt = count_name
    if method == "window":
        w = Window.partitionBy(period_name)
        if ties == "first":
            pick = F.row_number().over(
                w.orderBy(F.col(cnt).desc(), F.col(category_name).asc_nulls_first())
            )
        else:
            pick = F.rank().over(w.orderBy(F.col(cnt).desc()))
        return (
            counts.select(
                period_name,
                category_name,
                ratio(cnt, F.sum(cnt).over(w)).alias(share_name),
                pick.alias("__rk"),
            )
            .filter(F.col("__rk") == 1)
            .drop("__rk")
        )
    if method != "aggregate":
        raise ValueError(f"method must be one of {METHODS}, got {method!r}")
    if ties == "first":
        best = counts.groupBy(period_name).agg(
            F.sum(cnt).alias("__total"),
            F.min(F.struct((-F.col(cnt)).alias("neg"), F.col(category_name).alias("cat"))).alias("__best"),
        )
        return best.select(
            period_name,
            F.col("__best.cat").alias(category_name),
            ratio(-F.col("__best.neg"), "__total").alias(share_name),
        )
    per_period = counts.groupBy(F.col(period_name).alias("__p")).agg(
        F.max(cnt).alias("__max"), F.sum(cnt).alias("__total")
    )
    return counts.join(
        per_period,
        (F.col(period_name) == F.col("__p")) & (F.col(cnt) == F.col("__max")),
        "inner",
    ).select(period_name, category_name, ratio(cnt, "__total").alias(share_name))
