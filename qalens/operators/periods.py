"""Before / during / after style pivots of event counts per entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qalens.operators._util import as_col
from qalens.operators.attach import attach_columns
from qalens.operators.topk import top_k


def counts_by_condition(
    df: DataFrame,
    entity: str | Column,
    conditions: Mapping[str, Column],
    *,
    entity_name: str,
    total_name: str = "total",
    where: Column | None = None,
) -> DataFrame:
    """One row per entity: for each output column the rows that meet its condition (NULL does
    not), and the total. One scan, one shuffle, partial counts before it; a condition on plain
    columns (a time range) is evaluated without formatting anything."""
    src = df.filter(where) if where is not None else df
    aggs = [F.count_if(cond).alias(name) for name, cond in conditions.items()]
    return src.groupBy(as_col(entity).alias(entity_name)).agg(*aggs, F.count(F.lit(1)).alias(total_name))


def period_counts(
    df: DataFrame,
    entity: str | Column,
    label: Column,
    columns: Mapping[str, str],
    *,
    entity_name: str,
    total_name: str = "total",
    where: Column | None = None,
) -> DataFrame:
    """One row per entity: a count per label value and the total, in one aggregate.

    ``label`` is a per-row label expression (e.g. a CASE over the year) and
    ``columns`` maps each label value to its output column, in output order.
    Rows whose label is not listed count only towards the total. Replaces the
    two-level group-then-pivot and the split-then-full-join forms; where the labels are
    ranges of a column, :func:`counts_by_condition` spares the label.
    """
    conditions = {name: label == F.lit(value) for value, name in columns.items()}
    return counts_by_condition(df, entity, conditions, entity_name=entity_name, total_name=total_name, where=where)


def top_by_period_counts(
    entities: DataFrame,
    counts: DataFrame,
    *,
    entity_key: str,
    count_key: str,
    lead: str,
    total: str,
    entity_cols: Sequence[Column] = (),
    entity_filter: Column | None = None,
    min_lead: int = 0,
    k: int = 20,
    ties: str = "cut",
    late: bool = True,
) -> DataFrame:
    """Join per-entity period counts to their entities, keep those with more than
    ``min_lead`` in the ``lead`` column, rank by ``lead`` then ``total`` (both
    descending) then ``count_key``, keep ``k``.

    Output, ordered: ``entity_cols``, then every column of ``counts``;
    ``entity_key`` must be unique. Plan: the ``lead`` filter runs on the counts
    and the ``entity_filter`` on the entity scan; the counts are matched to the
    entity keys by a key-only semi-join and ranked; the ``entity_cols`` (e.g. a
    title) are fetched for the k winners only, through a broadcast of k rows.
    ``ties='keep'`` returns every entity whose ``rank()`` on ``lead`` alone is
    at most ``k``. ``late=False`` joins the entity columns before ranking
    (fewer stages; the columns then cross the join's shuffle at size).
    """
    if ties not in ("cut", "keep"):
        raise ValueError(f"ties must be 'cut' or 'keep', got {ties!r}")
    ents = entities.filter(entity_filter) if entity_filter is not None else entities
    keys = ents.select(F.col(entity_key).alias("__ekey"))
    cnts = counts.filter(F.col(lead) > F.lit(min_lead))
    order = [F.col(lead).desc_nulls_last(), F.col(total).desc_nulls_last(), F.col(count_key).asc()]
    names = ents.select(*entity_cols).columns
    if not late:
        wide = ents.select(F.col(entity_key).alias("__ekey"), *entity_cols).join(
            cnts, F.col("__ekey") == cnts[count_key], "inner"
        ).select(*names, *counts.columns)
        if ties == "keep":
            return top_k(wide, lead, k, ties="keep").orderBy(*order)
        return wide.orderBy(*order).limit(k)
    known = cnts.join(keys, cnts[count_key] == keys["__ekey"], "left_semi")
    if ties == "keep":
        top = top_k(known, lead, k, ties="keep")
    else:
        top = known.orderBy(*order).limit(k)
    full = attach_columns(
        top, count_key, ents, entity_key, entity_cols, bounded=ties == "cut"
    )
    out = full.select(*names, *counts.columns).orderBy(*order)
    return out if ties == "keep" else out.limit(k)


def full_outer_merge(
    left: DataFrame,
    right: DataFrame,
    key: str,
    *,
    fill_value: int = 0,
    total_name: str | None = None,
    null_safe: bool = False,
) -> DataFrame:
    """Full outer join of two per-key tables on ``key``; the key is coalesced
    from both sides and missing measures become ``fill_value`` (the key is never
    filled). Optionally adds the sum of all measures as ``total_name``.

    A NULL key matches nothing (SQL's ``=``), so one on each side gives two rows;
    ``null_safe=True`` makes them one (the data-frame merges' behaviour).

    When both inputs are aggregates on ``key`` they are already hash-partitioned
    on it and the sort-merge join adds no exchange.
    """
    l_measures = [c for c in left.columns if c != key]
    r_measures = [c for c in right.columns if c != key]
    shared = sorted(set(l_measures) & set(r_measures))
    if shared:
        raise ValueError(f"both sides have measure columns {shared}; rename one side first")
    lhs = left.withColumnRenamed(key, "__lk")
    rhs = right.withColumnRenamed(key, "__rk")
    same = F.col("__lk").eqNullSafe(F.col("__rk")) if null_safe else F.col("__lk") == F.col("__rk")
    joined = lhs.join(rhs, same, "full_outer")
    measures = [
        F.coalesce(F.col(c), F.lit(fill_value)).alias(c) for c in l_measures + r_measures
    ]
    out = joined.select(F.coalesce(F.col("__lk"), F.col("__rk")).alias(key), *measures)
    if total_name:
        names = l_measures + r_measures
        sum_expr = F.col(names[0])
        for n in names[1:]:
            sum_expr = sum_expr + F.col(n)
        out = out.withColumn(total_name, sum_expr)
    return out
