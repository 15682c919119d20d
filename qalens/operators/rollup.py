"""Roll child rows up to their parents and owners, then rank."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from qalens.operators._util import as_col
from qalens.operators.attach import attach_columns
from qalens.operators.joins import reduce_by_keys
from qalens.operators.sketch import prune_for_top_k
from qalens.operators.topk import top_k


def _key_match(left: Column, right: Column, null_safe: bool) -> Column:
    return left.eqNullSafe(right) if null_safe else left == right


def _final_order(df: DataFrame, measure: str, key: str, k: int, ties: str) -> DataFrame:
    ordered = df.orderBy(F.col(measure).desc_nulls_last(), F.col(key).asc())
    return ordered.limit(k) if ties == "cut" else ordered


def top_by_rollup(
    dim: DataFrame,
    fact: DataFrame,
    *,
    dim_key: str,
    fact_key: str,
    measure: str | Column,
    dim_cols: Sequence[str] = (),
    fact_filter: Column | None = None,
    measure_name: str = "total",
    k: int = 10,
    ties: str = "cut",
    null_safe: bool = False,
    prune: bool = False,
) -> DataFrame:
    """Sum ``measure`` over the (filtered) fact rows of each key, attach the
    dimension columns, keep the top ``k`` by the sum (ties broken by ``dim_key``).

    Output, ordered: ``dim_key``, ``dim_cols``, ``measure_name``. A key whose
    values are all NULL gets a NULL sum, which ranks last. Fact rows with a
    NULL or unknown key are dropped (``null_safe=True`` matches NULL to NULL);
    ``dim_key`` must be unique.

    Plan: the sum is computed per key *before* the join, so the join sees one
    row per key (the aggregate's output is already partitioned by key and is
    not shuffled again); the top-k runs per task and merges k rows. The
    dimension contributes only ``dim_key`` and ``dim_cols`` (pruned scan).

    ``prune=True`` first finds, with a sketch, the keys that can be among the first ``k``
    (:func:`qalens.operators.sketch.prune_for_top_k`; its scans run at once) and groups their
    rows only: for tables with many more keys than a task can pre-aggregate.
    """
    facts = fact.filter(fact_filter) if fact_filter is not None else fact
    if prune:
        known = dim.select(F.col(dim_key).alias("__known"))
        facts = prune_for_top_k(
            facts, fact_key, measure, k,
            eligible=lambda sums, key: sums.join(known, _key_match(F.col(key), F.col("__known"), null_safe), "left_semi"),
        ).rows
    per_key = facts.groupBy(F.col(fact_key).alias("__key")).agg(
        F.sum(as_col(measure)).alias(measure_name)
    )
    dims = dim.select(F.col(dim_key).alias("__dkey"), *dim_cols)
    joined = per_key.join(
        dims, _key_match(per_key["__key"], dims["__dkey"], null_safe), "inner"
    ).select(F.col("__dkey").alias(dim_key), *dim_cols, measure_name)
    ranked = top_k(joined, measure_name, k, tiebreak=[dim_key], ties=ties)
    return ranked if ties == "cut" else _final_order(ranked, measure_name, dim_key, k, ties)


def rollup_children(
    child: DataFrame,
    parent: DataFrame,
    owner: DataFrame,
    *,
    child_parent_key: str,
    child_score: str | Column,
    parent_key: str,
    parent_owner_key: str,
    owner_key: str,
    parent_cols: Sequence[str] = (),
    owner_cols: Sequence[str] = (),
    parent_filter: Column | None = None,
    score_name: str = "total_score",
    k: int = 10,
    ties: str = "cut",
    late: bool = True,
    prune: bool = False,
    reduce: bool = False,
) -> DataFrame:
    """Sum child scores per parent, join the (filtered) parents and their owners,
    keep the top ``k`` parents by the sum, ties broken by ``parent_key``.

    Output, ordered: ``parent_cols``, ``score_name``, ``owner_cols``. Parents
    without an owner row, and children with a NULL parent, drop out (inner
    joins). ``owner_key`` must be unique; a ``parent_key`` that occurs twice is two rows.

    Plan: the child table is partially and finally aggregated to one row per
    parent; that joins the parents' (key, owner) pairs only, and the owner check
    is a key-only semi-join, so the shuffles carry keys and scores, never text.
    The top-k runs per task and merges k rows; the parent and owner columns are
    then fetched for those k rows through broadcasts of their keys alone, so the
    parent and owner tables are scanned (pruned) and probed but not shuffled, and
    the two k-row results are joined.

    ``late=False`` joins the parent and owner columns before the top-k instead:
    fewer stages, so faster when both tables are small enough to be broadcast,
    but at size their text columns would cross the shuffles.

    ``prune=True`` first finds, with a sketch, the parents that can be among the first ``k``
    (see :func:`top_by_rollup`) and sums their children only.

    ``reduce=True`` leaves out, where the children are scanned, those of parents that
    ``parent_filter`` drops (a bitmap of integer parent keys, broadcast if it is small enough:
    :func:`qalens.operators.joins.reduce_by_keys`), so that they are never shuffled.
    """
    names = [*parent_cols, score_name, *owner_cols]
    if len(set(names)) != len(names):
        raise ValueError(f"output columns must be distinct, got {names}")
    if reduce:
        child = reduce_by_keys(child, child_parent_key, parent.filter(parent_filter) if parent_filter is not None else parent, parent_key)
    if prune:
        owned = parent.filter(parent_filter) if parent_filter is not None else parent
        owned = owned.select(F.col(parent_key).alias("__known"), F.col(parent_owner_key).alias("__by")).join(
            owner.select(F.col(owner_key).alias("__okey")), F.col("__by") == F.col("__okey"), "left_semi"
        )
        child = prune_for_top_k(
            child, child_parent_key, child_score, k,
            eligible=lambda sums, key: sums.join(owned, F.col(key) == F.col("__known"), "left_semi"),
        ).rows
    scores = child.groupBy(F.col(child_parent_key).alias("__parent")).agg(
        F.sum(as_col(child_score)).alias(score_name)
    )
    parents = parent.filter(parent_filter) if parent_filter is not None else parent
    if not late:
        wide = scores.join(
            parents.select(
                F.col(parent_key).alias("__pkey"), F.col(parent_owner_key).alias("__powner"),
                *parent_cols,
            ),
            F.col("__parent") == F.col("__pkey"),
            "inner",
        ).join(
            owner.select(F.col(owner_key).alias("__okey"), *owner_cols),
            F.col("__powner") == F.col("__okey"),
            "inner",
        )
        ranked = _final_order(
            top_k(wide, score_name, k, tiebreak=["__pkey"], ties=ties), score_name, "__pkey", k, ties
        )
        return ranked.select(*parent_cols, score_name, *owner_cols)
    links = parents.select(F.col(parent_key).alias("__pkey"), F.col(parent_owner_key).alias("__powner"))
    owner_keys = owner.select(F.col(owner_key).alias("__okey"))
    candidates = (
        scores.join(links, F.col("__parent") == F.col("__pkey"), "inner")
        .join(owner_keys, F.col("__powner") == F.col("__okey"), "left_semi")
        .select("__pkey", "__powner", score_name)
    )
    top = top_k(candidates, score_name, k, tiebreak=["__pkey"], ties=ties)
    # a parent key that occurs twice is in the top twice, and is fetched twice below
    top, cut = top.distinct(), ties == "cut"
    with_parent = attach_columns(
        top, "__pkey", parents.withColumn("__same_owner", F.col(parent_owner_key)), parent_key,
        [*parent_cols, "__same_owner"], bounded=cut,
    ).where(F.col("__powner") == F.col("__same_owner"))
    owners = attach_columns(
        top.select(F.col("__powner").alias("__owner")).distinct(), "__owner", owner, owner_key, owner_cols, bounded=cut
    )
    full = with_parent.join(owners, F.col("__powner") == F.col("__owner"), "inner")
    ranked = _final_order(full, score_name, "__pkey", k, ties)
    return ranked.select(*parent_cols, score_name, *owner_cols)
