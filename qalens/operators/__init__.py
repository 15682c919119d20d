"""Reusable DataFrame operators (DataFrame in, DataFrame out)."""

from qalens.operators.attach import attach_columns
from qalens.operators.aggregate import count_by_key, count_by_period, sum_by_key
from qalens.operators.category import (
    period_category_counts,
    share_of_period,
    top_category_from_counts,
    top_category_per_period,
)
from qalens.operators.compare import rows_only_in, schema_diff, table_diff, table_diff_by_tree, union_tagged
from qalens.operators.joins import join_on, join_row_count, key_condition, reduce_by_keys
from qalens.operators.periods import counts_by_condition, full_outer_merge, period_counts, top_by_period_counts
from qalens.operators.positions import row_positions, table_equals_ordered
from qalens.operators.rollup import rollup_children, top_by_rollup
from qalens.operators.sketch import prune_for_top_k
from qalens.operators.topk import top_k, top_n_per_group

__all__ = [
    "attach_columns",
    "count_by_key",
    "count_by_period",
    "counts_by_condition",
    "full_outer_merge",
    "join_on",
    "join_row_count",
    "key_condition",
    "period_category_counts",
    "period_counts",
    "prune_for_top_k",
    "reduce_by_keys",
    "rollup_children",
    "row_positions",
    "rows_only_in",
    "schema_diff",
    "share_of_period",
    "sum_by_key",
    "table_diff",
    "table_diff_by_tree",
    "table_equals_ordered",
    "top_by_period_counts",
    "top_by_rollup",
    "top_category_from_counts",
    "top_category_per_period",
    "top_k",
    "top_n_per_group",
    "union_tagged",
]
