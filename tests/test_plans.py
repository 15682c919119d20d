"""Plan checks: no Python in any plan, pruning, pushdown, shuffle counts."""

import contextlib

import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from qalens.plans import analyses as A
from qalens.plans.inspect import count_nodes, plan_text, shuffled_columns, summary

# keys that read back what they wrote plan only the reading
KEYS = sorted(k for k in {**entry.WORKLOADS, **entry.SITE_WORKLOADS} if "roundtrip" not in k and "csv" not in k)


@pytest.mark.parametrize("key", KEYS)
def test_no_python_and_pruned_scans(spark, key):
    df = entry.queries()[key](spark, SF_SMALL)
    s = summary(df)
    assert s["python"] == 0
    # no scan reads a whole wide table for a narrow query
    for schema in s["read_schemas"]:
        assert schema.count(":") <= 7, schema


def test_filters_reach_the_scan(spark):
    s = summary(entry.queries()["top_owner"](spark, SF_SMALL))
    assert any("EqualTo(o_orderstatus,F)" in p for p in s["pushed_filters"])
    assert "struct<o_custkey:bigint,o_orderstatus:string,o_totalprice:double>" in s["read_schemas"]
    s = summary(entry.queries()["period_pivot"](spark, SF_SMALL))
    assert any("Not(EqualTo(p_name,))" in p for p in s["pushed_filters"])
    assert any("In(l_returnflag" in p for p in s["pushed_filters"])


def test_q3_one_scan_and_no_window_by_default(spark, site):
    df = A.top_badge_per_year(site["Badges"])
    assert count_nodes(df, "Window") == 0
    df = entry.queries()["argmax_one"](spark, SF_SMALL)
    s = summary(df)
    assert s["scans"] == 1 and s["windows"] == 0 and s["exchanges"] == 2


def test_q5_single_shuffle_of_votes_before_join(spark):
    df = entry.queries()["period_pivot"](spark, SF_SMALL)
    text = plan_text(df)
    # one hash exchange: the per-part aggregate; the pivot adds none
    assert text.count("hashpartitioning(") == 1, text
    assert count_nodes(df, "Expand") == 0  # no pivot/grouping-sets expansion


def test_top_k_keep_has_no_global_window(spark):
    df = entry.queries()["topn_ties"](spark, SF_SMALL)
    assert count_nodes(df, "Window") == 0
    assert "SinglePartition" not in plan_text(df).split("===== Subqueries =====")[0]


def test_counts_shuffle_is_reused_for_totals(spark):
    df = entry.queries()["window_share"](spark, SF_SMALL)
    df.collect()
    assert "ReusedExchange" in plan_text(df)


@contextlib.contextmanager
def no_auto_broadcast(spark):
    """Plan as if every table were too large to broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    old = {k: spark.conf.get(k) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def _shuffled_columns(df):
    return [", ".join(cols) for cols in shuffled_columns(df)]


@pytest.mark.parametrize(
    "key, text_cols",
    [
        ("child_score", ["o_orderpriority", "o_totalprice", "c_name", "c_mktsegment"]),
        ("period_pivot", ["p_name"]),
    ],
)
def test_top_k_shuffles_keys_only_and_fetches_text_for_k_rows(spark, key, text_cols):
    with no_auto_broadcast(spark):
        df = entry.queries()[key](spark, SF_SMALL)
        shuffled = _shuffled_columns(df)
        assert shuffled, "expected shuffles when broadcasts are off"
        wide = [x for x in shuffled if any(c in x for c in text_cols)]
        # texts move only with the k winners: the join of what was fetched for them
        assert all("__owner" in x or "__powner" in x for x in wide) and len(wide) <= 2, wide
        assert key == "child_score" or not wide
        # the only broadcasts are the explicit ones of k rows
        assert count_nodes(df, "BroadcastExchange") >= (2 if key == "child_score" else 1)
        assert len(df.collect()) == (20 if key == "period_pivot" else 10)


@pytest.mark.parametrize("grain", ["yyyy", "yyyy-MM", "yyyy-MM-dd"])
def test_period_totals_are_left_to_measured_sizes(spark, grain):
    from qalens.operators import share_of_period, top_category_per_period

    o = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    for df in (
        share_of_period(o, "o_orderdate", "o_orderpriority", grain),
        top_category_per_period(o, "o_orderdate", "o_orderpriority", grain, ties="all"),
    ):
        assert "strategy=broadcast" not in plan_text(df, mode="extended").split("== Physical Plan ==")[0]


@pytest.mark.parametrize("key", ["site_q4_top_questions_by_comment_score", "site_sql_q4_top_questions_by_comment_score",
                                 "site_q5_dated_posts", "site_sql_q5_dated_posts"])
def test_texts_move_only_with_the_winners(spark, key):
    with no_auto_broadcast(spark):
        df = entry.queries()[key](spark, SF_SMALL)
        texts = ("o_orderpriority", "c_name", "c_mktsegment", "Title", "DisplayName")
        wide = [x for x in _shuffled_columns(df) if any(c in x for c in texts)]
        # Q4 joins the posts and the owners fetched for the ten winners; nothing else is moved
        assert len(wide) <= (0 if "q5" in key else 2), wide
        assert len(df.collect()) == (20 if "q5" in key else 10)
