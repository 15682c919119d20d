"""Workloads on the supplied TPC-H-like tables, one per operator family.

Each takes ``(spark, data_dir)`` and returns a lazy DataFrame. The supplied
tables stand in for the site's: customer/orders for Users/Posts,
lineitem/orders/customer for Comments/Posts/Users, part/lineitem for
Posts/Votes, orders.o_orderpriority as the badge name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.functions.dates import in_years, parse_timestamp, period_label
from qalens.functions.labels import label_by_value, not_blank, null_if
from qalens.functions.numbers import cents
from qalens.operators import (
    count_by_key,
    count_by_period,
    counts_by_condition,
    full_outer_merge,
    join_on,
    join_row_count,
    period_counts,
    rollup_children,
    share_of_period,
    sum_by_key,
    table_diff,
    top_by_period_counts,
    top_by_rollup,
    top_category_per_period,
    top_k,
    union_tagged,
)
from qalens.plans.sql import run_sql
from qalens.session import shared_dir
from qalens.sources.csv import read_csv
from qalens.sources.sinks import write_csv, write_parquet
from qalens.sources.supplied import SUPPLIED_SCHEMAS, read_supplied
from qalens.streaming import (
    read_stream,
    run_to_completion,
    start_count_by_period,
    start_top_category_per_period,
)

# Fixed values of the stand-in workloads.
FINISHED = "F"
VOTE_FLAGS = ("A", "R")
PART_PERIODS = {"after": ("2001",), "during": ("2000", "1999", "1998")}
PART_PERIOD_COLUMNS = {
    "before": "BeforeCOVIDVotes",
    "during": "DuringCOVIDVotes",
    "after": "AfterCOVIDVotes",
}
EARLY_CUTOFF = "1995-03-01"
LATE_CUTOFF = "2001-06-01"
MIN_FLAGGED_LINES = 25
CSV_FILES = 8
NULL_PRIORITY = "5-LOW"
EMPTY_PRIORITY = "1-URGENT"
SITE_TS_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSS"


def table(spark: SparkSession, data_dir: str, name: str) -> DataFrame:
    return read_supplied(spark, data_dir, name)


# --- Q1: counts per period -------------------------------------------------

def year_count(spark, d):
    return count_by_period(table(spark, d, "orders"), "o_orderdate", "yyyy")


def sql_year_count(spark, d):
    return run_sql(
        spark,
        "SELECT date_format(o_orderdate, 'yyyy') AS Year, COUNT(*) AS TotalNumber "
        "FROM {orders} GROUP BY Year",
        {"orders": table(spark, d, "orders")},
    )


def dirty_dates(spark, d):
    """Order dates rendered as site text, with some rows made unparseable,
    NULL or empty; parsed back and counted per year."""
    o = table(spark, d, "orders")
    low = F.col("o_orderpriority") == NULL_PRIORITY
    text = (
        F.when(low & (F.col("o_orderstatus") == "P"), F.lit("not a date"))
        .when(low & (F.col("o_orderstatus") == "O"), F.lit(None).cast("string"))
        .when(low, F.lit(""))
        .otherwise(F.date_format("o_orderdate", SITE_TS_TEXT))
    )
    posts = o.select(parse_timestamp(text).alias("CreationDate"))
    return count_by_period(posts, "CreationDate", "yyyy")


# --- Q2: roll-up to owners, top-k -----------------------------------------

def top_owner(spark, d):
    return top_by_rollup(
        table(spark, d, "customer").select(
            F.col("c_custkey").alias("Id"), F.col("c_name").alias("DisplayName")
        ),
        table(spark, d, "orders"),
        dim_key="Id",
        fact_key="o_custkey",
        measure=cents("o_totalprice"),
        dim_cols=["DisplayName"],
        fact_filter=F.col("o_orderstatus") == FINISHED,
        measure_name="TotalViews",
        k=10,
    )


def topn_ties(spark, d):
    lines = count_by_key(table(spark, d, "lineitem"), "l_orderkey", count_name="n_lines")
    return top_k(lines, "n_lines", 10, ties="keep")


# --- Q3: leading category per period --------------------------------------

def _argmax(spark, d, ties, method):
    return top_category_per_period(
        table(spark, d, "orders"), "o_orderdate", "o_orderpriority", "yyyy",
        ties=ties, method=method,
    )


def argmax_ties(spark, d):
    return _argmax(spark, d, "all", "aggregate")


def argmax_one(spark, d):
    return _argmax(spark, d, "first", "aggregate")


def argmax_join(spark, d):
    return _argmax(spark, d, "all", "aggregate")


def window_share(spark, d):
    return share_of_period(
        table(spark, d, "events"), "ts", "event_type", "yyyy-MM-dd",
        period_name="Day", category_name="event_type", count_name="Count", share_name="Share",
    )


# --- Q4: child scores rolled up through two joins -------------------------

def child_score(spark, d):
    return rollup_children(
        table(spark, d, "lineitem"),
        table(spark, d, "orders"),
        table(spark, d, "customer"),
        child_parent_key="l_orderkey",
        child_score=F.col("l_quantity").cast("bigint"),
        parent_key="o_orderkey",
        parent_owner_key="o_custkey",
        owner_key="c_custkey",
        parent_cols=["o_orderkey", "o_orderpriority", "o_totalprice"],
        owner_cols=["c_name", "c_acctbal", "c_mktsegment"],
        parent_filter=F.col("o_orderstatus") == FINISHED,
        score_name="CommentsTotalScore",
        k=10,
    )


# --- Q5: period pivot, filter, two-key top-k ------------------------------

def part_vote_counts(spark, d):
    during, after = (in_years("l_shipdate", PART_PERIODS[p]) for p in ("during", "after"))
    conditions = {
        PART_PERIOD_COLUMNS["before"]: ~(during | after),
        PART_PERIOD_COLUMNS["during"]: during,
        PART_PERIOD_COLUMNS["after"]: after,
    }
    return counts_by_condition(
        table(spark, d, "lineitem"), "l_partkey", conditions,
        entity_name="PostId", total_name="Votes",
        where=F.col("l_returnflag").isin(list(VOTE_FLAGS)),
    )


def period_pivot(spark, d):
    return top_by_period_counts(
        table(spark, d, "part"),
        part_vote_counts(spark, d),
        entity_key="p_partkey",
        count_key="PostId",
        lead="DuringCOVIDVotes",
        total="Votes",
        entity_cols=[F.col("p_name").alias("Title")],
        entity_filter=not_blank("p_name"),
        k=20,
    )


def having_min(spark, d):
    return count_by_key(
        table(spark, d, "lineitem"), "l_partkey", count_name="n_lines",
        where=F.col("l_returnflag").isin(list(VOTE_FLAGS)), more_than=MIN_FLAGGED_LINES,
    )


def period_labels(spark, d):
    """The label form of the same counts: a CASE over the year, counted per label."""
    label = label_by_value(period_label("l_shipdate", "yyyy"), PART_PERIODS, "before")
    return period_counts(
        table(spark, d, "lineitem"), "l_partkey", label, PART_PERIOD_COLUMNS,
        entity_name="PostId", total_name="Votes",
    )


def full_outer(spark, d):
    """Every line split into three periods, counted per part (or none: the supplier 0 stands
    for NULL) and put together by two full outer joins that match NULL keys."""
    part = null_if("l_suppkey", 0)
    li = table(spark, d, "lineitem").select(part.alias("l_suppkey"), "l_shipdate")
    before = F.col("l_shipdate") < F.lit(EARLY_CUTOFF).cast("timestamp_ntz")
    after = F.col("l_shipdate") >= F.lit(LATE_CUTOFF).cast("timestamp_ntz")
    counts = [
        count_by_key(li, "l_suppkey", count_name=name, where=where)
        for name, where in (("EarlyLines", before), ("MiddleLines", ~before & ~after), ("LateLines", after))
    ]
    two = full_outer_merge(counts[0], counts[1], "l_suppkey", null_safe=True)
    return full_outer_merge(two, counts[2], "l_suppkey", total_name="TotalLines", null_safe=True)


# --- joins and NULL policy -------------------------------------------------

def left_join(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "source")
    labels = table(spark, d, "labels").select(F.col("doc_id").alias("l_doc_id"), "quality")
    return join_on(docs, labels, ["doc_id"], ["l_doc_id"], "left").groupBy("source").agg(
        F.count(F.lit(1)).alias("n_docs"),
        F.count("l_doc_id").alias("n_labelled"),
        F.sum("quality").alias("quality_sum"),
    )


def null_group(spark, d):
    o = table(spark, d, "orders")
    return count_by_key(
        o, null_if("o_orderpriority", NULL_PRIORITY), key_name="priority",
        count_name="n_rows", nonnull_name="n_nonnull",
    )


def allnull_sum(spark, d):
    o = table(spark, d, "orders")
    measure = F.when(F.col("o_orderpriority") == NULL_PRIORITY, F.lit(None)).otherwise(
        F.col("o_orderkey")
    )
    return sum_by_key(o, "o_orderpriority", measure, sum_name="total")


def _key_join(spark, d, null_safe):
    return join_row_count(
        table(spark, d, "orders"), table(spark, d, "customer"),
        null_if("o_custkey", 0), null_if("c_custkey", 0), null_safe=null_safe,
    )


def null_key_join(spark, d):
    return _key_join(spark, d, False)


def nullsafe_join(spark, d):
    return _key_join(spark, d, True)


def nullsafe_rows(spark, d):
    """The rows of a join on two keys of which one may be NULL on both sides."""
    customers = table(spark, d, "customer").select(null_if("c_nationkey", 0).alias("c_nation"), "c_custkey")
    suppliers = table(spark, d, "supplier").select(null_if("s_nationkey", 0).alias("s_nation"), "s_suppkey")
    joined = join_on(customers, suppliers, ["c_nation", "c_custkey"], ["s_nation", "s_suppkey"], null_safe=True)
    return joined.select("c_custkey", "c_nation", "s_suppkey")


def top_owner_ties(spark, d):
    """Q2's rollup by rank, with owner and customer keys of which some are NULL on both sides."""
    owners = table(spark, d, "customer").select(null_if("c_custkey", 7).alias("Id"), F.col("c_name").alias("DisplayName"))
    orders = table(spark, d, "orders").select(null_if("o_custkey", 7).alias("Owner"), "o_orderstatus")
    return top_by_rollup(
        owners, orders, dim_key="Id", fact_key="Owner", measure=F.lit(1), dim_cols=["DisplayName"],
        fact_filter=F.col("o_orderstatus") == FINISHED, measure_name="Questions", k=10, ties="keep", null_safe=True,
    )


def child_score_ties(spark, d):
    """Q4's rollup by rank: parents with as many lines as the tenth."""
    return rollup_children(
        table(spark, d, "lineitem"), table(spark, d, "orders"), table(spark, d, "customer"),
        child_parent_key="l_orderkey", child_score=F.lit(1), parent_key="o_orderkey",
        parent_owner_key="o_custkey", owner_key="c_custkey", parent_cols=["o_orderkey", "o_orderpriority"],
        owner_cols=["c_name"], parent_filter=F.col("o_orderstatus") == FINISHED, score_name="Lines", k=10, ties="keep",
    )


def allnull_filled(spark, d):
    """Sums per group with 0 for a group of NULLs."""
    measure = F.when(F.col("o_orderpriority") != NULL_PRIORITY, F.col("o_orderkey"))
    return sum_by_key(table(spark, d, "orders"), "o_orderpriority", measure, sum_name="total", fill_empty=0)


def not_in_empty(spark, d):
    o = table(spark, d, "orders")
    prio = F.col("o_orderpriority")
    p = (
        F.when(prio == NULL_PRIORITY, F.lit(None).cast("string"))
        .when(prio == EMPTY_PRIORITY, F.lit(""))
        .otherwise(prio)
    )
    return o.select(p.alias("p")).filter(not_blank("p")).agg(F.count(F.lit(1)).alias("n"))


# --- set operations and comparison ----------------------------------------

def union(spark, d):
    appended = union_tagged(
        {
            "orders": table(spark, d, "orders").select(F.col("o_orderstatus").alias("value")),
            "lineitem": table(spark, d, "lineitem").select(F.col("l_returnflag").alias("value")),
        },
        tag_name="tag",
    )
    return appended.groupBy("tag", "value").agg(F.count(F.lit(1)).alias("n"))


def table_diff_by_key(spark, d):
    """Two versions of the customers, of different column types, compared by key: some
    balances changed, one segment's rows are missing, one segment is renamed."""
    customers = table(spark, d, "customer")
    left = customers.select(F.col("c_custkey").alias("key"), "c_mktsegment", cents("c_acctbal").alias("balance"))
    balance = cents("c_acctbal") + F.when(F.col("c_custkey") % 97 == 0, 1).otherwise(0)
    right = customers.where(F.coalesce(F.col("c_nationkey") != 3, F.lit(True))).select(
        F.col("c_custkey").cast("string").alias("key"),
        F.when(F.col("c_nationkey") == 4, F.lit("RENAMED")).otherwise(F.col("c_mktsegment")).alias("c_mktsegment"),
        balance.cast("double").alias("balance"),
    )
    by_key = table_diff(left, right, keys=["key"])
    return by_key.select("key", "n_left", "n_right", F.array_join("columns", ",").alias("differing"))


def table_diff_keys(spark, d):
    left = table(spark, d, "orders").select(F.col("o_custkey").alias("key"))
    right = table(spark, d, "customer").select(F.col("c_custkey").alias("key"))
    return table_diff(left, right)


# --- sources and sinks -----------------------------------------------------

def _csv_roundtrip(spark, d, name):
    src = table(spark, d, name)
    path = shared_dir(spark, f"csv-{name}")
    write_csv(src, path, files=CSV_FILES)
    return read_csv(spark, path, src.schema)


def csv_roundtrip(spark, d):
    return _csv_roundtrip(spark, d, "documents")


def csv_roundtrip_events(spark, d):
    return _csv_roundtrip(spark, d, "events")


def parquet_roundtrip(spark, d):
    src = table(spark, d, "events")
    path = shared_dir(spark, "parquet-events")
    write_parquet(src, path)
    return spark.read.schema(src.schema).parquet(path)


# --- streaming: the same counts kept current over arriving files ----------

def _orders_stream(spark, d):
    # a file stream source reads folders or globs; this glob matches one file
    return read_stream(spark, f"{d.rstrip('/')}/orders.parque[t]", SUPPLIED_SCHEMAS["orders"])


def stream_year_count(spark, d):
    out = shared_dir(spark, "stream-year-count")
    run_to_completion(start_count_by_period(
        _orders_stream(spark, d), "o_orderdate", f"{out}/counts", checkpoint=f"{out}/checkpoint"))
    return spark.read.schema("Year STRING, TotalNumber BIGINT").parquet(f"{out}/counts")


def stream_argmax_one(spark, d):
    out = shared_dir(spark, "stream-argmax-one")
    run_to_completion(start_top_category_per_period(
        _orders_stream(spark, d), "o_orderdate", "o_orderpriority", f"{out}/best", checkpoint=f"{out}/checkpoint"))
    return spark.read.schema("Year STRING, Name STRING, MaxPercentage DOUBLE").parquet(f"{out}/best")


WORKLOADS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "year_count": year_count,
    "sql_year_count": sql_year_count,
    "dirty_dates": dirty_dates,
    "top_owner": top_owner,
    "topn_ties": topn_ties,
    "argmax_ties": argmax_ties,
    "argmax_one": argmax_one,
    "argmax_join": argmax_join,
    "window_share": window_share,
    "child_score": child_score,
    "period_pivot": period_pivot,
    "period_labels": period_labels,
    "having_min": having_min,
    "full_outer": full_outer,
    "left_join": left_join,
    "null_group": null_group,
    "allnull_sum": allnull_sum,
    "null_key_join": null_key_join,
    "nullsafe_join": nullsafe_join,
    "nullsafe_rows": nullsafe_rows,
    "top_owner_ties": top_owner_ties,
    "child_score_ties": child_score_ties,
    "allnull_filled": allnull_filled,
    "not_in_empty": not_in_empty,
    "union": union,
    "table_diff": table_diff_keys,
    "table_diff_by_key": table_diff_by_key,
    "csv_roundtrip": csv_roundtrip,
    "csv_roundtrip_events": csv_roundtrip_events,
    "parquet_roundtrip": parquet_roundtrip,
    "stream_year_count": stream_year_count,
    "stream_argmax_one": stream_argmax_one,
}
