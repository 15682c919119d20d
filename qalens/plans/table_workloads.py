"""Workloads of split loading, numbering, comparing, pruned ranking and safe rewriting, on the
supplied tables, and their DuckDB SQL."""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.functions.dates import period_label
from qalens.functions.numbers import cents
from qalens.operators import row_positions, table_diff_by_tree, table_equals_ordered, top_n_per_group
from qalens.plans import analyses as A
from qalens.plans import site_standins as S
from qalens.session import shared_dir
from qalens.sources.csv import read_csv
from qalens.sources.sinks import write_csv
from qalens.sources.supplied import read_supplied
from qalens.sources.tables import convert_to_parquet, load_table, rejected_rows
from qalens.sources.versions import read_version, write_version

# Fixed values of the workloads.
SPLIT_BYTES = 512 << 10
AWKWARD = '\r\n"a"",b"\n,"'
TOP_PER_YEAR = 3
HOT_PERIOD, HOT_BEFORE = "before 1997", 1997
CHANGED_BY = 1
SWAPPED = (1, 2)


# --- loading -----------------------------------------------------------------

def csv_split_scan(spark: SparkSession, d: str) -> DataFrame:
    """Documents with quotes, commas, line feeds and CRLF inside their fields, exported without
    compression (two groups of files, of different column orders) and read by byte ranges."""
    docs = read_supplied(spark, d, "documents")
    text = F.concat("text", F.lit(AWKWARD), "source", F.lit('"'))
    rows = docs.select("doc_id", text.alias("text"), F.when(F.col("doc_id") % 3 > 0, F.col("source")).alias("source"), "n_chars")
    root = shared_dir(spark, "split-export")
    for part in (0, 1):
        columns = rows.columns if part == 0 else rows.columns[::-1]
        write_csv(rows.where(F.col("doc_id") % 2 == part).select(*columns), f"{root}/docs-{part}.csv", compression="none")
    return read_csv(spark, f"{root}/docs-*.csv", rows.schema, by_header=True, split=SPLIT_BYTES)


def rejected_rows_of_exports(spark: SparkSession, d: str) -> DataFrame:
    """What converting the exported tables rejected, value by value."""
    names = ("Posts", "Badges", "Comments")
    target = shared_dir(spark, "converted")
    convert_to_parquet(spark, "", target, tables=names, paths=S.exported_tables(spark, d, names), rejects=True)
    rejected = rejected_rows(spark, target, names)
    return rejected.select("table", "column", "value", F.from_csv("record", "Id BIGINT")["Id"].alias("Id"))


def _clustered(spark, d, names):
    target = shared_dir(spark, "clustered")
    convert_to_parquet(spark, "", target, tables=names, paths=S.exported_tables(spark, d, names))
    return {n: load_table(spark, target, n, "parquet") for n in names}


def site_q2_clustered(spark, d):
    """Q2 on tables converted from exports, clustered by post type and date."""
    t = _clustered(spark, d, ("Users", "Posts"))
    return A.top_question_owners(t["Users"], t["Posts"])


def site_q5_clustered(spark, d):
    t = _clustered(spark, d, ("Posts", "Votes"))
    return A.top_posts_by_covid_votes(t["Posts"], t["Votes"])


# --- ranking -----------------------------------------------------------------

def site_q2_pruned(spark, d):
    return A.top_question_owners(S.site_users(spark, d), S.site_posts_from_orders(spark, d), prune=True)


def site_q4_pruned(spark, d):
    return A.top_questions_by_comment_score(S.site_comments(spark, d), S.site_posts_from_orders(spark, d), S.site_users(spark, d), prune=True)


def site_q4_reduced(spark, d):
    return A.top_questions_by_comment_score(S.site_comments(spark, d), S.site_posts_from_orders(spark, d), S.site_users(spark, d), reduce=True)


def site_q5_pruned(spark, d):
    return A.top_posts_by_covid_votes(S.site_posts_from_orders(spark, d), S.site_dated_votes(spark, d), prune=True)


def top_orders_per_period(spark, d):
    """The dearest orders of each period by thousands, ties kept; one period holds most rows."""
    orders = read_supplied(spark, d, "orders")
    year = period_label("o_orderdate", "yyyy")
    period = F.when(F.year("o_orderdate") < HOT_BEFORE, F.lit(HOT_PERIOD)).otherwise(year)
    rows = orders.select("o_orderkey", period.alias("period"), F.floor(F.col("o_totalprice") / 1000).alias("thousands"))
    return top_n_per_group(rows, "period", "thousands", TOP_PER_YEAR)


# --- numbering and comparing ---------------------------------------------------

def orders_numbered(spark, d):
    orders = read_supplied(spark, d, "orders").select("o_orderkey", "o_orderdate")
    return row_positions(orders, [F.col("o_orderdate").desc(), "o_orderkey"])


def orders_compared_in_order(spark, d):
    """Orders against themselves, with two rows swapped, with a retyped column, without the
    last row, and with one changed value."""
    rows = read_supplied(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    a, b = SWAPPED
    numbered = row_positions(rows, ["o_orderkey"])
    swapped = F.when(F.col("position") == a, F.lit(b)).when(F.col("position") == b, F.lit(a)).otherwise(F.col("position"))
    last = numbered.agg(F.max("position").alias("last"))
    shorter = numbered.join(F.broadcast(last), F.col("position") == F.col("last"), "left_anti")
    changed = numbered.withColumn("o_orderpriority", F.when(F.col("o_custkey") % 100 == 7, F.lit(None)).otherwise(F.col("o_orderpriority")))
    columns = ["o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"]
    cases = {
        "equal": (numbered, ["position"]),
        "swapped": (numbered, [swapped]),
        "retyped": (numbered.withColumn("o_custkey", F.col("o_custkey").cast("int")), ["position"]),
        "shorter": (shorter, ["position"]),
        "changed": (changed, ["position"]),
    }
    out = None
    for name, (right, order) in cases.items():
        one = table_equals_ordered(numbered, right, ["position"], order, columns=columns).select(F.lit(name).alias("case"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def _customer_versions(spark, d):
    customers = read_supplied(spark, d, "customer").select(
        F.col("c_custkey").alias("key"), "c_name", "c_mktsegment", cents("c_acctbal").alias("balance")
    )
    moved = F.when(F.col("key") % 50 == CHANGED_BY, F.col("balance") + 1).otherwise(F.col("balance"))
    return customers, customers.withColumn("balance", moved).where(F.col("key") % 100 != 3).select("balance", "c_mktsegment", "key", "c_name")


def diff_by_tree(spark, d):
    left, right = _customer_versions(spark, d)
    return table_diff_by_tree(left, right)


def diff_by_tree_equal(spark, d):
    """Lines against themselves dealt anew: nothing differs, only bucket sums move."""
    lines = read_supplied(spark, d, "lineitem")
    return table_diff_by_tree(lines, lines.repartition(7, "l_partkey")).select("l_orderkey", "l_linenumber", "n_left", "n_right")


# --- rewriting ---------------------------------------------------------------

def versioned_rewrite(spark, d):
    """A table written, rewritten from itself, and left whole by a write that fails."""
    path = shared_dir(spark, "versioned")
    orders = read_supplied(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    write_version(orders, path)
    write_version(read_version(spark, path, schema=orders.schema).where("o_orderstatus = 'F'"), path, cluster_by=["o_custkey"])
    doomed = orders.withColumn("o_orderstatus", F.when(F.col("o_orderkey") > 0, F.raise_error(F.lit("failed on purpose")).cast("string")))
    try:
        write_version(doomed, path)
    except PySparkException as error:
        if "failed on purpose" not in str(error):
            raise
    return read_version(spark, path, schema=orders.schema)


TABLE_WORKLOADS = {
    "csv_split_scan": csv_split_scan,
    "rejected_rows": rejected_rows_of_exports,
    "site_q2_clustered": site_q2_clustered,
    "site_q5_clustered": site_q5_clustered,
    "site_q2_pruned": site_q2_pruned,
    "site_q4_pruned": site_q4_pruned,
    "site_q4_reduced": site_q4_reduced,
    "site_q5_pruned": site_q5_pruned,
    "top_n_per_period": top_orders_per_period,
    "row_positions": orders_numbered,
    "table_equals_ordered": orders_compared_in_order,
    "table_diff_by_tree": diff_by_tree,
    "table_diff_by_tree_equal": diff_by_tree_equal,
    "versioned_rewrite": versioned_rewrite,
}

_NUMBERED = """n AS (SELECT row_number() OVER (ORDER BY o_orderkey) AS p, o_orderkey, o_custkey, o_orderdate, o_orderpriority FROM orders)"""
TABLE_ORACLE = {
    "csv_split_scan": """
        SELECT doc_id, text || chr(13) || chr(10) || '"a"",b"' || chr(10) || ',"' || source || '"' AS text,
               CASE WHEN doc_id % 3 > 0 THEN source END AS source, n_chars
        FROM documents
    """,
    "rejected_rows": """
        SELECT 'Posts' AS "table", 'CreationDate' AS "column", 'about 2019' AS value, o_orderkey AS Id FROM orders WHERE o_orderkey % 7 = 6
        UNION ALL SELECT 'Posts', 'ViewCount', 'many', o_orderkey FROM orders WHERE o_orderkey % 11 = 5
        UNION ALL SELECT 'Badges', 'Date', 'about 2019', o_orderkey FROM orders WHERE o_orderkey % 7 = 6
    """,
    "site_q2_clustered": S.SITE_ORACLE["site_csv_q2"],
    "site_q5_clustered": S.SITE_ORACLE["site_csv_q5"],
    "site_q2_pruned": S.SITE_ORACLE["site_q2_top_question_owners"],
    "site_q4_pruned": S.SITE_ORACLE["site_q4_top_questions_by_comment_score"],
    "site_q4_reduced": S.SITE_ORACLE["site_q4_top_questions_by_comment_score"],
    "site_q5_pruned": S.SITE_ORACLE["site_q5_dated_posts"],
    "top_n_per_period": f"""
        SELECT o_orderkey, period, thousands FROM (
            SELECT *, rank() OVER (PARTITION BY period ORDER BY thousands DESC NULLS LAST) AS r FROM (
                SELECT o_orderkey, CASE WHEN year(o_orderdate) < {HOT_BEFORE} THEN '{HOT_PERIOD}' ELSE strftime(o_orderdate, '%Y') END AS period,
                       CAST(floor(o_totalprice / 1000) AS BIGINT) AS thousands FROM orders) o) q
        WHERE r <= {TOP_PER_YEAR}
    """,
    "row_positions": """
        SELECT o_orderkey, o_orderdate, row_number() OVER (ORDER BY o_orderdate DESC NULLS LAST, o_orderkey) AS position FROM orders
    """,
    "table_equals_ordered": f"""
        WITH {_NUMBERED}, c AS (SELECT count(*) AS k FROM n),
        hit AS (SELECT min(p) AS p FROM n WHERE o_custkey % 100 = 7 AND o_orderpriority IS NOT NULL),
        two AS (SELECT a.o_orderkey IS DISTINCT FROM b.o_orderkey AS d1, a.o_custkey IS DISTINCT FROM b.o_custkey AS d2,
                       a.o_orderdate IS DISTINCT FROM b.o_orderdate AS d3, a.o_orderpriority IS DISTINCT FROM b.o_orderpriority AS d4
                FROM n a, n b WHERE a.p = {SWAPPED[0]} AND b.p = {SWAPPED[1]})
        SELECT 'equal' AS "case", true AS equal, k AS n_left, k AS n_right, CAST(NULL AS BIGINT) AS first_difference, CAST(NULL AS VARCHAR) AS differing FROM c
        UNION ALL SELECT 'swapped', false, k, k, 1, concat_ws(',', CASE WHEN d1 THEN 'o_orderkey' END, CASE WHEN d2 THEN 'o_custkey' END,
                         CASE WHEN d3 THEN 'o_orderdate' END, CASE WHEN d4 THEN 'o_orderpriority' END) FROM c, two
        UNION ALL SELECT 'retyped', false, k, k, NULL, 'type of o_custkey: bigint vs int' FROM c
        UNION ALL SELECT 'shorter', false, k, k - 1, k, '(rows)' FROM c
        UNION ALL SELECT 'changed', p IS NULL, k, k, p, CASE WHEN p IS NOT NULL THEN 'o_orderpriority' END FROM c, hit
    """,
    "table_diff_by_tree": f"""
        WITH l AS (SELECT c_custkey AS key, c_name, c_mktsegment, CAST(round(c_acctbal * 100) AS BIGINT) AS balance FROM customer),
        r AS (SELECT key, c_name, c_mktsegment, CASE WHEN key % 50 = {CHANGED_BY} THEN balance + 1 ELSE balance END AS balance FROM l WHERE key % 100 <> 3)
        SELECT key, c_name, c_mktsegment, balance, CAST(sum(x) AS BIGINT) AS n_left, CAST(sum(y) AS BIGINT) AS n_right
        FROM (SELECT *, 1 AS x, 0 AS y FROM l UNION ALL SELECT *, 0, 1 FROM r) b
        GROUP BY key, c_name, c_mktsegment, balance HAVING sum(x) <> sum(y)
    """,
    "table_diff_by_tree_equal": "SELECT l_orderkey, l_linenumber, CAST(1 AS BIGINT) AS n_left, CAST(0 AS BIGINT) AS n_right FROM lineitem WHERE false",
    "versioned_rewrite": "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'",
}
