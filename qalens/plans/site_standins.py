"""The site analyses run unchanged on the supplied tables, through site-shaped views.

Each mapping renames and derives supplied columns into the site schema
(``qalens.schemas.TABLES``); the analyses and their SQL text then run as a
user would run them. Votes are ship dates moved forward 21 years, so that
1998-2001 fall on the analysis's fixed 2019-2022 periods. Derived columns
(``PostTypeId``, ``VoteTypeId``) keep their filters out of the Parquet scan here; on site
tables, where they are plain columns, the same filters are pushed.

The ``site_csv_*`` workloads take the package's main path: the views are written as gzip CSV
exports, Posts and Badges as two groups of files with different column orders, dates in all
accepted layouts and some that are none, and are loaded and analysed from there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.functions.numbers import cents
from qalens.plans import analyses as A
from qalens.plans.report import cross_check
from qalens.plans.sql import SITE_SQL, run_sql
from qalens.session import shared_dir
from qalens.sources.sinks import write_csv
from qalens.sources.supplied import read_supplied
from qalens.sources.tables import load_tables, rejected_values

# Fixed values of the mapping.
QUESTION_STATUS = "F"
VOTE_TYPE_BY_FLAG = {"A": 3, "R": 4}
OTHER_VOTE_TYPE = 2
YEARS_FORWARD = 21


def site_users(spark: SparkSession, d: str) -> DataFrame:
    return read_supplied(spark, d, "customer").select(
        F.col("c_custkey").alias("Id"),
        F.col("c_name").alias("DisplayName"),
        cents("c_acctbal").alias("Reputation"),
        F.col("c_mktsegment").alias("Location"),
    )


def site_posts_from_orders(spark: SparkSession, d: str) -> DataFrame:
    return read_supplied(spark, d, "orders").select(
        F.col("o_orderkey").alias("Id"),
        F.when(F.col("o_orderstatus") == QUESTION_STATUS, F.lit(1)).otherwise(F.lit(2)).alias("PostTypeId"),
        F.col("o_custkey").alias("OwnerUserId"),
        F.col("o_orderdate").alias("CreationDate"),
        F.col("o_orderpriority").alias("Title"),
        cents("o_totalprice").alias("ViewCount"),
        F.year("o_orderdate").cast("bigint").alias("CommentCount"),
    )


def site_comments(spark: SparkSession, d: str) -> DataFrame:
    return read_supplied(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("PostId"), F.col("l_quantity").cast("bigint").alias("Score")
    )


def site_badges(spark: SparkSession, d: str) -> DataFrame:
    return read_supplied(spark, d, "orders").select(
        F.col("o_orderkey").alias("Id"),
        F.col("o_orderpriority").alias("Name"),
        F.col("o_orderdate").alias("Date"),
    )


def site_posts_from_parts(spark: SparkSession, d: str) -> DataFrame:
    """Parts as titled posts for Q5. Parts carry no date, owner, views or comment
    count, so those are NULL (Q5's ``Date`` column is NULL on these views)."""
    return read_supplied(spark, d, "part").select(
        F.col("p_partkey").alias("Id"),
        F.lit(1).alias("PostTypeId"),
        F.lit(None).cast("bigint").alias("OwnerUserId"),
        F.lit(None).cast("timestamp_ntz").alias("CreationDate"),
        F.col("p_name").alias("Title"),
        F.lit(None).cast("bigint").alias("ViewCount"),
        F.lit(None).cast("bigint").alias("CommentCount"),
    )


def site_votes(spark: SparkSession, d: str) -> DataFrame:
    flag = F.col("l_returnflag")
    vote_type = F.lit(OTHER_VOTE_TYPE)
    for f, t in VOTE_TYPE_BY_FLAG.items():
        vote_type = F.when(flag == f, F.lit(t)).otherwise(vote_type)
    return read_supplied(spark, d, "lineitem").select(
        F.col("l_partkey").alias("PostId"),
        vote_type.alias("VoteTypeId"),
        (F.col("l_shipdate") + F.make_ym_interval(F.lit(YEARS_FORWARD), F.lit(0))).alias("CreationDate"),
    )


def site_dated_votes(spark: SparkSession, d: str) -> DataFrame:
    """Votes on orders: all counted types, and one that is not."""
    flag = F.col("l_returnflag")
    vote_type = (
        F.when(flag == "A", F.lit(3)).when(flag == "R", F.lit(4)).when(F.col("l_linenumber") % 2 == 1, F.lit(12)).otherwise(F.lit(OTHER_VOTE_TYPE))
    )
    return read_supplied(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("PostId"),
        vote_type.alias("VoteTypeId"),
        (F.col("l_shipdate") + F.make_ym_interval(F.lit(YEARS_FORWARD), F.lit(0))).alias("CreationDate"),
    )


# Fixed values of the exports: the layouts of dates, by key; NULL stands for text without a date.
DATE_LAYOUTS = (
    "yyyy-MM-dd'T'HH:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd'T'HH:mm:ss.SSS", "yyyy-MM-dd'T'HH:mm:ss'Z'",
    "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", None,
)
BAD_DATE, BAD_NUMBER = "about 2019", "many"
BAD_NUMBER_EVERY = 11


def _date_text(ts: str, key: str):
    out = None
    for i, layout in enumerate(DATE_LAYOUTS):
        text = F.date_format(ts, layout) if layout else F.lit(BAD_DATE)
        test = F.col(key) % len(DATE_LAYOUTS) == i
        out = F.when(test, text) if out is None else out.when(test, text)
    return out


def _export(df: DataFrame, root: str, table: str, key: str) -> str:
    """Two groups of gzip files, the second with its columns in reverse order."""
    for part in (0, 1):
        columns = df.columns if part == 0 else df.columns[::-1]
        write_csv(df.where(F.col(key) % 2 == part).select(*columns), f"{root}/{table}-{part}.csv.gz", files=2)
    return f"{root}/{table}-*.csv.gz"


def exported_tables(spark: SparkSession, d: str, names: tuple[str, ...]) -> dict[str, str]:
    """The views as CSV exports; where each table lies."""
    root = shared_dir(spark, "site-exports")
    posts, badges, votes = site_posts_from_orders(spark, d), site_badges(spark, d), site_dated_votes(spark, d)
    views = F.when(F.col("Id") % BAD_NUMBER_EVERY == 5, F.lit(BAD_NUMBER)).otherwise(F.col("ViewCount").cast("string"))
    made = {
        "Posts": (posts.withColumns({"CreationDate": _date_text("CreationDate", "Id"), "ViewCount": views}), "Id"),
        "Users": (site_users(spark, d), "Id"),
        "Comments": (site_comments(spark, d), "PostId"),
        "Badges": (badges.withColumn("Date", _date_text("Date", "Id")), "Id"),
        "Votes": (votes.withColumn("CreationDate", F.date_format("CreationDate", DATE_LAYOUTS[2])), "PostId"),
    }
    return {n: _export(made[n][0], root, n, made[n][1]) for n in names}


def _from_csv(analysis, *names):
    def run(spark, d):
        tables = load_tables(spark, "", "csv.gz", names, paths=exported_tables(spark, d, names))
        return analysis(*[tables[n] for n in names])

    return run


site_csv_q1 = _from_csv(A.posts_per_year, "Posts")
site_csv_q2 = _from_csv(A.top_question_owners, "Users", "Posts")
site_csv_q3 = _from_csv(A.top_badge_per_year, "Badges")
site_csv_q4 = _from_csv(A.top_questions_by_comment_score, "Comments", "Posts", "Users")
site_csv_q5 = _from_csv(A.top_posts_by_covid_votes, "Posts", "Votes")


def load_rejects(spark, d):
    names = ("Posts", "Users", "Comments", "Badges", "Votes")
    return rejected_values(spark, "", "csv.gz", names, paths=exported_tables(spark, d, names))


def _all_views(spark, d):
    return {
        "Posts": site_posts_from_orders(spark, d), "Users": site_users(spark, d), "Comments": site_comments(spark, d),
        "Badges": site_badges(spark, d), "Votes": site_dated_votes(spark, d),
    }


def site_cross_check(spark, d):
    """Both forms of every analysis, compared."""
    return cross_check(spark, _all_views(spark, d))


def site_q5_dated(spark, d):
    return A.top_posts_by_covid_votes(site_posts_from_orders(spark, d), site_dated_votes(spark, d))


def site_q1(spark, d):
    return A.posts_per_year(site_posts_from_orders(spark, d))


def site_q2(spark, d):
    return A.top_question_owners(site_users(spark, d), site_posts_from_orders(spark, d))


def site_q3(spark, d):
    return A.top_badge_per_year(site_badges(spark, d))


def site_q4(spark, d):
    return A.top_questions_by_comment_score(
        site_comments(spark, d), site_posts_from_orders(spark, d), site_users(spark, d)
    )


def site_q5(spark, d):
    return A.top_posts_by_covid_votes(site_posts_from_parts(spark, d), site_votes(spark, d))


def _sql(name, tables):
    def run(spark, d):
        return run_sql(spark, SITE_SQL[name], {t: make(spark, d) for t, make in tables.items()})

    return run


site_sql_q1 = _sql("posts_per_year", {"Posts": site_posts_from_orders})
site_sql_q2 = _sql("top_question_owners", {"Users": site_users, "Posts": site_posts_from_orders})
site_sql_q3 = _sql("top_badge_per_year", {"Badges": site_badges})
site_sql_q4 = _sql(
    "top_questions_by_comment_score",
    {"Comments": site_comments, "Posts": site_posts_from_orders, "Users": site_users},
)
site_sql_q5 = _sql("top_posts_by_covid_votes", {"Posts": site_posts_from_parts, "Votes": site_votes})

site_sql_q5_dated = _sql("top_posts_by_covid_votes", {"Posts": site_posts_from_orders, "Votes": site_dated_votes})

SITE_WORKLOADS = {
    "site_q1_posts_per_year": site_q1,
    "site_q2_top_question_owners": site_q2,
    "site_q3_top_badge_per_year": site_q3,
    "site_q4_top_questions_by_comment_score": site_q4,
    "site_q5_top_posts_by_covid_votes": site_q5,
    "site_q5_dated_posts": site_q5_dated,
    "site_sql_q5_dated_posts": site_sql_q5_dated,
    "site_csv_q1": site_csv_q1,
    "site_csv_q2": site_csv_q2,
    "site_csv_q3": site_csv_q3,
    "site_csv_q4": site_csv_q4,
    "site_csv_q5": site_csv_q5,
    "load_rejects": load_rejects,
    "site_cross_check": site_cross_check,
    "site_sql_q1_posts_per_year": site_sql_q1,
    "site_sql_q2_top_question_owners": site_sql_q2,
    "site_sql_q3_top_badge_per_year": site_sql_q3,
    "site_sql_q4_top_questions_by_comment_score": site_sql_q4,
    "site_sql_q5_top_posts_by_covid_votes": site_sql_q5,
}

_POSTS_FROM_ORDERS = """Posts AS (
    SELECT o_orderkey AS Id, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END AS PostTypeId,
           o_custkey AS OwnerUserId, o_orderdate AS CreationDate, o_orderpriority AS Title,
           CAST(round(o_totalprice * 100) AS BIGINT) AS ViewCount,
           CAST(year(o_orderdate) AS BIGINT) AS CommentCount
    FROM orders)"""
_USERS = """Users AS (
    SELECT c_custkey AS Id, c_name AS DisplayName,
           CAST(round(c_acctbal * 100) AS BIGINT) AS Reputation, c_mktsegment AS Location
    FROM customer)"""

_DATED_VOTES = """votes_of AS (
    SELECT l_orderkey AS PostId, l_shipdate + INTERVAL 21 YEAR AS cast_on FROM lineitem
    WHERE l_returnflag IN ('A', 'R') OR l_linenumber % 2 = 1)"""

SITE_ORACLE = {
    "site_q1_posts_per_year": f"""
        WITH {_POSTS_FROM_ORDERS}
        SELECT strftime(CreationDate, '%Y') AS Year, count(*) AS TotalNumber FROM Posts GROUP BY 1
    """,
    "site_q2_top_question_owners": f"""
        WITH {_POSTS_FROM_ORDERS}, {_USERS}
        SELECT u.Id, u.DisplayName, CAST(q.TotalViews AS BIGINT) AS TotalViews
        FROM Users u
        JOIN (SELECT OwnerUserId, sum(ViewCount) AS TotalViews FROM Posts
              WHERE PostTypeId = 1 GROUP BY OwnerUserId) q ON u.Id = q.OwnerUserId
        ORDER BY q.TotalViews DESC NULLS LAST, u.Id
        LIMIT 10
    """,
    "site_q3_top_badge_per_year": """
        WITH c AS (SELECT strftime(o_orderdate, '%Y') AS Year, o_orderpriority AS Name, count(*) AS cnt
                   FROM orders WHERE o_orderdate IS NOT NULL GROUP BY 1, 2),
             t AS (SELECT Year, sum(cnt) AS total FROM c GROUP BY Year)
        SELECT Year, Name, MaxPercentage
        FROM (SELECT c.Year, c.Name, CAST(c.cnt AS DOUBLE) / CAST(t.total AS DOUBLE) AS MaxPercentage,
                     row_number() OVER (PARTITION BY c.Year ORDER BY c.cnt DESC, c.Name ASC NULLS FIRST) AS rn
              FROM c JOIN t ON c.Year = t.Year) r
        WHERE rn = 1
    """,
    "site_q4_top_questions_by_comment_score": f"""
        WITH {_POSTS_FROM_ORDERS}, {_USERS},
             s AS (SELECT l_orderkey AS PostId, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS CommentsTotalScore
                   FROM lineitem GROUP BY 1)
        SELECT p.Title, p.CommentCount, p.ViewCount, s.CommentsTotalScore,
               u.DisplayName, u.Reputation, u.Location
        FROM s JOIN Posts p ON p.Id = s.PostId JOIN Users u ON p.OwnerUserId = u.Id
        WHERE p.PostTypeId = 1
        ORDER BY s.CommentsTotalScore DESC NULLS LAST, p.Id
        LIMIT 10
    """,
    "site_q5_top_posts_by_covid_votes": f"""
        WITH votes_of AS (SELECT l_partkey AS PostId, l_shipdate + INTERVAL 21 YEAR AS cast_on
                          FROM lineitem WHERE l_returnflag IN ('A', 'R')),
             {{per_post}}
        SELECT p_name AS Title, CAST(NULL AS VARCHAR) AS Date, per_post.*
        FROM part JOIN per_post ON p_partkey = PostId
        WHERE p_name <> '' AND DuringCOVIDVotes > 0
        ORDER BY DuringCOVIDVotes DESC, Votes DESC, PostId LIMIT 20
    """,
    "site_q5_dated_posts": f"""
        WITH {_POSTS_FROM_ORDERS}, {_DATED_VOTES}, {{per_post}}
        SELECT Title, strftime(CreationDate, '%Y-%m-%d') AS Date, per_post.*
        FROM Posts JOIN per_post ON Id = PostId
        WHERE Title <> '' AND DuringCOVIDVotes > 0
        ORDER BY DuringCOVIDVotes DESC, Votes DESC, PostId LIMIT 20
    """,
}
# one aggregate with a filter per period
_PER_POST = """per_post AS (
    SELECT PostId,
           count(*) FILTER (cast_on IS NULL OR cast_on < DATE '2019-01-01' OR cast_on >= DATE '2023-01-01') AS BeforeCOVIDVotes,
           count(*) FILTER (cast_on >= DATE '2019-01-01' AND cast_on < DATE '2022-01-01') AS DuringCOVIDVotes,
           count(*) FILTER (cast_on >= DATE '2022-01-01' AND cast_on < DATE '2023-01-01') AS AfterCOVIDVotes,
           count(*) AS Votes
    FROM votes_of GROUP BY PostId)"""
SITE_ORACLE = {k: v.replace("{per_post}", _PER_POST) for k, v in SITE_ORACLE.items()}
for _k in list(SITE_ORACLE):
    SITE_ORACLE[_k.replace("site_", "site_sql_", 1)] = SITE_ORACLE[_k]

# the same questions of the exports: what no layout or number matches is NULL
_DIRTY = {
    "o_orderdate AS CreationDate": "CASE WHEN o_orderkey % 7 <> 6 THEN o_orderdate END AS CreationDate",
    "CAST(round(o_totalprice * 100) AS BIGINT) AS ViewCount":
        "CASE WHEN o_orderkey % 11 <> 5 THEN CAST(round(o_totalprice * 100) AS BIGINT) END AS ViewCount",
    "FROM orders WHERE o_orderdate IS NOT NULL": "FROM orders WHERE o_orderdate IS NOT NULL AND o_orderkey % 7 <> 6",
}
_CSV_OF = {
    "site_csv_q1": "site_q1_posts_per_year",
    "site_csv_q2": "site_q2_top_question_owners",
    "site_csv_q3": "site_q3_top_badge_per_year",
    "site_csv_q4": "site_q4_top_questions_by_comment_score",
    "site_csv_q5": "site_q5_dated_posts",
}
for _k, _clean in _CSV_OF.items():
    _text = SITE_ORACLE[_clean]
    for _old, _new in _DIRTY.items():
        _text = _text.replace(_old, _new)
    SITE_ORACLE[_k] = _text
SITE_ORACLE["load_rejects"] = """
    SELECT * FROM (
        SELECT 'Posts' AS "table", 'CreationDate' AS "column", count(*) AS "rows" FROM orders WHERE o_orderkey % 7 = 6
        UNION ALL SELECT 'Posts', 'ViewCount', count(*) FROM orders WHERE o_orderkey % 11 = 5
        UNION ALL SELECT 'Badges', 'Date', count(*) FROM orders WHERE o_orderkey % 7 = 6) r
    WHERE "rows" > 0
"""
_ANALYSIS_OF = {
    "posts_per_year": "site_q1_posts_per_year",
    "top_question_owners": "site_q2_top_question_owners",
    "top_badge_per_year": "site_q3_top_badge_per_year",
    "top_questions_by_comment_score": "site_q4_top_questions_by_comment_score",
    "top_posts_by_covid_votes": "site_q5_dated_posts",
}
SITE_ORACLE["site_cross_check"] = " UNION ALL ".join(
    f"SELECT '{a}' AS analysis, count(*) AS rows_dataframe, count(*) AS rows_sql, CAST(0 AS BIGINT) AS rows_differing FROM ({SITE_ORACLE[k]}) q"
    for a, k in _ANALYSIS_OF.items()
)
