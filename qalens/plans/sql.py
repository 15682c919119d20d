"""SQL entry point: register tables as views and run SQL text through Catalyst."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Expose each table under its key as a session temporary view (no data is
    copied), for SQL written against plain table names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def run_sql(spark: SparkSession, text: str, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL text. With ``tables``, each ``{name}`` in the text is bound to
    that DataFrame for this query only (no session-wide view is created, so
    concurrent queries cannot see each other's tables); without, the text
    refers to views already registered."""
    if tables:
        return spark.sql(text, **tables)
    return spark.sql(text)


# The five analyses as Spark SQL over the site tables, for users who keep their
# queries as text; ``{Posts}`` etc. are bound by :func:`run_sql` (or replace them
# with view names). Time columns are typed at load, so no parsing appears here.
# Q3 takes each year's best (count, name) by an aggregate instead of a bare column next to
# MAX() (rejected by Spark); ties go to the smallest name. Q4 and Q5 rank on keys and fetch
# texts for the few posts that win, so no text crosses a shuffle at size. Periods are ranges
# of the time itself; labels are made once per group.
SITE_SQL = {
    "posts_per_year": """
        SELECT date_format(Start, 'yyyy') AS Year, TotalNumber
        FROM (SELECT trunc(CAST(CreationDate AS DATE), 'year') AS Start, COUNT(*) AS TotalNumber
              FROM {Posts} GROUP BY 1) c
    """,
    "top_question_owners": """
        SELECT u.Id, u.DisplayName, q.TotalViews
        FROM {Users} u
        JOIN (SELECT OwnerUserId, SUM(ViewCount) AS TotalViews
              FROM {Posts} WHERE PostTypeId = 1 GROUP BY OwnerUserId) q
          ON u.Id = q.OwnerUserId
        ORDER BY q.TotalViews DESC NULLS LAST, u.Id
        LIMIT 10
    """,
    "top_badge_per_year": """
        SELECT date_format(Start, 'yyyy') AS Year, Best.Name AS Name,
               CAST(-Best.Fewest AS DOUBLE) / CAST(Total AS DOUBLE) AS MaxPercentage
        FROM (SELECT Start, SUM(Count) AS Total, MIN(struct(-Count AS Fewest, Name)) AS Best
              FROM (SELECT trunc(CAST(Date AS DATE), 'year') AS Start, Name, COUNT(*) AS Count
                    FROM {Badges} WHERE Date IS NOT NULL GROUP BY 1, 2) c
              GROUP BY Start) r
    """,
    "top_questions_by_comment_score": """
        WITH best AS (
            SELECT s.PostId, p.OwnerUserId, s.CommentsTotalScore
            FROM (SELECT PostId, SUM(Score) AS CommentsTotalScore FROM {Comments} GROUP BY PostId) s
            JOIN (SELECT Id, OwnerUserId FROM {Posts} WHERE PostTypeId = 1) p ON p.Id = s.PostId
            LEFT SEMI JOIN {Users} u ON p.OwnerUserId = u.Id
            ORDER BY s.CommentsTotalScore DESC NULLS LAST, s.PostId
            LIMIT 10)
        SELECT /*+ BROADCAST(b) */ p.Title, p.CommentCount, p.ViewCount, b.CommentsTotalScore,
               o.DisplayName, o.Reputation, o.Location
        FROM best b
        JOIN {Posts} p ON p.Id = b.PostId
        JOIN (SELECT /*+ BROADCAST(w) */ u.Id, u.DisplayName, u.Reputation, u.Location
              FROM (SELECT DISTINCT OwnerUserId FROM best) w JOIN {Users} u ON u.Id = w.OwnerUserId) o
          ON o.Id = b.OwnerUserId
        WHERE p.PostTypeId = 1
        ORDER BY b.CommentsTotalScore DESC NULLS LAST, b.PostId
        LIMIT 10
    """,
    "top_posts_by_covid_votes": """
        SELECT /*+ BROADCAST(v) */ p.Title, date_format(p.CreationDate, 'yyyy-MM-dd') AS Date, v.*
        FROM (SELECT c.*
              FROM (SELECT PostId,
                           COUNT(*) - count_if(Day >= DATE '2019-01-01' AND Day < DATE '2023-01-01') AS BeforeCOVIDVotes,
                           count_if(Day >= DATE '2019-01-01' AND Day < DATE '2022-01-01') AS DuringCOVIDVotes,
                           count_if(Day >= DATE '2022-01-01' AND Day < DATE '2023-01-01') AS AfterCOVIDVotes,
                           COUNT(*) AS Votes
                    FROM (SELECT PostId, CAST(CreationDate AS DATE) AS Day
                          FROM {Votes} WHERE VoteTypeId IN (3, 4, 12)) d
                    GROUP BY PostId) c
              LEFT SEMI JOIN (SELECT Id FROM {Posts} WHERE Title NOT IN ('')) k ON c.PostId = k.Id
              WHERE c.DuringCOVIDVotes > 0
              ORDER BY c.DuringCOVIDVotes DESC, c.Votes DESC, c.PostId
              LIMIT 20) v
        JOIN {Posts} p ON p.Id = v.PostId
        WHERE p.Title NOT IN ('')
        ORDER BY v.DuringCOVIDVotes DESC, v.Votes DESC, v.PostId
        LIMIT 20
    """,
}
