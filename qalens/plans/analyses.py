"""The five site analyses, as calls on the reusable operators.

Inputs are the typed tables from :func:`qalens.sources.load_tables`.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalens.functions.dates import in_years, period_label
from qalens.functions.labels import not_blank
from qalens.operators import (
    count_by_period,
    counts_by_condition,
    rollup_children,
    top_by_period_counts,
    top_by_rollup,
    top_category_per_period,
)
from qalens.operators.sketch import prune_for_top_k

# Fixed values of the analyses.
QUESTION_POST_TYPE = 1
COVID_VOTE_TYPES = (3, 4, 12)
COVID_PERIODS = {
    "after": ("2022",),
    "during": ("2021", "2020", "2019"),
}
COVID_DEFAULT_PERIOD = "before"
COVID_COLUMNS = {
    "before": "BeforeCOVIDVotes",
    "during": "DuringCOVIDVotes",
    "after": "AfterCOVIDVotes",
}


def posts_per_year(posts: DataFrame) -> DataFrame:
    """Q1. Year, TotalNumber: posts per calendar year; posts without a valid
    date form the NULL year."""
    return count_by_period(posts, "CreationDate", "yyyy", period_name="Year", count_name="TotalNumber")


def top_question_owners(
    users: DataFrame,
    posts: DataFrame,
    k: int = 10,
    ties: str = "cut",
    *,
    post_type: int = QUESTION_POST_TYPE,
    prune: bool = False,
) -> DataFrame:
    """Q2. Id, DisplayName, TotalViews: the users whose questions have the most
    views in total. ``prune``: only users who can be among them are summed (see
    :func:`qalens.operators.sketch.prune_for_top_k`)."""
    return top_by_rollup(
        users,
        posts,
        dim_key="Id",
        fact_key="OwnerUserId",
        measure="ViewCount",
        dim_cols=["DisplayName"],
        fact_filter=F.col("PostTypeId") == post_type,
        measure_name="TotalViews",
        k=k,
        ties=ties,
        prune=prune,
    )


def top_badge_per_year(
    badges: DataFrame, ties: str = "first", method: str = "aggregate"
) -> DataFrame:
    """Q3. Year, Name, MaxPercentage: each year's most awarded badge and its
    share of that year's badges."""
    return top_category_per_period(
        badges,
        "Date",
        "Name",
        "yyyy",
        period_name="Year",
        category_name="Name",
        share_name="MaxPercentage",
        ties=ties,
        method=method,
    )


def top_questions_by_comment_score(
    comments: DataFrame,
    posts: DataFrame,
    users: DataFrame,
    k: int = 10,
    ties: str = "cut",
    *,
    post_type: int = QUESTION_POST_TYPE,
    late: bool = True,
    prune: bool = False,
    reduce: bool = False,
) -> DataFrame:
    """Q4. Title, CommentCount, ViewCount, CommentsTotalScore, DisplayName,
    Reputation, Location: the questions whose comments score highest in total."""
    return rollup_children(
        comments,
        posts,
        users,
        child_parent_key="PostId",
        child_score="Score",
        parent_key="Id",
        parent_owner_key="OwnerUserId",
        owner_key="Id",
        parent_cols=["Title", "CommentCount", "ViewCount"],
        owner_cols=["DisplayName", "Reputation", "Location"],
        parent_filter=F.col("PostTypeId") == post_type,
        score_name="CommentsTotalScore",
        k=k,
        ties=ties,
        late=late,
        prune=prune,
        reduce=reduce,
    )


def covid_vote_counts(
    votes: DataFrame,
    *,
    periods: Mapping[str, Sequence[str]] = COVID_PERIODS,
    default: str = COVID_DEFAULT_PERIOD,
    vote_types: Sequence[int] = COVID_VOTE_TYPES,
) -> DataFrame:
    """PostId, BeforeCOVIDVotes, DuringCOVIDVotes, AfterCOVIDVotes, Votes for
    votes of the kept types; a vote whose year is not listed in ``periods``
    (or has no valid date) counts under ``default``."""
    named = {p: in_years("CreationDate", years) for p, years in periods.items()}
    listed = in_years("CreationDate", [y for years in periods.values() for y in years])
    conditions = {
        column: named.get(p, F.lit(False)) | (~listed if p == default else F.lit(False))
        for p, column in COVID_COLUMNS.items()
    }
    return counts_by_condition(
        votes,
        "PostId",
        conditions,
        entity_name="PostId",
        total_name="Votes",
        where=F.col("VoteTypeId").isin(list(vote_types)),
    )


def top_posts_by_covid_votes(
    posts: DataFrame,
    votes: DataFrame,
    k: int = 20,
    *,
    periods: Mapping[str, Sequence[str]] = COVID_PERIODS,
    default: str = COVID_DEFAULT_PERIOD,
    vote_types: Sequence[int] = COVID_VOTE_TYPES,
    late: bool = True,
    prune: bool = False,
) -> DataFrame:
    """Q5. Title, Date, PostId, BeforeCOVIDVotes, DuringCOVIDVotes,
    AfterCOVIDVotes, Votes: titled posts with votes during 2019-2021, most such
    votes first, then most votes, then PostId. ``periods`` maps 'after' and
    'during' to their years; other years count as ``default`` ('before'). ``prune``: only
    posts that can be among them are counted."""
    if prune:
        leads = F.col("VoteTypeId").isin(list(vote_types)) & in_years("CreationDate", periods.get("during", ()))
        titled = posts.where(not_blank("Title")).select(F.col("Id").alias("__known"))
        votes = prune_for_top_k(
            votes, "PostId", F.when(leads, 1).otherwise(0), k,
            eligible=lambda sums, key: sums.join(titled, F.col(key) == F.col("__known"), "left_semi"),
        ).rows
    return top_by_period_counts(
        posts,
        covid_vote_counts(votes, periods=periods, default=default, vote_types=vote_types),
        entity_key="Id",
        count_key="PostId",
        lead="DuringCOVIDVotes",
        total="Votes",
        entity_cols=[F.col("Title"), period_label("CreationDate", "yyyy-MM-dd").alias("Date")],
        entity_filter=not_blank("Title"),
        k=k,
        late=late,
    )
