"""Q1-Q5 on the edge fixture, with hand-checked answers."""

import pytest
from pyspark.sql import functions as F

from qalens.plans import analyses as A
from qalens.plans.sql import SITE_SQL, run_sql

N = None
TWO_THIRDS = 2 / 3


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def ordered(df):
    return [tuple(r) for r in df.collect()]


def test_q1_posts_per_year(site):
    got = rows(A.posts_per_year(site["Posts"]))
    assert got == sorted(
        [(N, 2), ("2018", 1), ("2019", 2), ("2020", 1), ("2021", 1), ("2022", 1)], key=repr
    )


def test_q2_top_question_owners(site):
    got = ordered(A.top_question_owners(site["Users"], site["Posts"]))
    assert got == [(10, "ana", 100), (12, N, 70), (11, "bo", 50)]


def test_q2_keep_ties_is_superset(site):
    cut = set(ordered(A.top_question_owners(site["Users"], site["Posts"], k=2)))
    keep = set(ordered(A.top_question_owners(site["Users"], site["Posts"], k=2, ties="keep")))
    assert len(cut) == 2 and cut <= keep


@pytest.mark.parametrize("method", ["aggregate", "window"])
def test_q3_first(site, method):
    got = rows(A.top_badge_per_year(site["Badges"], ties="first", method=method))
    assert got == [("2019", "Editor", 0.5), ("2020", "Editor", 0.5), ("2021", "Teacher", TWO_THIRDS)]


@pytest.mark.parametrize("method", ["aggregate", "window"])
def test_q3_all_keeps_ties_without_crossing_years(site, method):
    got = rows(A.top_badge_per_year(site["Badges"], ties="all", method=method))
    assert got == [
        ("2019", "Editor", 0.5),
        ("2019", "Teacher", 0.5),
        ("2020", "Editor", 0.5),
        ("2021", "Teacher", TWO_THIRDS),
    ]


def test_q3_share_is_double_not_decimal(site):
    df = A.top_badge_per_year(site["Badges"])
    assert df.schema["MaxPercentage"].dataType.simpleString() == "double"


def test_q4_top_questions_by_comment_score(site):
    got = ordered(A.top_questions_by_comment_score(site["Comments"], site["Posts"], site["Users"]))
    assert got == [
        ("Visa", 2, 100, 5, "ana", 500, "Oslo"),
        ("Rail", 1, 50, 5, "bo", 20, N),
        ("", 1, 70, N, N, 5, ""),
    ]


def test_q5_top_posts_by_covid_votes(site):
    got = ordered(A.top_posts_by_covid_votes(site["Posts"], site["Votes"]))
    assert got == [
        ("Visa", "2019-03-01", 1, 1, 2, 0, 3),
        ("Rail", "2019-12-31", 2, 0, 2, 1, 3),
        ("Orphan", "2018-05-05", 6, 2, 1, 0, 3),
    ]


def test_q5_period_counts_add_up(site):
    c = A.covid_vote_counts(site["Votes"])
    bad = c.filter(
        F.col("BeforeCOVIDVotes") + F.col("DuringCOVIDVotes") + F.col("AfterCOVIDVotes")
        != F.col("Votes")
    )
    assert bad.count() == 0


def test_question_filter_is_applied(site):
    # the type-5 post with views must not reach Q2 (user 13 owns only it)
    ids = [r.Id for r in A.top_question_owners(site["Users"], site["Posts"]).collect()]
    assert 13 not in ids


@pytest.mark.parametrize(
    "name, fn",
    [
        ("posts_per_year", lambda t: A.posts_per_year(t["Posts"])),
        ("top_question_owners", lambda t: A.top_question_owners(t["Users"], t["Posts"])),
        ("top_badge_per_year", lambda t: A.top_badge_per_year(t["Badges"])),
        (
            "top_questions_by_comment_score",
            lambda t: A.top_questions_by_comment_score(t["Comments"], t["Posts"], t["Users"]),
        ),
        ("top_posts_by_covid_votes", lambda t: A.top_posts_by_covid_votes(t["Posts"], t["Votes"])),
    ],
)
def test_sql_text_equals_dataframe(spark, site, name, fn):
    via_sql = run_sql(spark, SITE_SQL[name], site)
    assert rows(via_sql) == rows(fn(site))


def test_q5_keep_ties_and_bad_tie_rule(site):
    from qalens.operators import top_by_period_counts

    counts = A.covid_vote_counts(site["Votes"])
    kw = dict(entity_key="Id", count_key="PostId", lead="DuringCOVIDVotes", total="Votes",
              entity_cols=[F.col("Title")], k=1)
    keep = top_by_period_counts(site["Posts"], counts, ties="keep", **kw).collect()
    assert sorted(r.PostId for r in keep) == [1, 2]  # both have 2 during-votes: rank 1
    kw["k"] = 3  # posts 3, 5 and 6 share rank 3 with 1 during-vote each
    keep = top_by_period_counts(site["Posts"], counts, ties="keep", **kw).collect()
    assert sorted(r.PostId for r in keep) == [1, 2, 3, 5, 6]
    with pytest.raises(ValueError):
        top_by_period_counts(site["Posts"], counts, ties="bogus", **kw)


def test_q4_keep_ties(site):
    got = ordered(A.top_questions_by_comment_score(
        site["Comments"], site["Posts"], site["Users"], k=1, ties="keep"))
    assert got == [("Visa", 2, 100, 5, "ana", 500, "Oslo"), ("Rail", 1, 50, 5, "bo", 20, N)]


def test_q5_custom_periods(site):
    # 'during' = 2020 only, 'after' = 2021 onwards; other years are 'before'
    got = ordered(A.top_posts_by_covid_votes(
        site["Posts"], site["Votes"], periods={"after": ("2021", "2022", "2023"), "during": ("2020",)}))
    assert [(r[0], r[3], r[4], r[5]) for r in got] == [
        ("Visa", 2, 1, 0), ("Orphan", 1, 1, 1)]


def test_post_type_parameter(site):
    # answers (type 2) instead of questions: post 3 (owner 10, comment score 9) and post 7
    got = ordered(A.top_questions_by_comment_score(
        site["Comments"], site["Posts"], site["Users"], post_type=2))
    assert got == [(N, 3, N, 9, "ana", 500, "Oslo")]
    assert ordered(A.top_question_owners(site["Users"], site["Posts"], post_type=5)) == [(13, "di", 7)]
