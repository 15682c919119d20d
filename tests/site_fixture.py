"""Edge fixture: the five site tables with NULLs, empty text, bad dates and ties."""

from qalens.sources.tables import apply_schema, text_schema

N = None

POSTS = [
    (1, 1, 10, "2019-03-01T08:00:00.000", "Visa", 100, 2),
    (2, 1, 11, "2019-12-31T23:59:59.999", "Rail", 50, 1),
    (3, 2, 10, "2020-01-01T00:00:00.000", N, N, 3),
    (4, 1, 10, "2021-06-15T12:00:00.000", "Bus", N, 0),
    (5, 1, 12, "2022-02-02T02:02:02.020", "", 70, 1),
    (6, 1, N, "2018-05-05T05:05:05.050", "Orphan", 999, 1),
    (7, 2, 13, N, N, N, 0),
    (8, 5, 13, "not a date", N, 7, 0),
]
USERS = [(10, "ana", 500, "Oslo"), (11, "bo", 20, N), (12, N, 5, ""), (13, "di", 1, "Lima")]
COMMENTS = [(1, 1, 3), (2, 1, 2), (3, 2, 5), (4, 3, 9), (5, 5, N), (6, 6, 4), (7, N, 8)]
BADGES = [
    (1, "Teacher", "2019-01-01"), (2, "Teacher", "2019-02-01"), (3, "Editor", "2019-03-01"),
    (4, "Editor", "2019-04-01"), (5, "Editor", "2020-01-01"), (6, "Teacher", "2020-01-02"),
    (7, "Editor", "2020-01-03"), (8, "Critic", "2020-01-04"), (9, "Critic", "2020-01-05"),
    (10, "Editor", "2020-01-06"), (11, N, "2021-01-01"), (12, "Teacher", "2021-01-02"),
    (13, "Teacher", "2021-01-03"), (14, "Teacher", N),
]
VOTES = [
    (1, 1, 3, "2019-05-01"), (2, 1, 3, "2020-05-01"), (3, 1, 4, "2018-05-01"),
    (4, 1, 2, "2019-06-01"), (5, 2, 12, "2021-01-01"), (6, 2, 3, "2021-02-01"),
    (7, 2, 3, "2022-01-01"), (8, 3, 3, "2020-01-01"), (9, 4, 3, "2018-01-01"),
    (10, 5, 3, "2020-02-02"), (11, 6, 3, "2020-03-03"), (12, 6, 3, "2023-03-03"),
    (13, 6, 3, N), (14, N, 3, "2020-01-01"),
]


# As exported: every table has its own Id; time columns are text.
RAW_SCHEMAS = {
    "Posts": text_schema("Posts"),
    "Users": text_schema("Users"),
    "Comments": "Id long, PostId long, Score long",
    "Badges": text_schema("Badges"),
    "Votes": "Id long, PostId long, VoteTypeId int, CreationDate string",
}


def site_tables(spark):
    raw = {"Posts": POSTS, "Users": USERS, "Comments": COMMENTS, "Badges": BADGES, "Votes": VOTES}
    return {
        name: apply_schema(spark.createDataFrame(rows, RAW_SCHEMAS[name]), name)
        for name, rows in raw.items()
    }
