"""Column types of the question-and-answer site tables.

Only the columns the analyses read are typed here; any other column of a file
is read as text. Time columns arrive as text and are parsed once at load.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    IntegerType,
    LongType,
    StringType,
    TimestampNTZType,
)

LONG = LongType()
INT = IntegerType()
TEXT = StringType()
TS = TimestampNTZType()

TABLES: dict[str, dict[str, DataType]] = {
    "Posts": {
        "Id": LONG,
        "PostTypeId": INT,
        "OwnerUserId": LONG,
        "CreationDate": TS,
        "Title": TEXT,
        "ViewCount": LONG,
        "CommentCount": LONG,
    },
    "Users": {
        "Id": LONG,
        "DisplayName": TEXT,
        "Reputation": LONG,
        "Location": TEXT,
    },
    "Comments": {
        "PostId": LONG,
        "Score": LONG,
    },
    "Badges": {
        "Id": LONG,
        "Name": TEXT,
        "Date": TS,
    },
    "Votes": {
        "PostId": LONG,
        "VoteTypeId": INT,
        "CreationDate": TS,
    },
}

# Relationships the analyses rely on (child column -> parent table.column).
FOREIGN_KEYS = {
    ("Posts", "OwnerUserId"): ("Users", "Id"),
    ("Comments", "PostId"): ("Posts", "Id"),
    ("Votes", "PostId"): ("Posts", "Id"),
}
