"""Every registered workload equals its independent DuckDB SQL."""

import pytest

import __spark_entry__ as entry
from conftest import SF_MID, SF_SMALL
from oracle_compare import compare, duck

KEYS = sorted({**entry.WORKLOADS, **entry.SITE_WORKLOADS, **entry.TABLE_WORKLOADS})


@pytest.fixture(scope="module")
def con_small():
    return duck(SF_SMALL)


@pytest.fixture(scope="module")
def con_mid():
    return duck(SF_MID)


def test_every_key_has_an_oracle():
    assert set(KEYS) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle_small(spark, con_small, key):
    r = compare(spark, con_small, key, entry.queries()[key], entry.oracle_sql()[key], SF_SMALL)
    assert r["columns_match"], r
    assert r["rows_spark"] == r["rows_oracle"], r
    assert r["values_match"], r


# Row counts at sf 0.01 as profiled in FIXTURES.md.
EXPECTED_ROWS_MID = {
    "year_count": 7, "sql_year_count": 7, "top_owner": 10, "argmax_ties": 7, "argmax_one": 7,
    "argmax_join": 7, "window_share": 150, "child_score": 10, "period_pivot": 20,
    "having_min": 228, "left_join": 20, "topn_ties": 17, "null_group": 5,
    "allnull_sum": 5, "null_key_join": 1, "nullsafe_join": 1, "not_in_empty": 1,
    "dirty_dates": 8,
}


@pytest.mark.parametrize("key", sorted(EXPECTED_ROWS_MID))
def test_key_matches_oracle_mid(spark, con_mid, key):
    r = compare(spark, con_mid, key, entry.queries()[key], entry.oracle_sql()[key], SF_MID)
    assert r["values_match"], r
    assert r["rows_spark"] == EXPECTED_ROWS_MID[key]


def test_join_counts_mid(spark):
    q = entry.queries()
    assert q["null_key_join"](spark, SF_MID).collect()[0].n == 14988
    assert q["nullsafe_join"](spark, SF_MID).collect()[0].n == 15000
    assert q["not_in_empty"](spark, SF_MID).collect()[0].n == 9026


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["Title", "Date", "PostId", "BeforeCOVIDVotes", "DuringCOVIDVotes",
                          "AfterCOVIDVotes", "Votes"]
    rows = df.collect()
    assert len(rows) == 20 and rows == sorted(rows, key=lambda r: (-r.DuringCOVIDVotes, -r.Votes, r.PostId))


def test_full_outer_counts_every_line_and_q5_has_dates(spark):
    q = entry.queries()
    total = q["full_outer"](spark, SF_MID).agg({"TotalLines": "sum"}).first()[0]
    assert total == spark.read.parquet(f"{SF_MID}/lineitem.parquet").count()
    dated = q["site_q5_dated_posts"](spark, SF_MID).collect()
    assert len(dated) == 20 and all(r.Date for r in dated)
