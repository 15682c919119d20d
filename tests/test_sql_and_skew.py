"""SQL dialect details, ordered comparison, and a hot key holding a third of the rows."""

import re

from pyspark.sql import functions as F
from pyspark.testing import assertDataFrameEqual

from qalens.operators import rollup_children
from qalens.plans import analyses as A
from qalens.plans.inspect import plan_text
from qalens.plans.sql import run_sql


def test_group_by_select_alias_is_case_insensitive(spark, site):
    q = "SELECT date_format(CreationDate, 'yyyy') AS Year, COUNT(*) AS TotalNumber FROM {Posts} GROUP BY YEAR"
    got = run_sql(spark, q, site)
    assertDataFrameEqual(got, A.posts_per_year(site["Posts"]))


def test_source_column_wins_over_select_alias(spark):
    # D21: a source column named like the alias is what GROUP BY uses
    df = spark.createDataFrame([("2019-01", 1), ("2019-02", 2), ("2020-01", 3)], "Year string, v int")
    got = run_sql(spark, "SELECT substr(Year, 1, 2) AS Year, COUNT(*) AS n FROM {t} GROUP BY Year", {"t": df})
    assert got.count() == 3  # grouped by the source column, not by the two-character alias


def test_derived_table_without_alias(spark, site):
    q = "SELECT COUNT(*) AS n FROM (SELECT Id FROM {Posts} WHERE PostTypeId = 1)"
    assert run_sql(spark, q, site).collect()[0].n == 5


def test_ordered_type_strict_results(spark, site):
    expected = spark.createDataFrame(
        [(10, "ana", 100), (12, None, 70), (11, "bo", 50)], "Id long, DisplayName string, TotalViews long"
    )
    assertDataFrameEqual(A.top_question_owners(site["Users"], site["Posts"]), expected, checkRowOrder=True)
    q5 = A.top_posts_by_covid_votes(site["Posts"], site["Votes"])
    assert [r.PostId for r in q5.collect()] == [1, 2, 6]


def test_hot_owner_is_split_by_aqe_and_result_is_exact(spark):
    """One owner owns a third of all parents; with broadcasts off, AQE's skew
    handling splits that owner's partition and the top-k is still exact."""
    n = 30000
    parents = spark.range(n).select(
        F.col("id").alias("pid"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("owner"),
        F.concat(F.lit("title "), F.col("id").cast("string")).alias("title"),
    )
    owners = spark.range(n).select(F.col("id").alias("uid"), F.concat(F.lit("u"), F.col("id").cast("string")).alias("name"))
    child = spark.range(3 * n).select((F.col("id") % n).alias("pid"), (F.col("id") % 97).alias("score"))
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.shuffle.partitions": "8",  # skew is relative to the other partitions
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = rollup_children(
            child, parents, owners,
            child_parent_key="pid", child_score="score", parent_key="pid", parent_owner_key="owner",
            owner_key="uid", parent_cols=["pid", "title"], owner_cols=["name"],
            score_name="s", k=5,
        )
        got = [tuple(r) for r in df.collect()]
        text = plan_text(df)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    # brute force: per parent, the score sum of its three children
    sums = {}
    for i in range(3 * n):
        sums[i % n] = sums.get(i % n, 0) + (i % 97)
    best = sorted(sums.items(), key=lambda kv: (-kv[1], kv[0]))[:5]
    expected = [(p, f"title {p}", s, f"u{7 if p % 3 == 0 else p}") for p, s in best]
    assert got == expected
    assert re.search(r"skew=true", text), "AQE did not split the hot owner"
