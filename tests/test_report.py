"""The end-to-end report: both forms of every analysis agree; the CLI runs."""

from pyspark.sql import functions as F

from qalens.__main__ import main
from qalens.plans.report import ANALYSES, cross_check
from qalens.session import shared_dir
from qalens.sources import write_parquet


def test_cross_check_fixture(spark, site):
    rows = {r.analysis: r for r in cross_check(spark, site).collect()}
    assert set(rows) == set(ANALYSES)
    assert all(r.rows_differing == 0 for r in rows.values())
    assert rows["posts_per_year"].rows_dataframe == 6
    assert rows["top_posts_by_covid_votes"].rows_sql == 3


def test_cross_check_follows_the_data(spark, site):
    broken = dict(site)
    broken["Votes"] = site["Votes"].withColumn("VoteTypeId", F.lit(3))  # type 2 becomes counted
    rows = {r.analysis: r for r in cross_check(spark, broken).collect()}
    assert rows["top_posts_by_covid_votes"].rows_differing == 0  # both forms see the same data
    assert rows["top_posts_by_covid_votes"].rows_dataframe == 3


def test_cli_convert_and_run(spark, site, capsys):
    data = shared_dir(spark, "site-pq")
    for name, df in site.items():
        write_parquet(df, f"{data}/{name}.parquet")
    out = shared_dir(spark, "site-out")
    assert main(["run", data, "--format", "parquet", "--out", out, "--check", "--time", "1"]) == 0
    printed = capsys.readouterr().out
    assert "top_badge_per_year" in printed
    assert printed.count("dataframe ") == 5 and printed.count("\tsql ") == 5
    q5 = spark.read.parquet(f"{out}/top_posts_by_covid_votes").collect()
    assert sorted(r.PostId for r in q5) == [1, 2, 6]


def test_csv_export_to_analyses_end_to_end(spark):
    """Site-shaped CSV exports of the supplied tables -> convert once -> analyses."""
    from pyspark.sql import functions as F

    import __spark_entry__ as entry
    from conftest import SF_SMALL
    from qalens.plans import site_standins as S
    from qalens.plans.report import run_analyses
    from qalens.sources import convert_to_parquet, load_tables, write_csv

    views = {
        "Posts": S.site_posts_from_orders(spark, SF_SMALL),
        "Users": S.site_users(spark, SF_SMALL),
        "Comments": S.site_comments(spark, SF_SMALL),
        "Badges": S.site_badges(spark, SF_SMALL),
        "Votes": S.site_votes(spark, SF_SMALL),
    }
    src = shared_dir(spark, "site-csv")
    for name, df in views.items():
        ts_cols = [c for c, t in df.dtypes if t == "timestamp_ntz"]
        text = df.select(*[
            F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias(c) if c in ts_cols else F.col(c)
            for c in df.columns
        ])
        write_csv(text, f"{src}/{name}.csv.gz")
    dst = shared_dir(spark, "site-pq")
    convert_to_parquet(spark, src, dst, files_per_table=4)
    results = run_analyses(load_tables(spark, dst, "parquet"))
    expected = {
        "posts_per_year": "site_q1_posts_per_year",
        "top_question_owners": "site_q2_top_question_owners",
        "top_badge_per_year": "site_q3_top_badge_per_year",
        "top_questions_by_comment_score": "site_q4_top_questions_by_comment_score",
    }
    for analysis, key in expected.items():
        want = entry.queries()[key](spark, SF_SMALL)
        assert sorted(map(tuple, results[analysis].collect()), key=repr) == sorted(
            map(tuple, want.collect()), key=repr
        ), analysis


def test_cli_writes_csv_results(spark, site):
    from qalens.sources import read_csv

    data = shared_dir(spark, "site-pq-csvout")
    for name, df in site.items():
        write_parquet(df, f"{data}/{name}.parquet")
    out = shared_dir(spark, "site-csv-out")
    assert main(["run", data, "--out", out, "--out-format", "csv"]) == 0
    back = read_csv(spark, f"{out}/posts_per_year", "Year string, TotalNumber long", by_header=True)
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(
        [(None, 2), ("2018", 1), ("2019", 2), ("2020", 1), ("2021", 1), ("2022", 1)], key=repr
    )


def test_cli_explain(spark, site, capsys):
    data = shared_dir(spark, "site-pq-explain")
    for name, df in site.items():
        write_parquet(df, f"{data}/{name}.parquet")
    assert main(["run", data, "--explain"]) == 0
    printed = capsys.readouterr().out
    assert printed.count("== Physical Plan ==") == 5 and "TakeOrderedAndProject" in printed


def test_cli_table_paths(spark, site, capsys):
    data = shared_dir(spark, "site-pq-paths")
    for name, df in site.items():
        write_parquet(df, f"{data}/{name.lower()}-export.parquet")
    args = ["run", "/nonexistent", "--explain"]
    for name in site:
        args += ["--path", f"{name}={data}/{name.lower()}-export.parquet"]
    assert main(args) == 0
    assert capsys.readouterr().out.count("== Physical Plan ==") == 5


def test_cli_convert_with_rejects_and_pruned_run(spark, tmp_path, capsys):
    src, dst = tmp_path / "src", str(tmp_path / "dst")
    src.mkdir()
    (src / "Posts.csv").write_text(
        "Id,PostTypeId,OwnerUserId,CreationDate,Title,ViewCount,CommentCount\n"
        '1,1,7,2019-05-01T10:00:00.000,"a, ""b""\nc",10,1\n2,1,8,bad,T,many,0\n3,2,7,2020-01-01,,5,0\n'
    )
    (src / "Users.csv").write_text("Id,DisplayName,Reputation,Location\n7,ann,1,\n8,bob,2,x\n")
    (src / "Comments.csv").write_text("PostId,Score\n1,3\n1,4\n2,1\n3,9\n")
    (src / "Badges.csv").write_text("Id,Name,Date\n1,A,2019-01-01\n")
    (src / "Votes.csv").write_text("PostId,VoteTypeId,CreationDate\n1,3,2019-06-01\n1,4,2020-06-01\n2,12,2018-01-01\n")
    assert main(["convert", str(src), dst, "--format", "csv", "--rejects"]) == 0
    out = capsys.readouterr().out
    assert "rejected\tPosts\tCreationDate\t1" in out and "rejected\tPosts\tViewCount\t1" in out
    assert main(["run", dst]) == 0
    plain = capsys.readouterr().out
    assert main(["run", dst, "--prune"]) == 0
    assert capsys.readouterr().out == plain and "ann" in plain
