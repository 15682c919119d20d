"""CSV and Parquet loading: quoting, line breaks, empty text, bad dates, round trips."""

import gzip
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from qalens.operators import table_diff
from qalens.plans import analyses as A
from qalens.session import shared_dir
from qalens.sources import convert_to_parquet, load_table, load_tables, read_csv, rejected_values, write_csv
from site_fixture import POSTS

CSV_POSTS = (
    "Id,PostTypeId,OwnerUserId,CreationDate,Title,ViewCount,CommentCount,Body\n"
    '1,1,10,2019-03-01T08:00:00.000,,100,2,plain\n'
    '2,1,11,2019-12-31T23:59:59.999,"","50",1,"line one\nline two, with ""quote"""\n'
    "3,1,NA,bad,NA,NA,0,x\n"
)


def _write_gz(path, text):
    with gzip.open(path, "wt", encoding="utf-8") as f:
        f.write(text)


def test_csv_gz_multiline_quotes_empty_and_bad_dates(spark):
    d = tempfile.mkdtemp(prefix="qalens-csv-")
    _write_gz(os.path.join(d, "Posts.csv.gz"), CSV_POSTS)
    posts = load_table(spark, d, "Posts", "csv.gz")
    got = {r.Id: r for r in posts.collect()}
    assert set(got) == {1, 2, 3}  # the quoted line break did not split a record
    assert got[1].Title is None and got[2].Title is None  # both kinds of empty text
    assert got[3].CreationDate is None  # bad date -> NULL, row kept
    assert got[3].OwnerUserId is None  # 'NA' in a number column -> NULL
    assert got[3].Title == "NA"  # 'NA' text stays text
    assert str(got[2].CreationDate) == "2019-12-31 23:59:59.999000"
    # the extra Body column is ignored; columns come by header name
    assert posts.columns == ["Id", "PostTypeId", "OwnerUserId", "CreationDate", "Title",
                             "ViewCount", "CommentCount"]


def test_csv_columns_by_header_name_in_any_order(spark):
    d = tempfile.mkdtemp(prefix="qalens-csv-")
    _write_gz(
        os.path.join(d, "Users.csv.gz"),
        "Location,Reputation,AboutMe,DisplayName,Id\nOslo,500,hi,ana,10\n,20,,bo,11\n",
    )
    u = load_table(spark, d, "Users", "csv.gz")
    assert sorted(tuple(r) for r in u.collect()) == [(10, "ana", 500, "Oslo"), (11, "bo", 20, None)]


def test_convert_to_parquet_then_analyse(spark, site):
    src = tempfile.mkdtemp(prefix="qalens-src-")
    for name, df in site.items():
        write_csv(df.select([F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSS").alias(c)
                             if df.schema[c].dataType.simpleString() == "timestamp_ntz"
                             else F.col(c) for c in df.columns]).coalesce(1),
                  os.path.join(src, f"{name}.csv.gz"))
    dst = shared_dir(spark, "converted")
    paths = convert_to_parquet(spark, src, dst, files_per_table=2)
    assert set(paths) == set(site)
    t = load_tables(spark, dst, "parquet")
    assert sorted(map(tuple, A.posts_per_year(t["Posts"]).collect()), key=repr) == sorted(
        map(tuple, A.posts_per_year(site["Posts"]).collect()), key=repr
    )
    # CSV turns the empty title into NULL (D14): Q5 is unaffected, Q4 keeps the row
    q4 = A.top_questions_by_comment_score(t["Comments"], t["Posts"], t["Users"]).collect()
    assert q4[-1].Title is None and q4[-1].ViewCount == 70


def test_csv_roundtrip_exact_for_text_and_microseconds(spark):
    for name in ("documents", "events"):
        src = spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")
        path = shared_dir(spark, f"rt-{name}")
        write_csv(src, path)
        back = read_csv(spark, path, src.schema)
        assert table_diff(src, back).count() == 0


def test_posts_fixture_has_bad_date():
    assert any(p[3] == "not a date" for p in POSTS)


def test_r_style_csv_row_names_and_na(spark):
    d = tempfile.mkdtemp(prefix="qalens-csv-")
    _write_gz(
        os.path.join(d, "Users.csv.gz"),
        '"","Id","DisplayName","Reputation","Location"\n'
        '"1",10,"ana",500,"Oslo"\n'
        '"2",11,NA,20,""\n'
        '"3",12,"NA",NA,NA\n',
    )
    u = load_table(spark, d, "Users", "csv.gz", csv_options={"nullValue": "NA"})
    got = sorted(tuple(r) for r in u.collect())
    # unquoted NA is missing; quoted "" stays empty text under this dialect
    assert got[0] == (10, "ana", 500, "Oslo")
    assert got[1] == (11, None, 20, "")
    assert got[2][0] == 12 and got[2][2] is None and got[2][3] is None


def test_text_columns_from_parquet_convert_leniently(spark):
    from qalens.sources import apply_schema

    raw = spark.createDataFrame(
        [("1", "10", "NA", "2019-01-01T00:00:00.000", "x", "12", "3")],
        "Id string, PostTypeId string, OwnerUserId string, CreationDate string, "
        "Title string, ViewCount string, CommentCount string",
    )
    row = apply_schema(raw, "Posts").collect()[0]
    assert (row.Id, row.PostTypeId, row.OwnerUserId, row.ViewCount) == (1, 10, None, 12)


def test_load_tables_with_explicit_paths(spark):
    d = tempfile.mkdtemp(prefix="qalens-csv-")
    _write_gz(os.path.join(d, "users-export.csv.gz"), "Id,DisplayName,Reputation,Location\n10,ana,500,Oslo\n")
    t = load_tables(spark, "/nonexistent", "csv.gz", tables=["Users"],
                    paths={"Users": os.path.join(d, "users-*.csv.gz")})
    assert [tuple(r) for r in t["Users"].collect()] == [(10, "ana", 500, "Oslo")]


def test_files_of_one_table_with_different_headers(spark):
    d = tempfile.mkdtemp(prefix="qalens-csv-")
    _write_gz(os.path.join(d, "Users-1.csv.gz"), "Id,DisplayName,Reputation,Location\n1,ana,5,Oslo\n")
    _write_gz(os.path.join(d, "Users-2.csv.gz"), "Id,Location,Extra,Reputation,DisplayName\n2,Lima,x,7,bo\n")
    _write_gz(os.path.join(d, "Users-3.csv.gz"), "")
    paths = {"Users": os.path.join(d, "Users-*.csv.gz")}
    t = load_tables(spark, d, tables=["Users"], paths=paths)
    assert sorted(map(tuple, t["Users"].collect())) == [(1, "ana", 5, "Oslo"), (2, "bo", 7, "Lima")]
    _write_gz(os.path.join(d, "Users-4.csv.gz"), "Id,DisplayName,Reputation\n3,cy,1\n")
    with pytest.raises(ValueError, match="Location"):
        load_tables(spark, d, tables=["Users"], paths=paths)


def test_rejected_values(spark):
    d = tempfile.mkdtemp(prefix="qalens-csv-")
    _write_gz(os.path.join(d, "Posts.csv.gz"), CSV_POSTS + "x1,1,10,2019-02-30,t,1,1,y\n5,1\n")
    got = {(r.table, r.column): r.rows for r in rejected_values(spark, d, tables=["Posts"]).collect()}
    assert got == {("Posts", "OwnerUserId"): 1, ("Posts", "CreationDate"): 2, ("Posts", "ViewCount"): 1, ("Posts", "Id"): 1, ("Posts", "(record)"): 1}
    assert load_table(spark, d, "Posts").count() == 5
    clean = spark.createDataFrame([(1, "a", 2, "b")], "Id long, DisplayName string, Reputation long, Location string")
    clean.write.parquet(os.path.join(d, "Users.parquet"))
    assert rejected_values(spark, d, "parquet", ["Users"]).count() == 0


def test_empty_text_reads_back_as_null(spark):
    path = shared_dir(spark, "rt-empty")
    write_csv(spark.createDataFrame([(1, ""), (2, " "), (3, None)], "id long, v string"), path)
    assert sorted(map(tuple, read_csv(spark, path, "id long, v string").collect())) == [(1, None), (2, " "), (3, None)]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from qalens.session import checkpoint_root

    conf = SimpleNamespace(get=lambda key, default=None: default)
    cluster = SimpleNamespace(sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077"), conf=conf)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_root(cluster)
