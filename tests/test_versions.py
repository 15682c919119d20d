"""Rewriting tables that are read, rejects and clustered files."""

import threading

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from qalens.sources.sinks import write_parquet
from qalens.sources.tables import convert_to_parquet, load_table, rejected_rows, rejected_values
from qalens.sources.versions import current_version, drop_old_versions, read_version, write_version


def test_a_reader_always_sees_one_whole_version(spark, tmp_path):
    path = str(tmp_path / "t")
    write_version(spark.range(100).withColumn("v", F.lit(0)), path)
    seen, stop, errors = [], threading.Event(), []

    def read():
        while not stop.is_set():
            try:
                rows = read_version(spark, path).groupBy("v").count().collect()
                seen.append([(r.v, r["count"]) for r in rows])
            except Exception as e:  # noqa: BLE001
                errors.append(e)

    reader = threading.Thread(target=read)
    reader.start()
    for v in range(1, 6):
        write_version(spark.range(100 + v).withColumn("v", F.lit(v)), path)
        with pytest.raises(PySparkException):
            write_version(spark.range(9).select(F.raise_error(F.lit("no")).cast("int").alias("v"), "id"), path)
    stop.set()
    reader.join()
    assert not errors and seen and all(len(s) == 1 and s[0][1] == 100 + s[0][0] for s in seen)
    assert read_version(spark, path).count() == 105


def test_old_versions_go_and_the_current_one_stays(spark, tmp_path):
    path = str(tmp_path / "t")
    assert current_version(spark, path) is None and drop_old_versions(spark, path) == []
    with pytest.raises(ValueError):
        read_version(spark, path)
    names = [write_version(spark.range(n), path) for n in (1, 2, 3)]
    with pytest.raises(PySparkException):
        write_version(spark.range(9).select(F.raise_error(F.lit("no")).cast("int").alias("v")), path)
    names.append(write_version(read_version(spark, path).union(spark.range(1)), path))
    gone = drop_old_versions(spark, path, keep=2)
    assert set(names[:2]) < set(gone) and len(gone) == 3
    assert read_version(spark, path).count() == 4 and read_version(spark, path, names[2]).count() == 3
    assert current_version(spark, path) == names[3]
    with pytest.raises(ValueError):
        drop_old_versions(spark, path, keep=0)


def test_rejects_are_kept_row_by_row(spark, tmp_path):
    (tmp_path / "Votes.csv").write_text(
        "PostId,VoteTypeId,CreationDate\n1,2,2019-01-01\nx,2,2019-13-01\n3,two,\n4,5,2020-05-05T08:00\n5,6\n"
    )
    convert_to_parquet(spark, str(tmp_path), str(tmp_path / "out"), fmt="csv", tables=["Votes"], rejects=True)
    got = {(r.table, r.column, r.value) for r in rejected_rows(spark, str(tmp_path / "out"), ["Votes"]).collect()}
    assert got == {("Votes", "PostId", "x"), ("Votes", "CreationDate", "2019-13-01"), ("Votes", "VoteTypeId", "two"), ("Votes", "(record)", "5,6")}
    counts = {(r["column"], r["rows"]) for r in rejected_values(spark, str(tmp_path), "csv", ["Votes"]).collect()}
    assert counts == {("PostId", 1), ("CreationDate", 1), ("VoteTypeId", 1), ("(record)", 1)}
    loaded = load_table(spark, str(tmp_path / "out"), "Votes", "parquet")
    assert loaded.columns == ["PostId", "VoteTypeId", "CreationDate"] and loaded.count() == 5


def test_clustered_files_hold_narrow_ranges(spark, tmp_path):
    df = spark.range(20000).select("id", (F.xxhash64("id") % 5).alias("kind"), F.lit("x").alias("t")).repartition(6)
    write_parquet(df, str(tmp_path / "c"), cluster_by=["kind"], files=6)
    back = spark.read.parquet(str(tmp_path / "c"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))
    spans = back.groupBy(F.col("_metadata.file_name")).agg((F.max("kind") - F.min("kind")).alias("span"), F.count("*").alias("n")).collect()
    assert max(r.span for r in spans) <= 4 and sum(r.span for r in spans) <= 12
    assert max(r.n for r in spans) < 5000  # ties are spread
