"""Streaming counts equal the batch operators once the stream has caught up."""

import os
import shutil

import __spark_entry__ as entry
from conftest import SF_SMALL
from qalens.session import shared_dir
from qalens.streaming import read_stream, start_count_by_period, start_top_category_per_period


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_stream_matches_batch_then_grows(spark):
    src = spark.read.parquet(f"{SF_SMALL}/orders.parquet")
    inbox = shared_dir(spark, "inbox").replace("file:", "")
    os.makedirs(inbox)
    shutil.copy(f"{SF_SMALL}/orders.parquet", os.path.join(inbox, "part-0.parquet"))
    stream = read_stream(spark, inbox, src.schema)
    out_q1 = shared_dir(spark, "q1-out")
    out_q3 = shared_dir(spark, "q3-out")
    ck1, ck3 = shared_dir(spark, "ck1"), shared_dir(spark, "ck3")

    def run():
        q1 = start_count_by_period(stream, "o_orderdate", out_q1, checkpoint=ck1)
        q3 = start_top_category_per_period(stream, "o_orderdate", "o_orderpriority", out_q3, checkpoint=ck3)
        q1.awaitTermination(120)
        q3.awaitTermination(120)

    run()
    assert _rows(spark.read.parquet(out_q1)) == _rows(entry.queries()["year_count"](spark, SF_SMALL))
    assert _rows(spark.read.parquet(out_q3)) == _rows(entry.queries()["argmax_one"](spark, SF_SMALL))

    # a restart with nothing new changes nothing: no file is counted twice
    run()
    assert _rows(spark.read.parquet(out_q1)) == _rows(entry.queries()["year_count"](spark, SF_SMALL))

    # a second file arrives: the restarted query adds it from its checkpoint, once
    shutil.copy(f"{SF_SMALL}/orders.parquet", os.path.join(inbox, "part-1.parquet"))
    run()
    doubled = [(y, 2 * n) for y, n in _rows(entry.queries()["year_count"](spark, SF_SMALL))]
    assert _rows(spark.read.parquet(out_q1)) == doubled


def test_registered_stream_leaves_the_session_as_it_was(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    df = entry.queries()["stream_year_count"](spark, SF_SMALL)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert _rows(df) == _rows(entry.queries()["year_count"](spark, SF_SMALL))
