"""Operator invariants and equivalences, checked against brute force."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qalens.functions import in_years, label_by_value, not_blank, null_if, parse_timestamp, period_label, period_start
from qalens.operators import (
    count_by_key,
    full_outer_merge,
    join_row_count,
    period_counts,
    rows_only_in,
    schema_diff,
    share_of_period,
    table_diff,
    top_category_per_period,
    top_k,
    union_tagged,
)
from conftest import SF_SMALL


def _brute_rank_keep(values, k, ascending=False):
    nonnull = [v for v in values if v is not None]
    out = []
    for v in values:
        if v is None:
            better = len(nonnull)  # NULLs rank after every value
        elif ascending:
            better = sum(1 for x in nonnull if x < v)
        else:
            better = sum(1 for x in nonnull if x > v)
        if 1 + better <= k:
            out.append(v)
    return sorted(out, key=lambda x: (x is None, x))


@settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    values=st.lists(st.one_of(st.none(), st.integers(0, 6)), min_size=0, max_size=25),
    k=st.integers(1, 8),
    ascending=st.booleans(),
)
def test_top_k_keep_equals_rank(spark, values, k, ascending):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, m long")
    got = top_k(df, "m", k, ascending=ascending, ties="keep").collect()
    got = sorted((r.m for r in got), key=lambda x: (x is None, x))
    assert got == _brute_rank_keep(values, k, ascending)


def test_top_k_cut_is_deterministic(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(30)], "id long, m long")
    got = [tuple(r) for r in top_k(df, "m", 5, tiebreak=["id"]).collect()]
    assert got == [(2, 2), (5, 2), (8, 2), (11, 2), (14, 2)]
    with pytest.raises(ValueError):
        top_k(df, "m", 5, ties="bogus")


def _orders(spark):
    return spark.read.parquet(f"{SF_SMALL}/orders.parquet")


@pytest.mark.parametrize("ties", ["first", "all"])
def test_argmax_methods_agree(spark, ties):
    o = _orders(spark)
    a = top_category_per_period(o, "o_orderdate", "o_orderpriority", ties=ties, method="aggregate")
    w = top_category_per_period(o, "o_orderdate", "o_orderpriority", ties=ties, method="window")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, w.collect()))


def test_share_methods_agree_and_sum_to_one(spark):
    o = _orders(spark)
    a = share_of_period(o, "o_orderdate", "o_orderstatus", "yyyy-MM")
    w = share_of_period(o, "o_orderdate", "o_orderstatus", "yyyy-MM", method="window")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, w.collect()))
    sums = a.groupBy("Year").agg(F.sum("Share").alias("s")).collect()
    assert all(abs(r.s - 1.0) < 1e-9 for r in sums)


def test_period_counts_equal_split_and_full_join(spark):
    li = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").filter(F.col("l_returnflag").isin("A", "R"))
    label = label_by_value(period_label("l_shipdate"), {"after": ("2001",), "during": ("1998", "1999", "2000")}, "before")
    cols = {"before": "b", "during": "d", "after": "a"}
    one_pass = period_counts(li, "l_partkey", label, cols, entity_name="k", total_name="t")
    parts = [
        count_by_key(li.filter(label == v), "l_partkey", key_name="k", count_name=c)
        for v, c in cols.items()
    ]
    joined = full_outer_merge(full_outer_merge(parts[0], parts[1], "k"), parts[2], "k", total_name="t")
    assert table_diff(one_pass, joined.select(*one_pass.columns)).count() == 0
    bad = one_pass.filter(F.col("b") + F.col("d") + F.col("a") != F.col("t"))
    assert bad.count() == 0


def test_join_row_count_equals_materialised_join(spark):
    left = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "k long")
    right = spark.createDataFrame([(1,), (1,), (1,), (3,), (None,)], "k long")
    plain = join_row_count(left, right, "k", "k").collect()[0].n
    safe = join_row_count(left, right, "k", "k", null_safe=True).collect()[0].n
    assert plain == left.alias("l").join(right.alias("r"), F.col("l.k") == F.col("r.k")).count() == 6
    assert safe == left.alias("l").join(right.alias("r"), F.col("l.k").eqNullSafe(F.col("r.k"))).count() == 8


def test_table_diff_and_except_all(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "id long, v string")
    b = spark.createDataFrame([(1, "x"), (2, None), (4, "w")], "id int, v string")
    assert table_diff(a, a).count() == 0
    diff = sorted(map(tuple, table_diff(a, b).collect()))
    assert diff == [(1, "x", 2, 1), (3, "z", 1, 0), (4, "w", 0, 1)]
    assert sorted(map(tuple, rows_only_in(a, b.select(F.col("id").cast("long"), "v")).collect())) == [
        (1, "x"), (3, "z")]
    assert schema_diff(a.schema, b.schema) == ["type of id: bigint vs int"]


def test_union_tagged(spark):
    a = spark.createDataFrame([(1,)], "v long")
    b = spark.createDataFrame([(2,), (3,)], "v long")
    got = sorted(map(tuple, union_tagged({"a": a, "b": b}).collect()))
    assert got == [("a", 1), ("b", 2), ("b", 3)]


def test_scalar_functions(spark):
    df = spark.createDataFrame(
        [("2019-03-01T08:00:00.000", "x"), ("2011", ""), (None, None), ("2020-02-29", "5-LOW")],
        "s string, t string",
    )
    out = df.select(
        period_label(parse_timestamp("s")).alias("y"),
        period_label(parse_timestamp("s"), "day").alias("d"),
        not_blank("t").alias("nb"),
        null_if("t", "5-LOW").alias("nt"),
    ).collect()
    assert [tuple(r) for r in out] == [
        ("2019", "2019-03-01", True, "x"),
        (None, None, False, ""),
        (None, None, None, None),
        ("2020", "2020-02-29", True, None),
    ]


def test_full_outer_merge_fills_measures_only(spark):
    l = spark.createDataFrame([(1, 5), (2, 1)], "k long, a long")
    r = spark.createDataFrame([(2, 7), (3, 2)], "k long, b long")
    got = sorted(map(tuple, full_outer_merge(l, r, "k", total_name="t").collect()))
    assert got == [(1, 5, 0, 5), (2, 1, 7, 8), (3, 0, 2, 2)]


def test_parse_is_independent_of_session_time_zone(spark):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("2019-03-10T02:30:00.000",), ("2019-11-03 01:30:00",)], "s string")
        got = [str(r.t) for r in df.select(parse_timestamp("s").alias("t")).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == ["2019-03-10 02:30:00", "2019-11-03 01:30:00"]


LAYOUTS = {
    "2019-03-31T02:30:00.000": "2019-03-31 02:30:00",  # a gap in Warsaw
    "2019-03-01T08:00:00": "2019-03-01 08:00:00",
    "2019-03-01 08:00:00.123": "2019-03-01 08:00:00.123000",
    "2019-03-01T08:00:00.5": "2019-03-01 08:00:00.500000",
    "2019-03-01T08:00:00.12": "2019-03-01 08:00:00.120000",
    "2019-03-01T08:00:00.123456789Z": "2019-03-01 08:00:00.123456",
    "2019-03-01T08:00": "2019-03-01 08:00:00",
    "2019-03-01T08:00Z": "2019-03-01 08:00:00",
    "2019-03-01 08:00:00Z": "2019-03-01 08:00:00",
    "2019-03-01": "2019-03-01 00:00:00",
    "2020-02-29T23:59:59.999": "2020-02-29 23:59:59.999000",
    **dict.fromkeys(
        ["2011", "not a date", "", " 2019-03-01", "2019-13-01", "2019-02-29", "2019-03-01T24:00:00", "2019-03-01T08:60:00",
         "2019-03-01T08:00:60", "2019-03-01T08:00:00 08:00:00", "2019-03-01Z", "2019-03-01T08", "2019-03-01T08:00:00.", "2019-03-01T08:00.5"]
    ),
    None: None,
}


@pytest.mark.parametrize("zone", ["UTC", "Europe/Warsaw", "America/New_York"])
def test_every_layout_parses_alike_in_every_zone(spark, zone):
    old = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([(v,) for v in LAYOUTS], "s string")
    parsed = df.select("s", parse_timestamp("s").cast("string").alias("t"))
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = {r.s: r.t for r in parsed.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert got == {k: v and v.rstrip("0").rstrip(".") if v and "." in v else v for k, v in LAYOUTS.items()}


def test_periods_as_ranges_equal_labels(spark):
    days = [(d,) for d in ("2018-12-31", "2019-01-01", "2021-12-31", "2022-01-01", "2022-12-31", "2023-01-01", "2025-06-01", None)]
    df = spark.createDataFrame(days, "d string").select(F.col("d").cast("timestamp_ntz").alias("t"))
    years = ("2021", "2019", "2020", "2025")
    rows = df.select(in_years("t", years).alias("a"), F.coalesce(period_label("t").isin(list(years)), F.lit(False)).alias("b")).collect()
    assert all(r.a == r.b for r in rows) and sum(r.a for r in rows) == 3
    for grain in ("year", "month", "day"):
        starts = df.select(period_label(period_start("t", grain), grain).alias("a"), period_label("t", grain).alias("b")).collect()
        assert all(r.a == r.b for r in starts)


def test_full_outer_merge_null_keys(spark):
    l = spark.createDataFrame([(None, 5), (2, 1)], "k long, a long")
    r = spark.createDataFrame([(None, 7)], "k long, b long")
    rows = lambda **kw: sorted(map(tuple, full_outer_merge(l, r, "k", **kw).collect()), key=repr)
    assert rows() == [(2, 1, 0), (None, 0, 7), (None, 5, 0)]
    assert rows(null_safe=True) == [(2, 1, 0), (None, 5, 7)]


def test_table_diff_types_columns_and_keys(spark):
    one = spark.createDataFrame([(1,)], "v int")
    assert table_diff(one, spark.createDataFrame([(1.0,)], "v double")).count() == 0
    assert table_diff(one, spark.createDataFrame([(1.5,)], "v double")).count() == 2
    assert table_diff(one, spark.createDataFrame([("1",)], "v string")).count() == 0
    for text in ("abc", "1.5", ""):
        assert table_diff(one, spark.createDataFrame([(text,)], "v string")).count() == 2
        assert table_diff(spark.createDataFrame([(text,)], "v string"), one).count() == 2
    wide = one.withColumn("more", F.lit(1))
    for a, b in ((one, wide), (wide, one)):
        with pytest.raises(ValueError, match="more"):
            table_diff(a, b)
        assert table_diff(a, b, ["v"]).count() == 0
    with pytest.raises(ValueError, match="type of v"):
        table_diff(one, spark.createDataFrame([(1.0,)], "v double"), lenient_types=False)
    left = spark.createDataFrame([(1, "x", 1), (2, "y", 2), (3, "z", None), (None, "n", 4), (5, "d", 1), (5, "d", 1)], "k long, a string, b long")
    right = spark.createDataFrame([(1, "x", 1), (2, "Y", 3), (3, "z", 3), (None, "n", 4), (5, "d", 1)], "k long, a string, b long")
    got = {r.k: (r.n_left, r.n_right, sorted(r["columns"])) for r in table_diff(left, right, keys=["k"]).collect()}
    assert got == {2: (1, 1, ["a", "b"]), 3: (1, 1, ["b"]), 5: (1, 0, [])}


def test_rollup_children_with_a_parent_key_that_occurs_twice(spark):
    from qalens.operators import rollup_children

    child = spark.createDataFrame([(1, 5), (1, 1), (2, 9)], "p long, s long")
    parent = spark.createDataFrame([(1, 10, "a"), (1, 10, "b"), (1, 11, "c"), (2, 10, "d")], "id long, o long, title string")
    owner = spark.createDataFrame([(10, "x"), (11, "y")], "id long, name string")
    rows = {
        late: sorted(map(tuple, rollup_children(
            child, parent, owner, child_parent_key="p", child_score="s", parent_key="id", parent_owner_key="o", owner_key="id",
            parent_cols=["title"], owner_cols=["name"], k=10, late=late).collect()))
        for late in (True, False)
    }
    assert rows[True] == rows[False] == [("a", 6, "x"), ("b", 6, "x"), ("c", 6, "y"), ("d", 9, "x")]


def test_top_by_rollup_null_safe_matches_null_keys(spark):
    from qalens.operators import top_by_rollup

    dim = spark.createDataFrame([(1, "a"), (None, "nobody")], "id long, name string")
    fact = spark.createDataFrame([(1, 5), (None, 7), (None, 1), (2, 9)], "owner long, v long")
    kw = dict(dim_key="id", fact_key="owner", measure="v", dim_cols=["name"], k=5)
    plain = [tuple(r) for r in top_by_rollup(dim, fact, **kw).collect()]
    safe = [tuple(r) for r in top_by_rollup(dim, fact, null_safe=True, **kw).collect()]
    assert plain == [(1, "a", 5)]  # SQL '=': NULL owners and unknown owner 2 drop out
    assert safe == [(None, "nobody", 8), (1, "a", 5)]


def test_ambiguous_output_columns_are_rejected(spark):
    from qalens.operators import rollup_children

    a = spark.createDataFrame([(1, 2)], "k long, n long")
    with pytest.raises(ValueError):
        full_outer_merge(a, a, "k")
    with pytest.raises(ValueError):
        rollup_children(a, a, a, child_parent_key="k", child_score="n", parent_key="k",
                        parent_owner_key="n", owner_key="k", parent_cols=["n"], owner_cols=["n"])


def test_sum_by_key_all_null_group(spark):
    from qalens.operators import sum_by_key

    df = spark.createDataFrame([("a", 1), ("a", None), ("b", None)], "k string, v long")
    assert sorted(map(tuple, sum_by_key(df, "k", "v").collect())) == [("a", 1), ("b", None)]
    filled = sorted(map(tuple, sum_by_key(df, "k", "v", fill_empty=0).collect()))
    assert filled == [("a", 1), ("b", 0)]  # the na.rm / pandas behaviour, on request
