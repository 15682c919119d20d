"""Operators against plain-Python brute force on random small tables (NULLs included)."""

from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from qalens.operators import (
    count_by_key,
    full_outer_merge,
    join_row_count,
    period_counts,
    sum_by_key,
    table_diff,
    top_by_rollup,
)

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
keys = st.one_of(st.none(), st.integers(0, 4))
vals = st.one_of(st.none(), st.integers(-5, 5))


@SETTINGS
@given(rows=st.lists(st.tuples(keys, vals), max_size=30))
def test_count_and_sum_by_key(spark, rows):
    df = spark.createDataFrame(rows, "k long, v long")
    got_c = {r.k: (r.n, r.nn) for r in count_by_key(df, "k", nonnull_name="nn").collect()}
    exp_c = {}
    for k, _ in rows:
        n, nn = exp_c.get(k, (0, 0))
        exp_c[k] = (n + 1, nn + (k is not None))
    assert got_c == exp_c
    got_s = {r.k: r.total for r in sum_by_key(df, "k", "v").collect()}
    exp_s = {}
    for k, v in rows:
        if v is not None:
            exp_s[k] = (exp_s.get(k) or 0) + v
        else:
            exp_s.setdefault(k, None)
    assert got_s == exp_s


@SETTINGS
@given(a=st.lists(st.tuples(keys, keys), max_size=20), b=st.lists(st.tuples(keys, keys), max_size=20))
def test_table_diff_is_multiset_difference(spark, a, b):
    da = spark.createDataFrame(a, "x long, y long")
    db = spark.createDataFrame(b, "x long, y long")
    got = {(r.x, r.y): (r.n_left, r.n_right) for r in table_diff(da, db).collect()}
    ca, cb = Counter(a), Counter(b)
    exp = {k: (ca[k], cb[k]) for k in set(ca) | set(cb) if ca[k] != cb[k]}
    assert got == exp


@SETTINGS
@given(a=st.lists(keys, max_size=20), b=st.lists(keys, max_size=20))
def test_join_row_count(spark, a, b):
    da = spark.createDataFrame([(x,) for x in a], "k long")
    db = spark.createDataFrame([(x,) for x in b], "k long")
    plain = sum(1 for x in a for y in b if x is not None and x == y)
    safe = sum(1 for x in a for y in b if x == y)
    assert join_row_count(da, db, "k", "k").collect()[0].n == plain
    assert join_row_count(da, db, "k", "k", null_safe=True).collect()[0].n == safe


@SETTINGS
@given(rows=st.lists(st.tuples(keys, st.sampled_from(["x", "y", "z", None])), max_size=30))
def test_period_counts_and_full_outer_merge(spark, rows):
    df = spark.createDataFrame(rows, "k long, lab string")
    label = F.coalesce(F.col("lab"), F.lit("x"))
    got = {r.k: (r.cx, r.cy, r.t) for r in period_counts(
        df, "k", label, {"x": "cx", "y": "cy"}, entity_name="k", total_name="t").collect()}
    exp = defaultdict(lambda: [0, 0, 0])
    for k, lab in rows:
        lab = lab or "x"
        exp[k][0] += lab == "x"
        exp[k][1] += lab == "y"
        exp[k][2] += 1
    assert got == {k: tuple(v) for k, v in exp.items()}
    left = count_by_key(df.filter(label == "x"), "k", count_name="a")
    right = count_by_key(df.filter(label == "y"), "k", count_name="b")
    merged = {(r.k, r.a, r.b, r.t) for r in full_outer_merge(left, right, "k", total_name="t").collect()}
    # NULL keys never match across sides (SQL '='), so they may appear once per side
    exp_m = set()
    for k, v in exp.items():
        if k is None:
            if v[0]:
                exp_m.add((None, v[0], 0, v[0]))
            if v[1]:
                exp_m.add((None, 0, v[1], v[1]))
        elif v[0] or v[1]:
            exp_m.add((k, v[0], v[1], v[0] + v[1]))
    assert merged == exp_m


@SETTINGS
@given(
    facts=st.lists(st.tuples(keys, vals, st.booleans()), max_size=30),
    k=st.integers(1, 4),
)
def test_top_by_rollup_cut(spark, facts, k):
    dim = spark.createDataFrame([(i, f"n{i}") for i in range(0, 4)], "id long, name string")
    fact = spark.createDataFrame(facts, "owner long, v long, keep boolean")
    got = [tuple(r) for r in top_by_rollup(
        dim, fact, dim_key="id", fact_key="owner", measure="v", dim_cols=["name"],
        fact_filter=F.col("keep"), measure_name="total", k=k).collect()]
    sums = {}
    for o, v, keep in facts:
        if not keep or o is None or o > 3:
            continue
        if v is None:
            sums.setdefault(o, None)
        else:
            sums[o] = (sums.get(o) or 0) + v
    order = sorted(sums.items(), key=lambda kv: (kv[1] is None, -(kv[1] or 0), kv[0]))[:k]
    assert got == [(o, f"n{o}", s) for o, s in order]


@SETTINGS
@given(
    rows=st.lists(
        st.tuples(st.one_of(st.none(), st.sampled_from(["2019-05-01", "2020-01-02", "2021-12-31"])),
                  st.one_of(st.none(), st.sampled_from(["a", "b", "c"]))),
        max_size=30,
    ),
    ties=st.sampled_from(["first", "all"]),
    method=st.sampled_from(["aggregate", "window"]),
)
def test_top_category_and_share(spark, rows, ties, method):
    from qalens.operators import share_of_period, top_category_per_period

    df = spark.createDataFrame(rows, "d string, c string").select(
        F.to_date("d").cast("timestamp_ntz").alias("ts"), "c"
    )
    counts = defaultdict(Counter)
    for d, c in rows:
        if d is not None:
            counts[d[:4]][c] += 1
    exp_share = {(y, c): n / sum(cnt.values()) for y, cnt in counts.items() for c, n in cnt.items()}
    got_share = {(r.Year, r.Name): r.Share for r in share_of_period(df, "ts", "c", method=method).collect()}
    assert got_share.keys() == exp_share.keys()
    assert all(abs(got_share[k] - v) < 1e-12 for k, v in exp_share.items())
    exp_top = set()
    for y, cnt in counts.items():
        best = max(cnt.values())
        names = sorted((c for c, n in cnt.items() if n == best), key=lambda c: (c is not None, c))
        for c in (names[:1] if ties == "first" else names):
            exp_top.add((y, c, best / sum(cnt.values())))
    got_top = {tuple(r) for r in top_category_per_period(df, "ts", "c", ties=ties, method=method).collect()}
    assert got_top == exp_top
