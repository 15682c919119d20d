"""Positions, comparison in order, the hash tree, pruned ranking, top n per group."""

import random

import pytest
from pyspark.sql import functions as F

from qalens.operators import (
    prune_for_top_k,
    reduce_by_keys,
    row_positions,
    table_diff,
    table_diff_by_tree,
    table_equals_ordered,
    top_by_rollup,
    top_n_per_group,
)
from qalens.operators import compare, joins
from qalens.plans.inspect import plan_text


def test_positions_count_rows_in_order(spark):
    rng = random.Random(2)
    rows = [(rng.choice([None, 1, 2, 3, 3, 3, 9]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(6, "b")
    got = [(r.a, r.b, r.position) for r in row_positions(df, [F.col("a").desc(), "b"]).collect()]
    want = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    assert sorted((p, a, b) for a, b, p in got) == [(i + 1, *r) for i, r in enumerate(want)]


def test_positions_of_ties_are_gapless_and_in_input_order(spark):
    df = spark.range(5000).select(F.lit(1).alias("k"), "id").coalesce(1)
    placed = row_positions(df, ["k"], name="at", start=0)
    assert [r.id for r in placed.orderBy("at").collect()] == list(range(5000))
    assert row_positions(df.limit(0), ["k"]).count() == 0
    with pytest.raises(ValueError):
        row_positions(df, ["k"], name="id")


def test_no_task_numbers_all_rows(spark):
    placed = row_positions(spark.range(1000), ["id"])
    rows_part = plan_text(placed).split("Window")
    assert plan_text(placed).count("SinglePartition") == 1  # the ranges' counts, one row each
    assert len(rows_part) > 1


def _ordered(spark, left, right, schema="id int, v double, t string", right_schema=None):
    a = spark.createDataFrame(left, schema).repartition(3)
    b = spark.createDataFrame(right, right_schema or schema).repartition(4)
    return table_equals_ordered(a, b, ["id"], columns=["v", "t"]).first()


def test_ordered_comparison(spark):
    rows = [(i, i / 2, f"t{i}") for i in range(50)] + [(50, None, None), (51, float("nan"), ""), (52, -0.0, "z")]
    same = [(i, 0.0 if i == 52 else v, t) for i, v, t in rows]
    assert tuple(_ordered(spark, rows, same)) == (True, 53, 53, None, None)
    swapped = [(7, *rows[8][1:]) if r[0] == 7 else (8, *rows[7][1:]) if r[0] == 8 else r for r in rows]
    assert tuple(_ordered(spark, rows, swapped)) == (False, 53, 53, 8, "v,t")
    assert tuple(_ordered(spark, rows, rows[:-2])) == (False, 53, 51, 52, "(rows)")
    assert tuple(_ordered(spark, [], [])) == (True, 0, 0, None, None)
    assert tuple(_ordered(spark, [], rows)) == (False, 0, 53, 1, "(rows)")
    nulls = [(i, v, None if i == 51 else t) for i, v, t in rows]
    assert tuple(_ordered(spark, rows, nulls)) == (False, 53, 53, 52, "t")
    retyped = _ordered(spark, rows, [(i, 1.0 if v is None else v, t) for i, v, t in rows], right_schema="id int, v float, t string")
    assert (retyped.equal, retyped.first_difference) == (False, None) and "type of v" in retyped.differing


def test_nulls_do_not_hide_a_shift_between_columns(spark):
    a = spark.createDataFrame([(1, None, "x")], "id int, p string, q string")
    b = spark.createDataFrame([(1, "x", None)], "id int, p string, q string")
    assert table_equals_ordered(a, b, ["id"]).first().differing == "p,q"
    assert table_diff_by_tree(a, b).count() == 2


@pytest.mark.parametrize("seed", range(4))
def test_hash_tree_equals_table_diff(spark, seed):
    rng = random.Random(seed)

    def table(n):
        return [(rng.choice([None, rng.randrange(n)]), rng.choice(["a", "b", None]), rng.choice([0.0, -0.0, 1.5, None])) for _ in range(n)]

    base = table(400)
    other = [r for r in base if rng.random() > 0.02] + table(3) + base[:2] if seed else list(reversed(base))
    a, b = (spark.createDataFrame(x, "k int, s string, d double") for x in (base, other))
    b = b.select("d", "k", "s")
    for buckets in (4096, 8, 1):
        tree = table_diff_by_tree(a, b, buckets=buckets)
        assert sorted(map(repr, tree.collect())) == sorted(map(repr, table_diff(a, b).collect()))
    if not seed:
        assert table_diff_by_tree(a, b).count() == 0


def test_hash_tree_compares_at_the_common_type(spark):
    a = spark.createDataFrame([(1, "7"), (2, "x")], "id int, v string")
    b = spark.createDataFrame([(1, 7), (2, 8)], "id long, v int")
    assert table_diff_by_tree(a, b).count() == table_diff(a, b).count() == 2
    with pytest.raises(ValueError):
        table_diff_by_tree(a, b, lenient_types=False)


def test_equal_tables_move_no_rows(spark, monkeypatch):
    seen = []
    real = compare._signed_sums
    monkeypatch.setattr(compare, "_signed_sums", lambda *a: seen.append(1) or real(*a))
    df = spark.range(20000).select("id", F.md5(F.col("id").cast("string")).alias("t"))
    assert table_diff_by_tree(df, df.repartition(3)).count() == 0
    assert len(seen) == 1  # the first level said so


@pytest.mark.parametrize("kind", ["skewed", "tied", "negative", "nulls", "few", "double"])
def test_pruned_top_k_equals_plain(spark, kind):
    rng = random.Random(kind)
    measure = {
        "skewed": lambda: rng.randrange(1, 50), "tied": lambda: rng.choice([0, 5]), "negative": lambda: rng.randrange(-20, 50),
        "nulls": lambda: rng.choice([None, None, 3]), "few": lambda: 2, "double": lambda: rng.random(),
    }[kind]
    keys = 4 if kind == "few" else 3000
    rows = [(None if rng.random() < 0.01 else int(keys * rng.random() ** 3), measure()) for _ in range(20000)]
    fact = spark.createDataFrame(rows, "k int, m " + ("double" if kind == "double" else "long"))
    dim = spark.range(5, keys).select("id", F.concat(F.lit("n"), "id").alias("name"))
    for ties in ("cut", "keep"):
        plain, pruned = (
            top_by_rollup(dim, fact, dim_key="id", fact_key="k", measure="m", dim_cols=["name"], k=7, ties=ties, prune=p).collect()
            for p in (False, True)
        )
        assert plain == pruned and (kind == "few" or len(plain) >= 7)
    out = prune_for_top_k(fact, "k", "m", 7)
    assert out.pruned == (kind in ("skewed", "tied", "nulls")), out.reason
    if kind == "skewed":
        assert out.rows.select("k").distinct().count() < 100


def test_pruning_of_an_empty_table(spark):
    out = prune_for_top_k(spark.createDataFrame([], "k int, m long"), "k", "m", 3)
    assert not out.pruned and out.rows.count() == 0


def test_reduce_by_keys(spark):
    rows = spark.createDataFrame([(i % 300 - 150 if i % 10 else None, i) for i in range(3000)], "k int, v int")
    known = spark.createDataFrame([(k,) for k in [*range(-150, 150, 7), None, -150, 10**12]], "id long")
    want = sorted(map(tuple, rows.where((F.col("k") + 150) % 7 == 0).collect()))
    for limit in (joins.MAX_BITMAP_BYTES, 0):
        got = reduce_by_keys(rows, "k", known, "id", max_bytes=limit)
        assert sorted(map(tuple, got.collect())) == want and got.columns == ["k", "v"]
    assert "BroadcastExchange" in plan_text(reduce_by_keys(rows, "k", known, "id"))


@pytest.mark.parametrize("ascending", [False, True])
@pytest.mark.parametrize("n", [1, 3, 40])
def test_top_n_per_group_is_rank(spark, n, ascending):
    rng = random.Random(n)
    rows = [("hot" if rng.random() < 0.6 else rng.choice(["a", "b", None, "c"]), rng.choice([None, *range(12)]), i) for i in range(900)]
    df = spark.createDataFrame(rows + [("single", None, 1)], "g string, m int, i int")
    got = sorted(map(repr, map(tuple, top_n_per_group(df, "g", "m", n, ascending=ascending).collect())))
    df.createOrReplaceTempView("ranked_rows")
    order = "m ASC NULLS LAST" if ascending else "m DESC NULLS LAST"
    want = spark.sql(f"SELECT g, m, i FROM (SELECT *, rank() OVER (PARTITION BY g ORDER BY {order}) r FROM ranked_rows) WHERE r <= {n}")
    assert got == sorted(map(repr, map(tuple, want.collect())))
    assert "WindowGroupLimit" in plan_text(top_n_per_group(df, "g", "m", n))
