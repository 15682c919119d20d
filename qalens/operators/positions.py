"""Global row positions, and comparison of tables in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from qalens.operators.compare import schema_diff
from qalens.sources.sinks import stored

Order = Sequence[str | Column]


def _columns(df: DataFrame) -> list[Column]:
    return [F.col("`{}`".format(c.replace("`", "``"))) for c in df.columns]


def row_positions(df: DataFrame, order_by: Order, *, name: str = "position", start: int = 1) -> DataFrame:
    """Every row with its place in the order of ``order_by`` (names, or expressions with
    ``asc()``/``desc()``), counted from ``start`` without gaps. Rows that tie keep the order of
    the input, as a stable sort would.

    No task sees all rows: they are dealt into ranges of the order, sorted there and written
    once; the ranges' row counts (one number each) give every range its offset. Ties go into
    as many ranges as they need, because the place in the input is part of the order.
    """
    if name in df.columns:
        raise ValueError(f"there is a column {name} already")
    keys = [F.col(c) if isinstance(c, str) else c for c in order_by]
    tied = df.withColumn("__input", F.monotonically_increasing_id())
    order = [*keys, F.col("__input")]
    # the id's upper bits number the range, the lower 33 the row within it
    ranges = tied.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__place", F.monotonically_increasing_id())
    kept = stored(ranges.drop("__input"), "positions")
    part = F.shiftright("__place", 33)
    counts = kept.groupBy(part.alias("__part")).agg(F.count("*").alias("__rows"))
    before = F.expr("sum(__rows) OVER (ORDER BY __part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    offsets = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    within = F.col("__place") - F.shiftleft(part, 33)
    # one row a range: at most the number of shuffle partitions
    placed = kept.join(F.broadcast(offsets), part == F.col("__part"))
    return placed.select(*_columns(df), (F.col("__before") + within + start).alias(name))


def _exact(df: DataFrame, name: str) -> Column:
    """The value as comparisons see it: -0.0 is 0.0."""
    c = F.col("`{}`".format(name.replace("`", "``")))
    return c + F.lit(0.0).cast(df.schema[name].dataType) if isinstance(df.schema[name].dataType, (DoubleType, FloatType)) else c


def _digests(df: DataFrame) -> list[Column]:
    """128 bits of a row; NULLs count as values of their own."""
    values = [_exact(df, c) for c in df.columns]
    nulls = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values]) if values else F.lit("")
    return [F.xxhash64(F.lit(seed), nulls, *values).alias(f"__d{seed}") for seed in (1, 2)]


def table_equals_ordered(
    left: DataFrame, right: DataFrame, left_order: Order, right_order: Order | None = None, *, columns: Sequence[str] | None = None
) -> DataFrame:
    """One row: ``equal``, ``n_left``, ``n_right``, ``first_difference`` (the first position,
    from 1, at which the tables differ or one has ended) and ``differing`` (the columns that
    differ there, comma-joined; for tables of different columns, what differs in their schemas).

    Strict: names, their order and types must agree, NULL equals NULL only, NaN equals NaN.
    The rows are put in order by ``left_order`` and ``right_order`` (the same if not given) and
    compared on ``columns`` (all if not given).

    Positions and 128-bit digests are matched, not rows; values are looked at for the two rows
    at the first difference alone.
    """
    right_order = left_order if right_order is None else right_order
    shown = {side: df.select(*[F.col(f"`{c}`") for c in columns or df.columns]) for side, df in (("left", left), ("right", right))}
    problems = schema_diff(shown["left"].schema, shown["right"].schema)
    if not problems and shown["left"].columns != shown["right"].columns:
        problems = ["order of columns"]
    if problems:
        sides = [df.select(F.lit(int(side == "left")).alias("l"), F.lit(int(side == "right")).alias("r")) for side, df in shown.items()]
        count = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)
        return sides[0].union(sides[1]).agg(count("l", "n_left"), count("r", "n_right")).select(
            F.lit(False).alias("equal"), "n_left", "n_right", F.lit(None).cast("bigint").alias("first_difference"),
            F.lit("; ".join(problems)).alias("differing"),
        )
    names = shown["left"].columns
    placed = {}
    for side, df, order in (("left", left, left_order), ("right", right, right_order)):
        at = row_positions(df, order, name="__position")
        placed[side] = at.select("__position", *[F.col(f"`{c}`") for c in names])
    marks = {side: df.select("__position", *_digests(df.drop("__position"))) for side, df in placed.items()}
    matched = marks["left"].join(
        marks["right"].select("__position", F.col("__d1").alias("__r1"), F.col("__d2").alias("__r2")), "__position", "full_outer"
    )
    same = F.coalesce((F.col("__d1") == F.col("__r1")) & (F.col("__d2") == F.col("__r2")), F.lit(False))
    found = matched.agg(
        F.count("__d1").alias("n_left"), F.count("__r1").alias("n_right"),
        F.min(F.when(~same, F.col("__position"))).alias("first_difference"),
    )
    first = found.select("first_difference").alias("f")
    rows = {
        side: df.join(F.broadcast(first), df["__position"] == F.col("first_difference"), "left_semi").select(
            F.struct(*[_exact(df, c).alias(c) for c in names]).alias(side)
        )
        for side, df in placed.items()
    }
    # at most one row on each side
    none = {side: F.lit(None).cast(df.schema[side].dataType).alias(side) for side, df in rows.items()}
    both = rows["left"].select("left", none["right"]).union(rows["right"].select(none["left"], "right"))
    pair = both.agg(F.first("left", ignorenulls=True).alias("left"), F.first("right", ignorenulls=True).alias("right"))
    differ = [F.when(~F.col(f"left.`{c}`").eqNullSafe(F.col(f"right.`{c}`")), F.lit(c)) for c in names]
    ended = F.col("left").isNull() | F.col("right").isNull()
    what = pair.select(F.when(ended, "(rows)").otherwise(F.array_join(F.array(*differ), ",")).alias("differing"))
    long = F.lit(None).cast("bigint")
    parts = found.select("n_left", "n_right", "first_difference", F.lit(None).cast("string").alias("differing")).union(
        what.select(long, long, long, "differing")
    )
    return parts.agg(*[F.max(c).alias(c) for c in parts.columns]).select(
        F.col("first_difference").isNull().alias("equal"), "n_left", "n_right", "first_difference",
        F.when(F.col("first_difference").isNotNull(), F.col("differing")).alias("differing"),
    )
