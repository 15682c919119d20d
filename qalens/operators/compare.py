"""Appending tables and comparing them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType, StructType


def union_tagged(frames: Mapping[str, DataFrame], tag_name: str = "source") -> DataFrame:
    """Append tables by column name (``UNION ALL``), each row tagged with its table's key."""
    if not frames:
        raise ValueError("no tables to append")
    out = None
    for tag, df in frames.items():
        tagged = df.select(F.lit(tag).alias(tag_name), *df.columns)
        out = tagged if out is None else out.unionByName(tagged)
    return out


def schema_diff(a: StructType, b: StructType) -> list[str]:
    """Human-readable differences between two schemas (names, then types); order
    of columns is ignored. Driver-side, reads only the schemas."""
    ta = {f.name: f.dataType for f in a.fields}
    tb = {f.name: f.dataType for f in b.fields}
    out = [f"only in left: {n}" for n in ta if n not in tb]
    out += [f"only in right: {n}" for n in tb if n not in ta]
    out += [
        f"type of {n}: {ta[n].simpleString()} vs {tb[n].simpleString()}"
        for n in ta
        if n in tb and ta[n] != tb[n]
    ]
    return out


def _comparable(df: DataFrame, name: str, own: DataType, other: DataType, common: DataType | None) -> list[Column]:
    """A column as ``(value, text)``: the value at the type both sides can hold without loss,
    or the text of a value that cannot be converted to it (then ``value`` is NULL)."""
    none = F.lit(None).cast("string")
    if own == other:
        return [F.col(name), none]
    if isinstance(own, StringType):  # the other side's type decides; other text stays text
        value = F.col(name).try_cast(other)
        return [value, F.when(value.isNull(), F.col(name))]
    if isinstance(other, StringType):
        return [F.col(name), none]
    if common is None:  # no common type: equal only as text
        return [F.col(name).cast("string"), none]
    return [F.col(name).cast(common), none]


def _common_type(left: DataFrame, right: DataFrame, name: str) -> DataType | None:
    """The type an append of both columns would have: the wider one."""
    try:
        return left.select(name).union(right.select(name)).schema[name].dataType
    except AnalysisException:
        return None


def _sides(
    left: DataFrame, right: DataFrame, columns: Sequence[str] | None, lenient_types: bool
) -> tuple[list[str], list[str], DataFrame, DataFrame]:
    """The compared columns, their companions for text without a value, and both tables in that
    common form, marked with ``__l`` and ``__r``."""
    if columns is None and set(left.columns) != set(right.columns):
        raise ValueError(f"columns differ: {schema_diff(left.schema, right.schema)}")
    cols = list(columns) if columns is not None else list(left.columns)
    missing = [c for c in cols if c not in right.columns or c not in left.columns]
    if missing:
        raise ValueError(f"columns missing on one side: {missing}")
    sides = []
    for df, other, marks in ((left, right, (1, 0)), (right, left, (0, 1))):
        parts = []
        for c in cols:
            own, its = df.schema[c].dataType, other.schema[c].dataType
            if own != its and not lenient_types:
                raise ValueError(f"type of {c}: {own.simpleString()} vs {its.simpleString()}")
            common = None if own == its else _common_type(left, right, c)
            value, text = _comparable(df, c, own, its, common)
            parts += [value.alias(c), text.alias(f"__text_{c}")]
        sides.append(df.select(*parts, F.lit(marks[0]).alias("__l"), F.lit(marks[1]).alias("__r")))
    return cols, [f"__text_{c}" for c in cols], sides[0], sides[1]


#: Buckets of the hash tree's first level, and of each opened bucket.
TREE_BUCKETS, TREE_FAN = 4096, 64


def _signed_sums(sides: tuple[DataFrame, DataFrame], buckets: list[Column]) -> DataFrame:
    """Per bucket, what is left of the rows' 128-bit digests when the right table's are taken
    from the left's (as four sums of 32 bits, in any order) and the same of the row counts;
    only buckets where something is left."""
    both = sides[0].unionByName(sides[1]).withColumn("__sign", (F.col("__l") - F.col("__r")).cast("bigint"))
    parts = [F.col("__h1").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("__h1", 32), F.col("__h2").bitwiseAND(0xFFFFFFFF), F.shiftrightunsigned("__h2", 32)]
    sums = [F.sum(F.col("__sign") * p).alias(f"__s{i}") for i, p in enumerate(parts)]
    left_over = both.groupBy(*buckets).agg(F.sum("__sign").alias("__n"), *sums)
    return left_over.where("__n <> 0 OR __s0 <> 0 OR __s1 <> 0 OR __s2 <> 0 OR __s3 <> 0")


def table_diff_by_tree(
    left: DataFrame,
    right: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    lenient_types: bool = True,
    left_name: str = "n_left",
    right_name: str = "n_right",
    buckets: int = TREE_BUCKETS,
    fan: int = TREE_FAN,
) -> DataFrame:
    """The result of :func:`table_diff` without moving rows that are equal on both sides.

    Rows fall into buckets by a digest; a bucket's sum of digests does not depend on the order
    of its rows. Equal tables differ in no bucket: then only sums were shuffled (``buckets`` rows
    a task at most) and the result is known to be empty. Otherwise the differing buckets are
    divided ``fan`` times finer, and only the rows of the parts that differ are grouped whole.
    The two levels run at once (a scan of both tables each); rows count as equal in a bucket if
    the sums of their 128-bit digests are.
    """
    cols, texts, *sides = _sides(left, right, columns, lenient_types)
    values = [
        F.col(f"`{c}`") + F.lit(0.0).cast(sides[0].schema[c].dataType) if isinstance(sides[0].schema[c].dataType, (DoubleType, FloatType)) else F.col(f"`{c}`")
        for c in [*cols, *texts]
    ]
    nulls = F.concat(*[F.when(v.isNull(), "1").otherwise("0") for v in values])
    hashed = [
        side.withColumn("__h1", F.xxhash64(F.lit(1), nulls, *values)).withColumn("__h2", F.xxhash64(F.lit(2), nulls, *values))
        for side in sides
    ]
    coarse = F.pmod("__h1", F.lit(buckets))
    fine = F.pmod(F.shiftrightunsigned("__h2", 32), F.lit(fan))
    slim = [h.select("__l", "__r", "__h1", "__h2", coarse.alias("__bucket"), fine.alias("__part")) for h in hashed]
    opened = [r[0] for r in _signed_sums(slim, [F.col("__bucket")]).select("__bucket").collect()]
    grouped = hashed[0].unionByName(hashed[1])
    if len(opened) < buckets:
        grouped = grouped.where(coarse.isin(opened)) if opened else grouped.where(F.lit(False))
    if opened and len(opened) * 2 < buckets:  # few differ: look closer before moving their rows
        inside = [s.where(F.col("__bucket").isin(opened)) for s in slim]
        parts = _signed_sums(inside, [F.col("__bucket"), F.col("__part")]).select("__bucket", "__part")
        # at most len(opened) * fan rows of two numbers
        grouped = grouped.join(F.broadcast(parts), (coarse == F.col("__bucket")) & (fine == F.col("__part")), "left_semi")
    counted = grouped.groupBy(*[F.col(f"`{c}`") for c in [*cols, *texts]]).agg(F.sum("__l").alias(left_name), F.sum("__r").alias(right_name))
    return counted.filter(F.col(left_name) != F.col(right_name)).drop(*texts)


def table_diff(
    left: DataFrame,
    right: DataFrame,
    columns: Sequence[str] | None = None,
    *,
    keys: Sequence[str] | None = None,
    lenient_types: bool = True,
    left_name: str = "n_left",
    right_name: str = "n_right",
) -> DataFrame:
    """Order-insensitive comparison: each distinct row whose number of copies
    differs between the tables, with both counts. Empty result = equal as
    multisets (``EXCEPT ALL`` both ways is empty).

    Rows are compared on ``columns``; without it the tables must have the same columns, in
    any order (ValueError otherwise). With ``lenient_types`` columns of different types are
    compared at the wider one (1 equals 1.0, not 1.5), text with another type by its value
    (text that has none differs from everything of that type, and shows as NULL in the
    result); without it types must agree. NULLs compare equal, as in ``EXCEPT``.

    ``keys``: one row per key that differs instead, with the rows of either side that have no
    twin on the other (``n_left``, ``n_right``) and ``columns``, the names of the compared
    columns whose values differ between those rows.

    One shuffle with partial aggregation: a row repeated a billion times travels as one count
    per task. Keys are gathered from the differing rows only.
    """
    cols, texts, *sides = _sides(left, right, columns, lenient_types)
    unknown = [k for k in keys or () if k not in cols]
    if unknown:
        raise ValueError(f"keys are not among the compared columns: {unknown}")
    counted = (
        sides[0].unionByName(sides[1]).groupBy(*cols, *texts)
        .agg(F.sum("__l").alias(left_name), F.sum("__r").alias(right_name))
        .filter(F.col(left_name) != F.col(right_name))
    )
    if keys is None:
        return counted.drop(*texts)
    rest = [c for c in cols if c not in keys]
    values = {c: F.struct(c, f"__text_{c}") for c in rest}
    differs = [F.when(F.min(v) != F.max(v), F.lit(c)) for c, v in values.items()]
    extra = F.array_compact(F.array(*differs)) if differs else F.array().cast("array<string>")
    more_left = F.greatest(F.col(left_name) - F.col(right_name), F.lit(0))
    more_right = F.greatest(F.col(right_name) - F.col(left_name), F.lit(0))
    return counted.groupBy(*keys).agg(
        F.sum(more_left).alias(left_name), F.sum(more_right).alias(right_name), extra.alias("columns")
    )


def diff_counts(left: DataFrame, right: DataFrame, columns: Sequence[str] | None = None, *, lenient_types: bool = True) -> DataFrame:
    """One row: ``rows_left``, ``rows_right`` and ``rows_differing``, the copies that
    :func:`table_diff` would report without a twin. Each table is evaluated once."""
    cols, texts, *sides = _sides(left, right, columns, lenient_types)
    grouped = sides[0].unionByName(sides[1]).groupBy(*[F.col(f"`{c}`") for c in [*cols, *texts]])
    copies = grouped.agg(F.sum("__l").alias("__l"), F.sum("__r").alias("__r"))
    total = lambda c, name: F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name)
    return copies.agg(total("__l", "rows_left"), total("__r", "rows_right"), total(F.abs(F.col("__l") - F.col("__r")), "rows_differing"))


def rows_only_in(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows of ``left`` not matched one-for-one in ``right`` (``EXCEPT ALL``)."""
    return left.exceptAll(right.select(*left.columns))
