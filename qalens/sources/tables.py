"""Loading the site's five tables from gzip CSV or Parquet."""

from __future__ import annotations

import os
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType, TimestampNTZType

from qalens.functions.dates import parse_timestamp
from qalens.schemas import TABLES
from qalens.sources.csv import read_csv
from qalens.sources.sinks import write_parquet

FORMATS = ("csv.gz", "csv", "parquet")


def text_schema(table: str) -> StructType:
    """Load-time schema: time columns as text (parsed afterwards), the rest typed."""
    return StructType(
        [
            StructField(name, StringType() if isinstance(t, TimestampNTZType) else t, True)
            for name, t in TABLES[table].items()
        ]
    )


def all_text_schema(table: str) -> StructType:
    """Every known column as text: what CSV files are read with, so that values convert by the
    rules of :func:`apply_schema` whatever the source."""
    return StructType([StructField(name, StringType(), True) for name in TABLES[table]])


def apply_schema(df: DataFrame, table: str, extra: tuple[str, ...] = ()) -> DataFrame:
    """Keep the known columns (and ``extra`` ones), by name, with their declared types; time text
    that matches no accepted layout, and any value that does not convert
    (e.g. 'NA' in a number column), becomes NULL, as in the CSV reader."""
    cols = []
    for name, t in TABLES[table].items():
        if name not in df.columns:
            raise ValueError(f"{table}: column {name} not found in {df.columns}")
        src = F.col(name)
        current = df.schema[name].dataType
        if isinstance(t, TimestampNTZType) and isinstance(current, StringType):
            cols.append(parse_timestamp(src).alias(name))
        elif current != t:
            cols.append(src.try_cast(t).alias(name))
        else:
            cols.append(src)
    return df.select(*cols, *extra)


def table_path(directory: str, table: str, fmt: str) -> str:
    return os.path.join(directory, f"{table}.{fmt}")


def load_table(
    spark: SparkSession,
    directory: str,
    table: str,
    fmt: str = "csv.gz",
    *,
    csv_options: dict[str, str] | None = None,
    path: str | None = None,
    split: bool | int | None = None,
) -> DataFrame:
    """One site table with its declared column types, from
    ``directory/<Table>.<fmt>`` or from ``path`` when given (a file, folder or glob).

    ``split`` (by default for uncompressed ``csv`` in the standard dialect): files longer than
    a range are read by ranges, also inside quoted line breaks (see :func:`read_csv`).

    ``csv_options`` adjust the CSV dialect, e.g. ``{"nullValue": "NA"}`` for
    files written by R's ``write.csv`` (missing values as ``NA``, empty text as
    ``""``); extra columns such as R's unnamed row-name column are ignored.
    """
    if fmt not in FORMATS:
        raise ValueError(f"fmt must be one of {FORMATS}")
    path = path or table_path(directory, table, fmt)
    if fmt == "parquet":
        raw = spark.read.parquet(path)
    else:
        raw = _read_text(spark, path, table, fmt, csv_options, split)
    return apply_schema(raw, table)


def _read_text(spark, path: str, table: str, fmt: str, csv_options: dict[str, str] | None, split: bool | int | None) -> DataFrame:
    if split is None:
        split = fmt == "csv" and not {"sep", "delimiter", "quote", "escape", "encoding", "header"} & set(csv_options or {})
    return read_csv(spark, path, all_text_schema(table), by_header=True, split=split, options=csv_options)


def load_tables(
    spark: SparkSession,
    directory: str,
    fmt: str = "csv.gz",
    tables: Iterable[str] = tuple(TABLES),
    *,
    csv_options: dict[str, str] | None = None,
    paths: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """The named tables (default all five), lazily; nothing is read until a query
    runs. ``paths`` maps a table to its own location when files are named
    differently (e.g. ``{"Posts": "/data/posts-*.csv.gz"}``)."""
    paths = paths or {}
    return {
        t: load_table(spark, directory, t, fmt, csv_options=csv_options, path=paths.get(t))
        for t in tables
    }


def rejected_values(
    spark: SparkSession,
    directory: str,
    fmt: str = "csv.gz",
    tables: Iterable[str] = tuple(TABLES),
    *,
    csv_options: dict[str, str] | None = None,
    paths: dict[str, str] | None = None,
) -> DataFrame:
    """What loading turned into NULL: ``table``, ``column``, ``rows`` for every typed column
    with values that do not convert (bad dates, text in number columns), and the column
    ``(record)`` for rows that are not well-formed records. One scan and one row of partial
    counts per task for each table."""
    out = None
    for t in tables:
        path = (paths or {}).get(t) or table_path(directory, t, fmt)
        if fmt == "parquet":
            raw, torn = spark.read.parquet(path), F.lit(False)
        else:
            options = {**(csv_options or {}), "columnNameOfCorruptRecord": "__record"}
            raw = read_csv(spark, path, all_text_schema(t), by_header=True, options=options)
            torn = F.col("__record").isNotNull()
        checks = {"(record)": torn}
        checks.update(_reject_checks(raw, t))
        counted = raw.agg(*[F.count_if(c).alias(n) for n, c in checks.items()])
        rows = F.explode(F.array(*[F.struct(F.lit(n).alias("column"), F.col(f"`{n}`").alias("rows")) for n in checks])).alias("r")
        one = counted.select(F.lit(t).alias("table"), rows).select("table", "r.column", "r.rows").where("rows > 0")
        out = one if out is None else out.unionByName(one)
    return out


def _reject_checks(raw: DataFrame, table: str) -> dict[str, Column]:
    """For every typed column that arrives as text, whether a row's value does not convert."""
    checks = {}
    for name, kind in TABLES[table].items():
        if isinstance(raw.schema[name].dataType, StringType) and not isinstance(kind, StringType):
            value = parse_timestamp(name) if isinstance(kind, TimestampNTZType) else F.col(name).try_cast(kind)
            checks[name] = F.col(name).isNotNull() & value.isNull()
    return checks


#: The column of converted tables that holds what a row lost; analyses do not read it.
REJECTS = "_rejects"
_REJECT_TYPE = "struct<record string, items array<struct<column string, value string>>>"

#: What a converted table is clustered by: the columns its analyses filter on.
CLUSTER_BY = {"Posts": ("PostTypeId", "CreationDate"), "Votes": ("VoteTypeId", "CreationDate"), "Badges": ("Date",)}


def _with_rejects(raw: DataFrame, table: str) -> DataFrame:
    """The typed table and, for rows that lost a value, the record as text and what was lost."""
    checks = _reject_checks(raw, table)
    torn = F.col("__record").isNotNull()
    item = lambda column, value: F.struct(F.lit(column).alias("column"), value.alias("value"))
    items = F.array(
        F.when(torn, item("(record)", F.col("__record"))),
        *[F.when(bad & ~torn, item(name, F.col(name))) for name, bad in checks.items()],
    )
    known = F.to_csv(F.struct(*[F.col(c) for c in TABLES[table]]))
    lost = torn
    for bad in checks.values():
        lost = lost | bad
    rejects = F.when(lost, F.struct(known.alias("record"), F.array_compact(items).alias("items")))
    typed = apply_schema(raw.withColumn("__rejects", rejects), table, extra=("__rejects",))
    return typed.withColumnRenamed("__rejects", REJECTS)


def convert_to_parquet(
    spark: SparkSession,
    src_dir: str,
    dst_dir: str,
    *,
    fmt: str = "csv.gz",
    tables: Iterable[str] = tuple(TABLES),
    files_per_table: int | None = None,
    csv_options: dict[str, str] | None = None,
    paths: dict[str, str] | None = None,
    split: bool | int | None = None,
    cluster: bool = True,
    rejects: bool = False,
) -> dict[str, str]:
    """Convert the exports once: parse and type them, spread each (unsplittable) gzip file over
    ``files_per_table`` Parquet files, and return the written paths. Later loads use
    ``fmt='parquet'`` and get split scans, column pruning and filter pushdown.

    ``cluster``: rows are dealt by ranges of the columns that analyses filter on
    (:data:`CLUSTER_BY`), so that the filters skip row groups and pages. ``rejects``: rows that
    lost values keep, in one more column, their record and what was lost, written in the same
    pass and listed by :func:`rejected_rows`.
    """
    out = {}
    for t in tables:
        source = (paths or {}).get(t)
        if rejects and fmt != "parquet":
            options = {**(csv_options or {}), "columnNameOfCorruptRecord": "__record"}
            df = _with_rejects(_read_text(spark, source or table_path(src_dir, t, fmt), t, fmt, options, split), t)
        else:
            df = load_table(spark, src_dir, t, fmt, csv_options=csv_options, path=source, split=split)
        path = table_path(dst_dir, t, "parquet")
        write_parquet(df, path, files=files_per_table, cluster_by=CLUSTER_BY.get(t, ()) if cluster else ())
        out[t] = path
    return out


def rejected_rows(spark: SparkSession, directory: str, tables: Iterable[str] = tuple(TABLES)) -> DataFrame:
    """What :func:`convert_to_parquet` (with ``rejects``) could not convert: ``table``, ``column``
    (``(record)`` for a malformed record), ``value`` and ``record`` (the row's known columns as
    CSV), one row per lost value. Reads that column of the converted files alone."""
    out = None
    for t in tables:
        kept = spark.read.schema(f"{REJECTS} {_REJECT_TYPE}").parquet(table_path(directory, t, "parquet"))
        lost = kept.where(F.col(REJECTS).isNotNull()).select(F.col(f"{REJECTS}.record").alias("record"), F.explode(f"{REJECTS}.items").alias("i"))
        one = lost.select(F.lit(t).alias("table"), "i.column", "i.value", "record")
        out = one if out is None else out.unionByName(one)
    return out
