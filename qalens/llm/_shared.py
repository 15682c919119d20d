"""Intermediate tables of the operators, kept in the folder all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalens.session import shared_dir


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under ``spark.checkpoint.dir`` and read it back.

    The written table cuts the lineage: a lost executor costs its own tasks, not the work
    before the table, and later steps read it as often as they like.
    """
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def pack(documents: DataFrame, text: str) -> DataFrame:
    """``_row`` (every other column) and ``_text``: whatever the columns are called, they
    cannot clash with an operator's own."""
    others = [F.col(f"`{c}`") for c in documents.columns if c != text] or [F.lit(None).cast("string").alias("_")]
    return documents.select(F.struct(*others).alias("_row"), F.col(f"`{text}`").alias("_text"))


def unpack(packed: DataFrame, columns: list[str], text: str, *more) -> DataFrame:
    """The columns as they were before ``pack``, and ``more``."""
    own = [F.col("_text").alias(c) if c == text else F.col(f"_row.`{c}`").alias(c) for c in columns]
    return packed.select(*own, *more)
