"""Writing results and tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qalens.session import shared_dir
from qalens.sources.csv import CSV_OPTIONS


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once in the shared scratch folder and read back: later steps see the same
    rows as often as they ask, and a lost executor does not redo what came before."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_parquet(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    partition_by: Sequence[str] = (),
    cluster_by: Sequence[str] = (),
    files: int | None = None,
) -> None:
    """Write Parquet (exact for every type, column-pruned and filter-pushed on
    read). ``files`` repartitions first, round-robin, to set the file count.

    ``cluster_by``: the rows are dealt by ranges of these columns and sorted by them, so every
    file, row group and page holds a narrow range and filters on the columns skip the others
    (the reader compares with their recorded minima and maxima). Ties are spread over files."""
    if cluster_by:
        spread = "__spread"
        order = [F.col(f"`{c}`") for c in cluster_by] + [F.col(spread)]
        tied = df.withColumn(spread, F.monotonically_increasing_id())
        out = tied.repartitionByRange(files, *order) if files else tied.repartitionByRange(*order)
        out = out.sortWithinPartitions(*order).drop(spread)
    else:
        out = df.repartition(files) if files else df
    writer = out.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(
    df: DataFrame,
    path: str,
    *,
    mode: str = "overwrite",
    compression: str = "gzip",
    files: int | None = None,
) -> None:
    """Write CSV in the dialect of :func:`qalens.sources.csv.read_csv`: header, quoted
    fields, microsecond timestamps (the default writer keeps only milliseconds) and
    untrimmed whitespace. Every value reads back as it was, but for the empty text, which
    reads back as NULL: an empty field is NULL in this dialect, quoted or not.

    A gzip file can only be read by one task, so the file count decides how
    parallel every later read is: ``files`` deals the rows round-robin over that many
    (a shuffle of the table); ``None`` keeps the input's partitions.
    """
    out = df.repartition(files) if files else df
    opts = {k: v for k, v in CSV_OPTIONS.items() if k not in ("mode", "multiLine")}
    opts["compression"] = compression
    out.write.mode(mode).options(**opts).csv(path)
