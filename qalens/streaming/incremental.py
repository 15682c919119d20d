"""Keeping the per-period counts current as new files of a table arrive.

The count state lives in Spark's state store (one row per group key, so it is
as small as the result, not the input) and is checkpointed under the shared
folder; each micro-batch re-derives the small published result from the full
counts and replaces the output table. A restarted or failed query resumes from
its checkpoint without counting a file twice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from qalens.functions.dates import period_label
from qalens.operators._util import as_col
from qalens.operators.category import top_category_from_counts


def read_stream(
    spark: SparkSession,
    path: str,
    schema: StructType | str,
    *,
    fmt: str = "parquet",
    max_files_per_trigger: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A streaming DataFrame over the files appearing under ``path`` (a folder or
    a glob; a single file is named by a glob matching only it). The schema
    (``StructType`` or DDL text) is explicit: file sources do not infer it."""
    reader = spark.readStream.schema(schema).format(fmt).options(**(options or {}))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.load(path)


def start_counts(
    source: DataFrame,
    keys: Sequence[Column],
    sink_path: str,
    *,
    checkpoint: str,
    derive: Callable[[DataFrame], DataFrame] | None = None,
    count_name: str = "Count",
    available_now: bool = True,
    processing_time: str = "1 minute",
) -> StreamingQuery:
    """Start a query that counts ``source`` rows per ``keys`` and, after each
    micro-batch, writes ``derive(counts)`` (default: the counts) as Parquet to
    ``sink_path``, replacing the previous version.

    ``available_now=True`` processes what is there and stops (scheduled
    catch-up runs); otherwise it triggers every ``processing_time``.
    ``checkpoint`` is a shared folder that belongs to this query: started again with
    it, the query goes on where it stopped. The state gets as many partitions as the
    session has shuffle partitions when the query first starts.

    The published Parquet is replaced in place, which is not atomic: a reader
    running during a micro-batch may see it half written. Readers that run
    concurrently need a table format with atomic commits as the sink.
    """
    counts = source.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_name))

    def publish(batch: DataFrame, epoch_id: int) -> None:
        out = derive(batch) if derive is not None else batch
        out.write.mode("overwrite").parquet(sink_path)

    writer = (
        counts.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(publish)
    )
    writer = (
        writer.trigger(availableNow=True)
        if available_now
        else writer.trigger(processingTime=processing_time)
    )
    return writer.start()


def start_count_by_period(
    source: DataFrame,
    ts: str | Column,
    sink_path: str,
    grain: str = "yyyy",
    *,
    period_name: str = "Year",
    count_name: str = "TotalNumber",
    **kwargs,
) -> StreamingQuery:
    """Q1 kept current: rows per calendar period."""
    return start_counts(
        source, [period_label(ts, grain).alias(period_name)], sink_path,
        count_name=count_name, **kwargs,
    )


def start_top_category_per_period(
    source: DataFrame,
    ts: str | Column,
    category: str | Column,
    sink_path: str,
    grain: str = "yyyy",
    *,
    period_name: str = "Year",
    category_name: str = "Name",
    share_name: str = "MaxPercentage",
    ties: str = "first",
    **kwargs,
) -> StreamingQuery:
    """Q3 kept current: the state holds (period, category) counts; each batch
    publishes the leading category per period and its share."""
    filtered = source.filter(as_col(ts).isNotNull())
    keys = [period_label(ts, grain).alias(period_name), as_col(category).alias(category_name)]

    def derive(counts: DataFrame) -> DataFrame:
        return top_category_from_counts(
            counts, period_name=period_name, category_name=category_name,
            count_name="Count", share_name=share_name, ties=ties,
        )

    return start_counts(filtered, keys, sink_path, derive=derive, **kwargs)


def run_to_completion(query: StreamingQuery) -> None:
    """Wait for an ``available_now`` query to finish; raise its error if it failed."""
    query.awaitTermination()
    error = query.exception()
    if error is not None:
        raise error
