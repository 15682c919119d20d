"""Incremental (Structured Streaming) versions of the period counts."""

from qalens.streaming.incremental import (
    read_stream,
    run_to_completion,
    start_count_by_period,
    start_counts,
    start_top_category_per_period,
)

__all__ = ["read_stream", "run_to_completion", "start_count_by_period", "start_counts", "start_top_category_per_period"]
