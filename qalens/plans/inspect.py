"""Reading physical plans: what a query will shuffle, scan and push down."""

from __future__ import annotations

import contextlib
import io
import re

from pyspark.sql import DataFrame

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    """The text ``df.explain(mode)`` prints."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def plan_tree(df: DataFrame) -> str:
    """The operator tree (first section of the formatted plan)."""
    text = plan_text(df)
    return text.split("\n\n\n")[0]


def count_nodes(df: DataFrame, name: str) -> int:
    """Occurrences of an operator in the formatted plan, subqueries included."""
    return len(re.findall(rf"^\(\d+\) {name}\b", plan_text(df), flags=re.M))


def summary(df: DataFrame) -> dict[str, object]:
    """Counts of the operators that matter at scale."""
    text = plan_text(df)
    nodes = re.findall(r"^\((\d+)\) ([A-Za-z]+)", text, flags=re.M)
    names = [n for _, n in nodes]
    return {
        "exchanges": names.count("Exchange"),
        "broadcast_exchanges": names.count("BroadcastExchange"),
        "scans": sum(1 for n in names if n == "Scan"),
        "sort_merge_joins": names.count("SortMergeJoin"),
        "broadcast_hash_joins": names.count("BroadcastHashJoin"),
        "windows": names.count("Window"),
        "python": sum(1 for n in names if n in PYTHON_NODES),
        "pushed_filters": re.findall(r"PushedFilters: (\[.*?\])", text),
        "read_schemas": re.findall(r"ReadSchema: (.*)", text),
    }


def shuffled_columns(df: DataFrame) -> list[list[str]]:
    """For every hash or range ``Exchange`` in the plan (subqueries included),
    the columns it moves, without expression ids."""
    text = plan_text(df)
    inputs = re.findall(r"^\(\d+\) Exchange\s*\nInput \[\d+\]: \[(.*?)\]", text, flags=re.M)
    return [[re.sub(r"#\d+L?$", "", c.strip()) for c in i.split(",")] for i in inputs]
