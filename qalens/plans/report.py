"""The five analyses end to end: load, run, cross-check, write.

Mirrors a report that runs every analysis in two dialects and checks they
agree: here the DataFrame form and the SQL-text form, compared as multisets
with :func:`qalens.operators.compare.diff_counts`. Every check is a Spark job; only the
per-analysis difference counts reach the driver.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.operators.compare import diff_counts
from qalens.plans import analyses as A
from qalens.plans.sql import SITE_SQL, run_sql

ANALYSES: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {
    "posts_per_year": lambda t: A.posts_per_year(t["Posts"]),
    "top_question_owners": lambda t: A.top_question_owners(t["Users"], t["Posts"]),
    "top_badge_per_year": lambda t: A.top_badge_per_year(t["Badges"]),
    "top_questions_by_comment_score": lambda t: A.top_questions_by_comment_score(
        t["Comments"], t["Posts"], t["Users"]
    ),
    "top_posts_by_covid_votes": lambda t: A.top_posts_by_covid_votes(t["Posts"], t["Votes"]),
}


#: The same results with only those keys grouped that can be among the first.
PRUNED: dict[str, Callable[[Mapping[str, DataFrame]], DataFrame]] = {
    "top_question_owners": lambda t: A.top_question_owners(t["Users"], t["Posts"], prune=True),
    "top_questions_by_comment_score": lambda t: A.top_questions_by_comment_score(t["Comments"], t["Posts"], t["Users"], prune=True),
    "top_posts_by_covid_votes": lambda t: A.top_posts_by_covid_votes(t["Posts"], t["Votes"], prune=True),
}


def run_analyses(tables: Mapping[str, DataFrame], prune: bool = False) -> dict[str, DataFrame]:
    """Every analysis as a lazy DataFrame; with ``prune`` the sketches of those that have one are
    made at once (:func:`qalens.operators.sketch.prune_for_top_k`)."""
    return {name: (PRUNED.get(name, fn) if prune else fn)(tables) for name, fn in ANALYSES.items()}


def cross_check(spark: SparkSession, tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per analysis: rows in the DataFrame form, rows in the SQL form,
    and rows that differ between them (0 = the two forms agree). Each form is evaluated once."""
    out = None
    for name, fn in ANALYSES.items():
        counts = diff_counts(fn(tables), run_sql(spark, SITE_SQL[name], tables))  # raises if columns differ
        one = counts.select(
            F.lit(name).alias("analysis"), F.col("rows_left").alias("rows_dataframe"), F.col("rows_right").alias("rows_sql"), "rows_differing"
        )
        out = one if out is None else out.unionByName(one)
    return out


def write_analyses(tables: Mapping[str, DataFrame], out_dir: str, fmt: str = "parquet", prune: bool = False) -> dict[str, str]:
    """Run every analysis and write each result under ``out_dir/<name>``."""
    from qalens.sources.sinks import write_csv, write_parquet

    paths = {}
    for name, df in run_analyses(tables, prune).items():
        path = f"{out_dir.rstrip('/')}/{name}"
        if fmt == "parquet":
            write_parquet(df, path)
        else:
            write_csv(df, path, files=None)
        paths[name] = path
    return paths


def time_forms(
    spark: SparkSession, tables: Mapping[str, DataFrame], runs: int = 5
) -> list[tuple[str, float, float]]:
    """Median wall seconds of ``runs`` executions of each analysis, in the
    DataFrame form and in the SQL form, each executed fully into the ``noop``
    sink (nothing collected). Returns (analysis, dataframe_sec, sql_sec)."""
    import statistics
    import time

    def once(make: Callable[[], DataFrame]) -> float:
        start = time.perf_counter()
        make().write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    out = []
    for name, fn in ANALYSES.items():
        forms = (lambda: fn(tables), lambda: run_sql(spark, SITE_SQL[name], tables))
        medians = []
        for make in forms:
            once(make)  # warm-up
            medians.append(statistics.median(once(make) for _ in range(runs)))
        out.append((name, medians[0], medians[1]))
    return out
