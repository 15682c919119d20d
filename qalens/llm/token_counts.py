"""Exact token-length histogram, with suffix sums for every context limit.

Documents are encoded once and aggregated by their encoded length (partial counts before the
shuffle, so its volume follows the number of distinct lengths). Suffix sums over the
histogram then answer, for any context limit, how many documents are longer, how many tokens
a truncated corpus has, and any quantile, without reading a text again.

Suffix sums are taken in two levels, within blocks of lengths and over the blocks' totals, so
no task gathers the histogram.

Defined results: a null or empty text has length 0; repeated rows count each; an empty table
gives an empty histogram (and 0 for every total); further columns are ignored. A text may be
of any length and hold runs of any length: the encoder's pattern gives up on white space of
about a million characters, so runs from ``LONG_RUN`` are cut out by the pattern's own rule
(all but the last of a run that something follows is one piece) and encoded as such.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qalens.llm._shared import materialise
from qalens.llm._text import text_parts, tidy

#: Lengths per block of the two-level sums.
BLOCK = 256
#: White space of at least so many characters is not given to the encoder's pattern.
LONG_RUN = 50_000
#: Fixed value: the characters that the pattern's ``\s`` means.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: How patterns end for which that rule holds.
WHITE_RULE = r"\s+(?!\S)|\s+"


@lru_cache(maxsize=2)
def _encoding(ranks: bytes, pattern: str):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})


def text_length(encoding, text: str, long_run: int = LONG_RUN) -> int:
    """Tokens of a text, whatever runs of white space it holds."""
    if len(text) < long_run or not encoding._pat_str.endswith(WHITE_RULE):
        return len(encoding.encode_ordinary(text))
    total = at = 0
    for run in re.finditer(f"[{WHITE}]{{{long_run},}}", text):
        stop = run.end() if run.end() == len(text) else run.end() - 1
        total += len(encoding.encode_ordinary(text[at : run.start()]))
        total += len(encoding._encode_single_piece(text[run.start() : stop])) if stop > run.start() else 0
        at = stop
    return total + len(encoding.encode_ordinary(text[at:]))


def token_lengths(documents: DataFrame, ranks_path: str, pattern: str, text: str = "text", keep_columns: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``keep_columns`` and ``n_tokens``, the length of the whole text under a byte-level BPE."""
    with open(ranks_path, "rb") as f:
        source = documents.sparkSession.sparkContext.broadcast(f.read())
    schema = T.StructType([documents.schema[c] for c in keep_columns]).add("n_tokens", "long")
    at = len(keep_columns)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(source.value, pattern)
        for part in (p for batch in batches for p in text_parts(batch, at)):
            sizes = [text_length(encoding, body) if body else 0 for body in part.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:at], pa.array(sizes, pa.int64())], schema.names)

    return documents.select(*keep_columns, F.col(text).alias("_text")).mapInArrow(tidy(rows), schema)


def length_histogram(lengths: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Documents by length: ``group``, ``n_tokens``, ``n_docs``."""
    return lengths.groupBy(*group, "n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(histogram: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """The histogram with, for each length L: ``docs_below`` (shorter than L),
    ``docs_at_least``, ``tokens_at_least`` (tokens of documents of L or more) and
    ``truncated_total`` (tokens of all documents cut to L)."""
    blocked = histogram.withColumn("_block", F.floor(F.col("n_tokens") / BLOCK))
    size = (F.col("n_tokens") * F.col("n_docs")).alias("tokens")
    totals = blocked.select(*group, "_block", "n_docs", size).groupBy(*group, "_block").agg(
        F.sum("n_docs").alias("_docs"), F.sum("tokens").alias("_tokens")
    )
    later = Window.partitionBy(*group).orderBy(F.desc("_block")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    totals = totals.select(
        *group, "_block",
        F.coalesce(F.sum("_docs").over(later), F.lit(0)).alias("_later_docs"),
        F.coalesce(F.sum("_tokens").over(later), F.lit(0)).alias("_later_tokens"),
        F.sum("_docs").over(whole).alias("_all_docs"),
        F.sum("_tokens").over(whole).alias("_all_tokens"),
    )
    inside = Window.partitionBy(*group, "_block").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    summed = blocked.select(
        *group, "_block", "n_tokens", "n_docs",
        F.sum("n_docs").over(inside).alias("_docs"),
        F.sum(F.col("n_tokens") * F.col("n_docs")).over(inside).alias("_tokens"),
    )
    same = summed["_block"] == totals["_block"]
    for g in group:
        same = same & summed[g].eqNullSafe(totals[g])
    docs, tokens = F.col("_docs") + F.col("_later_docs"), F.col("_tokens") + F.col("_later_tokens")
    return summed.join(totals, same).select(
        *[summed[g] for g in group], "n_tokens", "n_docs",
        (F.col("_all_docs") - docs).alias("docs_below"),
        docs.alias("docs_at_least"),
        tokens.alias("tokens_at_least"),
        (F.col("_all_tokens") - tokens + docs * F.col("n_tokens")).alias("truncated_total"),
    )


def truncated_totals(sums: DataFrame, limits: Sequence[int]) -> DataFrame:
    """Per context limit: tokens of the corpus cut to it, and the documents it cuts. A limit
    between two lengths has the suffix sums of the next longer length."""
    wanted = F.explode(F.lit([int(x) for x in limits])).alias("limit")
    each = sums.select("n_tokens", "n_docs", wanted)
    return each.groupBy("limit").agg(
        F.sum(F.least("n_tokens", "limit") * F.col("n_docs")).alias("total_tokens"),
        F.sum(F.when(F.col("n_tokens") > F.col("limit"), F.col("n_docs")).otherwise(0)).alias("docs_cut"),
    )


def quantiles(sums: DataFrame, shares: Sequence[float]) -> DataFrame:
    """Per share q: the least length that at least ``q`` of the documents do not exceed."""
    wanted = F.explode(F.lit([float(x) for x in shares])).alias("share")
    reached = sums.select("n_tokens", "n_docs", "docs_below", "docs_at_least", wanted).where(
        F.col("docs_below") + F.col("n_docs") >= F.col("share") * (F.col("docs_below") + F.col("docs_at_least"))
    )
    return reached.groupBy("share").agg(F.min("n_tokens").alias("n_tokens"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from qalens.sources.supplied import read_supplied

    lengths = token_lengths(
        read_supplied(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )
    return suffix_sums(materialise(length_histogram(lengths), "lengths"))
