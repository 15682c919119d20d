"""The corpus pipeline: quality rules, near-dedup, decontamination, PII, encoding.

Each stage works on all documents its predecessor kept; its result is written as Parquet in
the shared folder and read again, so a lost executor costs tasks of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.llm._shared import materialise
from qalens.llm.bpe import encode
from qalens.llm.decontaminate import drop_contaminated
from qalens.llm.near_dedup import keep_one_of_each
from qalens.llm.quality import keep_good
from qalens.llm.surrogates import replace_pii
from qalens.sources.supplied import read_supplied

TOKENIZER = "word_bpe_49k.json"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail no rule of the current policy."""
    return keep_good(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest id of each group of near copies, and every document without one."""
    return keep_one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    return drop_contaminated(docs, read_supplied(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with surrogates for personal data; ``n_chars`` follows the text."""
    replaced = replace_pii(docs)
    return replaced.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else replaced


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id``, ``ids``, ``n_tokens`` and ``decoded`` (what the ids decode to)."""
    import public_tokenizers

    tokenizer = public_tokenizers.path(TOKENIZER)
    return encode(docs, tokenizer, decode_to="decoded")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pii", pii),
    ("encoding", encoding),
]
#: Near-dedup and encoding cannot be expressed in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encoded corpus: every stage applied to ``documents``."""
    docs = read_supplied(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
