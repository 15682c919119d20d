"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from qalens.llm.bpe import op7_bpe
from qalens.llm.conversations import OP12_SQL, op12_conversation_repair
from qalens.llm.decontaminate import OP9_SQL, op9_benchmark_decontamination
from qalens.llm.fill_middle import OP11_SQL, op11_fill_in_middle
from qalens.llm.licences import op2_licence_scan
from qalens.llm.near_dedup import op5_near_duplicates
from qalens.llm.quality import OP8_SQL, op8_quality_ledger
from qalens.llm.sharding import OP13_SQL, op13_histogram_shards
from qalens.llm.substring_dedup import op3_substring_dedup
from qalens.llm.surrogates import op6_pii_surrogates
from qalens.llm.token_counts import op1_token_counts
from qalens.llm.toxicity import op4_toxicity
from qalens.llm.warc import OP10_SQL, op10_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_licence_scan": op2_licence_scan,
    "op3_substring_dedup": op3_substring_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_pii_surrogates": op6_pii_surrogates,
    "op7_bpe": op7_bpe,
    "op8_quality_ledger": op8_quality_ledger,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_warc": op10_warc,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_histogram_shards": op13_histogram_shards,
}
ORACLE_SQL: dict[str, str] = {
    "op8_quality_ledger": OP8_SQL,
    "op9_benchmark_decontamination": OP9_SQL,
    "op10_warc": OP10_SQL,
    "op11_fill_in_middle": OP11_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_histogram_shards": OP13_SQL,
}
