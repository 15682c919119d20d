"""Quality rules as a bitmask ledger, in DataFrame functions only.

``measure`` evaluates every rule once per document and keeps the measurements and one
failure bit per rule. Policies are versioned sets of rules: applying one, comparing two, or
asking what a rule costs (``ablation``) reads only the ledger, never the text again.

Defined results: a null or blank text has no words, fails ``few_words`` and measures 0
everywhere; repeated rows are judged each by itself; an empty table gives an empty ledger;
further columns of the input are not touched (``keep_columns`` passes chosen ones on).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from qalens.llm._shared import pack, unpack

#: White space between words, and the characters counted as symbols.
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"

#: A rule's bit is its place in this table.
RULES: dict[str, str] = {
    "few_words": "n_words < 10",
    "repeated_windows": "100 * n_repeat_words > 20 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "exclamations": "2 * n_exclaims > n_words AND n_words >= 20",
    "capitals": "2 * n_capitals > word_chars AND n_words >= 20",
    "duplicate_lines": "2 * n_dup_lines > n_lines AND n_lines >= 4",
    "few_distinct_words": "4 * n_distinct_words < n_words AND n_words >= 40",
    "word_length": "word_chars < 2 * n_words OR word_chars > 20 * n_words",
}
BASE = ("few_words", "repeated_windows")
POLICIES: dict[str, Sequence[str]] = {
    "base": BASE,
    "v1": (*BASE, "symbols", "exclamations", "capitals"),
    "v2": tuple(RULES),
    # the share of distinct words falls with a text's length, so its rule judged books by their
    # length; it is measured, and its bit kept, but no longer part of the policy
    "v3": tuple(r for r in RULES if r != "few_distinct_words"),
}
#: The policy in force.
CURRENT = "v3"
MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_exclaims", "n_capitals", "n_lines", "n_dup_lines",
    "n_distinct_words", "n_repeat_words",
)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, also inside lambdas."""
    return F.transform(F.array(value), body)[0]


def _window_hashes(words: Column, n: int) -> Column:
    def hashes(ws):
        return F.transform(
            F.sequence(F.lit(0), F.size(ws) - n),
            lambda i: F.xxhash64(*[F.get(ws, i + j) for j in range(n)]),
        )

    none = F.array().cast("array<bigint>")
    return F.when(F.size(words) >= n, _let(words, hashes)).otherwise(none)


def _repeat_words(hashes: Column, n: int) -> Column:
    """Words inside windows whose hash occurs twice or more: sort (hash, place), keep the
    places with an equal neighbour, add up the words their windows cover."""

    def places(s):
        twin = F.filter(
            s,
            lambda x, k: F.coalesce(F.get(s, k - 1)["h"] == x["h"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["h"] == x["h"], F.lit(False)),
        )
        return F.sort_array(F.transform(twin, lambda x: x["i"]))

    def covered(p):
        step = F.transform(p, lambda at, k: F.least(F.lit(n), F.coalesce(F.get(p, k + 1) - at, F.lit(n))))
        return F.aggregate(step, F.lit(0).cast("bigint"), lambda total, x: total + x)

    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    full = _let(_let(pairs, places), covered)
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), full).otherwise(F.lit(0).cast("bigint"))


def measure(documents: DataFrame, text: str = "text", keep_columns: Sequence[str] = ("doc_id",), window: int = 5) -> DataFrame:
    """The ledger: ``keep_columns``, the measurements (long) and ``fail_bits`` (long)."""
    body = F.coalesce(F.col(text), F.lit(""))
    keep = [F.col(c) for c in keep_columns]
    marks = "[^" + "".join(f"\\{c}" for c in SYMBOLS) + "!A-Z]+"
    parts = documents.select(
        *keep,
        F.filter(F.split(body, SPACES), lambda w: w != "").alias("_words"),
        F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
        F.regexp_replace(body, marks, "").alias("_marks"),
    )
    counts = parts.select(
        *keep,
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("bigint").alias("word_chars"),
        F.length(F.regexp_replace("_marks", "[!A-Z]+", "")).cast("bigint").alias("n_symbols"),
        F.length(F.regexp_replace("_marks", "[^!]+", "")).cast("bigint").alias("n_exclaims"),
        F.length(F.regexp_replace("_marks", "[^A-Z]+", "")).cast("bigint").alias("n_capitals"),
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.array_distinct("_words")).cast("bigint").alias("n_distinct_words"),
        _window_hashes(F.col("_words"), window).alias("_windows"),
    )
    measured = counts.select("*", _repeat_words(F.col("_windows"), window).alias("n_repeat_words")).drop("_windows")
    return measured.withColumn("fail_bits", _bits(RULES))


def _bits(rules: Mapping[str, str]) -> Column:
    total = F.lit(0).cast("bigint")
    for place, (_, test) in enumerate(rules.items()):
        total = total.bitwiseOR(F.when(F.expr(test), F.lit(1 << place)).otherwise(F.lit(0)).cast("bigint"))
    return total


def policy_mask(names: Sequence[str]) -> int:
    places = {name: i for i, name in enumerate(RULES)}
    return sum(1 << places[n] for n in dict.fromkeys(names))


def apply_policy(ledger: DataFrame, policy: str | Sequence[str] = CURRENT) -> DataFrame:
    """The ledger with ``kept``: no rule of the policy failed."""
    mask = policy_mask(POLICIES[policy] if isinstance(policy, str) else policy)
    return ledger.withColumn("kept", F.col("fail_bits").bitwiseAND(F.lit(mask)) == 0)


def keep_good(documents: DataFrame, text: str = "text", policy: str | Sequence[str] = CURRENT) -> DataFrame:
    """The documents that fail no rule of the policy, columns as given."""
    judged = apply_policy(measure(pack(documents, text), "_text", ("_row", "_text")), policy)
    return unpack(judged.where("kept"), documents.columns, text)


def ablation(ledger: DataFrame, policy: str | Sequence[str] = CURRENT) -> DataFrame:
    """Per rule of the policy: documents failing it, and documents only it rejects.

    Documents are first counted by failure bits (at most 2^rules groups), so what is shuffled
    does not grow with the number of documents.
    """
    names = list(dict.fromkeys(POLICIES[policy] if isinstance(policy, str) else policy))
    mask = policy_mask(names)
    by_bits = (
        ledger.select(F.col("fail_bits").bitwiseAND(F.lit(mask)).alias("bits")).groupBy("bits").agg(F.count("*").alias("n"))
    )
    rule = F.explode(F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(policy_mask([n])).cast("bigint").alias("bit")) for n in names]))
    return (
        by_bits.select("bits", "n", rule.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.col("bits").bitwiseAND(F.col("r.bit")) != 0, F.col("n")).otherwise(0)).alias("failing"),
            F.sum(F.when(F.col("bits") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("only_this_rule"),
        )
    )


def op8_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    from qalens.sources.supplied import read_supplied

    judged = apply_policy(measure(read_supplied(spark, sf_dir, "documents")))
    base = F.col("fail_bits").bitwiseAND(F.lit(policy_mask(BASE))) != 0
    return judged.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), "kept", "fail_bits"
    )


_TESTS = " + ".join(f"CASE WHEN {test} THEN {1 << i} ELSE 0 END" for i, test in enumerate(RULES.values()))
OP8_SQL = rf"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
win AS (SELECT doc_id, i, list_slice(w, i, i + 4) AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM doc WHERE len(w) >= 5)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1),
rep_words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM rep) GROUP BY doc_id),
m AS (
  SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         length(regexp_replace(t, '[^!]', '', 'g')) AS n_exclaims, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_capitals,
         len(l) AS n_lines, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines,
         len(list_distinct(w)) AS n_distinct_words, CAST(coalesce(rep_words.n, 0) AS BIGINT) AS n_repeat_words
  FROM doc LEFT JOIN rep_words USING (doc_id)),
j AS (SELECT *, CAST({_TESTS} AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (fail_bits & {policy_mask(BASE)}) <> 0 AS base_failed, (fail_bits & {policy_mask(POLICIES[CURRENT])}) = 0 AS kept, fail_bits
FROM j
"""
