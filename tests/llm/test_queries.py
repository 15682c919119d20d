"""The registered queries against DuckDB, the tokenizers' own results, or brute force."""

import base64
import collections
import os
import re
import sys
import textwrap
import zlib

import pyarrow.parquet as pq
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import __spark_entry__ as entry  # noqa: E402
from conftest import SF_MID, SF_SMALL  # noqa: E402
from oracle_compare import compare, duck  # noqa: E402
from qalens.llm import licences  # noqa: E402
from qalens.llm.queries import ORACLE_SQL, QUERIES  # noqa: E402


def table(sf, name):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def rows(spark, query, sf):
    return QUERIES[query](spark, sf).collect()


def test_every_query_is_registered():
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())
    assert set(ORACLE_SQL) <= set(entry.oracle_sql())
    assert sorted(int(re.match(r"op(\d+)_", q)[1]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
@pytest.mark.parametrize("key", sorted(ORACLE_SQL))
def test_matches_duckdb(spark, key, sf):
    r = compare(spark, duck(sf), key, QUERIES[key], ORACLE_SQL[key], sf)
    assert r["columns_match"] and r["values_match"], r


def test_token_counts(spark):
    import public_tokenizers
    import tiktoken

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sizes = [len(encoding.encode_ordinary(r["text"])) for r in table(SF_SMALL, "documents")]
    got = {r.n_tokens: r for r in rows(spark, "op1_token_counts", SF_SMALL)}
    assert {k: r.n_docs for k, r in got.items()} == collections.Counter(sizes)
    for k, r in got.items():
        assert r.docs_below == sum(s < k for s in sizes)
        assert r.docs_at_least == sum(s >= k for s in sizes)
        assert r.tokens_at_least == sum(s for s in sizes if s >= k)
        assert r.truncated_total == sum(min(s, k) for s in sizes)


def _licence(text, templates, least=licences.LEAST):
    """(licence, dice, line) of the best window of any template, trying every window that
    begins with one of the template's bigrams."""
    lower = (text or "").translate({c: c + 32 for c in range(65, 91)})
    found = [(m[0], lower.count("\n", 0, m.start())) for m in re.finditer(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)]
    words, lines = [w for w, _ in found], [n for _, n in found]

    def marks(ws):
        modifiers = {name for name, alias in licences.MODIFIERS.items() for w in ws if w in alias}
        return modifiers | {b for a, b in zip(ws, ws[1:]) if b in licences.NUMBERS and a in licences.BEFORE_NUMBERS}

    best = []
    for name, t in templates.items():
        grams = set(zip(t, t[1:]))
        for i, pair in enumerate(zip(words, words[1:])):
            window = words[i : i + len(t)]
            if pair in grams and (dice := brute.bigram_dice(window, t)) >= least and marks(window) == marks(t):
                best.append((-dice, -len(grams), name, i))
    if not best:
        return None, None, None
    score, _, name, _ = min(best)
    first = min(i for s, _, n, i in best if (s, n) == (score, name))
    return name, pytest.approx(-score), lines[first]


def _template_words():
    lower = {c: c + 32 for c in range(65, 91)}
    return {n: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t.translate(lower)) for n, t in licences.TEMPLATES.items()}


def test_licence_scan(spark):
    templates, docs = _template_words(), {d["doc_id"]: d["text"] for d in table(SF_SMALL, "documents")}
    got = rows(spark, "op2_licence_scan", SF_SMALL)
    assert len(got) == len(docs) and sum(r.licence is not None for r in got) >= 3
    for r in got:
        assert (r.licence, r.dice, r.line) == _licence(docs[r.doc_id], templates), r.doc_id


def test_the_right_licence_wherever_it_stands(spark):
    mit, gpl = licences.TEMPLATES["mit text"], licences.TEMPLATES["gpl-3.0 notice"]
    prose = "some words of a longer file that says nothing about it\n" * 40
    by = "This work is licensed under a Creative Commons Attribution{} 4.0 International License."
    gnu = "This work is licensed under the GNU {}General Public License, version {}."
    wanted = {
        by.format("-NonCommercial"): "cc-by-nc-4.0 notice", by.format("-NonCommercial-NoDerivatives"): "cc-by-nc-nd-4.0 notice",
        by.format(""): "cc-by-4.0 notice", by.format("-ShareAlike"): "cc-by-sa-4.0 notice", gnu.format("Lesser ", 3): "lgpl-3.0 line",
        gnu.format("Affero ", 3): "agpl-3.0 line", gnu.format("", 3): "gpl-3.0 line", gnu.format("", 2): "gpl-2.0 line", gnu.format("", 1): None,
        "Copyright 2020 Someone\n\n" + textwrap.fill(mit, 72) + "\n" + prose: "mit text",
        prose + "\n".join("// " + x for x in textwrap.wrap(gpl, 60)) + "\n" + prose: "gpl-3.0 notice",
        "We say: Released under the MIT License. And so on, " + prose: "mit line", "Licensed under CC BY-NC 4.0.": "cc-by-nc-4.0 line",
        mit[: len(mit) // 2]: None, "Licensed under CC BY 3.0.": None, prose: None, (mit + " ") * 300: "mit text", " ".join(mit.split()[::-1]): None,
    }
    df = spark.createDataFrame(list(enumerate(wanted)), "doc_id long, text string")
    got = {r.doc_id: r for r in licences.scan_licences(df).collect()}
    templates = _template_words()
    for i, (text, name) in enumerate(wanted.items()):
        assert got[i].licence == name, (text[:90], got[i])
        assert len(text) > 20_000 or (got[i].licence, got[i].dice, got[i].line) == _licence(text, templates)


def test_substring_dedup(spark):
    docs = table(SF_MID, "documents")
    want = {d["doc_id"]: w for d, w in zip(docs, brute.substring_dedup([d["text"] for d in docs]))}
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in rows(spark, "op3_substring_dedup", SF_MID)} == want


def test_toxicity_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["toxic"] for r in table(SF_MID, "labels")}
    got = rows(spark, "op4_toxicity", SF_MID)
    assert len(got) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    judged = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert sum(y == p for y, p in judged) >= 0.93 * len(judged)
    assert not any(p for y, p in judged if not y)


def test_near_duplicates(spark):
    docs = table(SF_MID, "documents")
    want = brute.near_duplicates([(d["doc_id"], d["text"]) for d in docs])
    got = rows(spark, "op5_near_duplicates", SF_MID)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_pii_surrogates(spark):
    docs = {d["doc_id"]: d["text"] for d in table(SF_MID, "documents")}
    got = {r.doc_id: r for r in rows(spark, "op6_pii_surrogates", SF_MID)}
    patterns = [r"[\w.]+@[\w.]+", r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", r"\b\d{16}\b", r"\(\d{3}\) \d{3}-\d{4}", r"[0-9a-f]{40}"]
    for p in patterns:
        pairs = {(a, b) for i in docs for a, b in zip(re.findall(p, docs[i]), re.findall(p, got[i].text), strict=True)}
        assert pairs and len({a for a, _ in pairs}) == len({b for _, b in pairs}) == len(pairs)
        assert not {a for a, _ in pairs} & {b for _, b in pairs}
    assert all((got[i].n_replaced == 0) == (got[i].text == docs[i]) for i in docs)


def test_bpe_equals_the_tokenizers_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    docs = {d["doc_id"]: d["text"] for d in table(SF_MID, "documents")}
    for r in rows(spark, "op7_bpe", SF_MID):
        ids = tokenizer.encode(docs[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), brute.sha(" ".join(map(str, ids)).encode()))
        assert r.decoded_sha256 == brute.sha(tokenizer.decode(ids, skip_special_tokens=False).encode())


def test_pipeline_equals_its_stages_by_brute_force(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    import corpus_pipeline

    docs = {d["doc_id"]: d["text"] for d in table(SF_SMALL, "documents")}
    con = duck(SF_SMALL)
    good = {i for i, kept in con.execute(f"SELECT doc_id, kept FROM ({ORACLE_SQL['op8_quality_ledger']})").fetchall() if kept}
    groups = brute.near_duplicates([(i, docs[i]) for i in good])
    clean = {i for i, c in con.execute(f"SELECT doc_id, contaminated FROM ({ORACLE_SQL['op9_benchmark_decontamination']})").fetchall() if not c}
    want = {i for i in good if groups[i][1] == i} & clean
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_SMALL).collect()}
    assert set(got) == want and 0 < len(want) < len(good) < len(docs)
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for i, r in got.items():
        if not re.search(r"[0-9@]", docs[i]):  # no personal data: the text itself was encoded
            ids = tokenizer.encode(docs[i], add_special_tokens=False).ids
            assert r.ids == " ".join(map(str, ids)) and r.decoded == tokenizer.decode(ids, skip_special_tokens=False)
